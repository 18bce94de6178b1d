"""Duplicate keys: counting them and flagging every row that carries one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than one row in this many counts as hot, so there are never
# more hot keys than this number and their list is always small.
HOT_SHARE = 1000


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return key_counts(df, keys).where("row_count > 1")


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def flag_duplicates(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Mark all rows of a key that occurs more than once; missing keys are equal.

    A window per key would put all copies of one key into one task. Here the
    keys are counted with partial aggregation, and the repeated ones joined
    back. The few hot keys are known to be repeated, so their rows need no
    join partner: they are told apart by a broadcast list of at most
    ``HOT_SHARE`` keys and then spread over tasks by the slice column.
    """
    counts = key_counts(df, keys)
    total = counts.agg(F.sum("row_count")).scalar()
    renamed = counts.where("row_count > 1").select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("row_count")
    )
    is_hot = F.col("row_count") * HOT_SHARE > total
    hot = renamed.where(is_hot).drop("row_count").withColumn("_hot", F.lit(True))
    cold = (
        renamed.where(~is_hot)
        .drop("row_count")
        .withColumns({"_cold": F.lit(True), "_cold_slice": F.lit(0)})
    )
    names = [f"_{k}" for k in keys]
    marked = (
        df.join(F.broadcast(hot), _same_key(df, hot, keys), "left")
        .drop(*names)
        .withColumn(
            "_slice",
            F.when(F.col("_hot"), F.spark_partition_id() + 1).otherwise(F.lit(0)),
        )
    )
    joined = marked.join(
        cold,
        _same_key(marked, cold, keys) & (marked["_slice"] == cold["_cold_slice"]),
        "left",
    )
    return joined.withColumn(flag, F.coalesce("_hot", "_cold", F.lit(False))).drop(
        *names, "_hot", "_cold", "_slice", "_cold_slice"
    )

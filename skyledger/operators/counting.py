"""Counting many conditions over a table in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def met(conditions: Sequence[Column]) -> Column:
    """Positions of the conditions that hold, as an array.

    Built without a lambda: higher-order functions are interpreted and would
    take all conditions inside them out of the generated code.
    """
    return F.array_remove(
        F.array(*[F.when(c, F.lit(i)).otherwise(F.lit(-1)) for i, c in enumerate(conditions)]), -1
    )


def count_met(df: DataFrame, conditions: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, position, row_count); position null counts rows that meet none.

    Dozens of conditional counts in one aggregate make a method too large for
    the JIT. Here a row is unrolled to the conditions it meets, which are
    counted with partial aggregation: at most one row per group and condition
    leaves a task.
    """
    return count_positions(df.select(*by, met(conditions).alias("_met")), "_met", by)


def count_positions(df: DataFrame, positions: str, by: Sequence[str] = ()) -> DataFrame:
    """The same counts from positions that rows carry already."""
    return (
        df.select(*by, F.explode_outer(positions).alias("position"))
        .groupBy(*by, "position")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def spread(counts: DataFrame, entries: Sequence[Sequence[Column]], by: Sequence[str] = ()) -> DataFrame:
    """All conditions as rows, also those never met.

    ``entries`` describes each condition by the same named columns; its count
    is added as ``row_count``. The map holds at most one entry per condition.
    """
    pair = F.when(F.col("position").isNotNull(), F.struct("position", "row_count"))
    found = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(pair)).alias("found"))
    rows = [
        F.struct(
            *entry,
            F.coalesce(F.col("found")[F.lit(i)], F.lit(0).cast("bigint")).alias("row_count"),
        )
        for i, entry in enumerate(entries)
    ]
    return found.select(*by, F.inline(F.array(*rows)))

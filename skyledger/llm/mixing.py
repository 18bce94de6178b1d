"""Mixing sources to target weights: whole copies plus one seeded Bernoulli copy.

Tokens are summed per source, the sums give each source a repetition rate, and
every document is emitted floor(rate) times and once more with the probability
of the fraction, decided by a hash of its id, text and a seed.

Defined cases: a null text has size 0 and is emitted like any other document; a
null source is a source of its own and ranks last; a source without tokens has
target 0 and rate 0; rows that are equal in id and text draw alike; an empty
table gives an empty result. Columns beside the named ones are carried along;
the operator's own columns are ``size``, ``source_size``, ``target``, ``copies``
and, in ``emit``, ``copy``, and replace columns of the input with these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import free, n_words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: its size, target and repetition rate.

    A target is the source's part of ``share`` times all tokens by weight, at
    most ``most`` times its size; what a source cannot take goes to the others
    by weight. Sources fill up in the order of capacity per weight, so the level
    at which all others stop follows from two running sums. The windows hold one
    row per source, not documents.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("_ratio", "_rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per_source = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_rank", F.row_number().over(by_code_point) - 1)
        .withColumn("_weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("_rank") % len(weights)))
        .withColumn("_most", F.col("source_size") * F.lit(float(most)))
        .withColumn("_ratio", F.col("_most") / F.col("_weight"))
    )
    wanted = F.sum("source_size").over(everything) * F.lit(float(share))
    left = wanted - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    weight_left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = (
        per_source.withColumn("_level", left / weight_left)
        # The first source, in filling order, that is not filled sets the level for all.
        .withColumn("_open", F.when(F.col("_ratio") > F.col("_level"), F.col("_level")))
        .withColumn("_stop", F.min_by("_open", F.when(F.col("_open").isNotNull(), F.struct("_ratio", "_rank"))).over(everything))
    )
    target = F.when(F.col("_stop").isNull(), F.col("_most")).otherwise(
        F.least("_most", F.col("_weight") * F.col("_stop"))
    )
    return level.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("_rate"),
    )


def draw(seed: int) -> Column:
    """A number from 0 to 1 that only the row's id, its text and the seed decide."""
    named = F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), "text")
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 10), 16, 10).cast("double") / F.lit(float(1 << 40))


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 0) -> DataFrame:
    """Every document with its size, its source's size and target, and ``copies``.

    Sums are taken map-side first, so a hot source sends one row per task. Spark
    broadcasts the per-source table if it is small and else splits a skewed join.
    """
    drawn, origin, per_word = free(docs, "_draw", "_source", "_rate")
    own = [F.col(c) for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    # Drawn before the join, so that a query without texts does not move them.
    sized = docs.select(*own, n_words("text").alias("size"), draw(seed).alias(drawn))
    goals = targets(sized.select("source", "size"), weights, share, most)
    goals = goals.withColumnsRenamed({"source": origin, "_rate": per_word})
    rate = F.col(per_word)
    return (
        sized.join(goals, F.col("source").eqNullSafe(F.col(origin)), "left")
        .withColumn("copies", (F.floor(rate) + (F.col(drawn) < rate - F.floor(rate)).cast("long")).cast("long"))
        .drop(drawn, origin, per_word)
    )


def emit(planned: DataFrame) -> DataFrame:
    """One row per copy, numbered from 0 in ``copy``; documents with none are gone."""
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    return planned.where("copies > 0").select(*[F.col(c) for c in planned.columns if c != "copy"], copy)


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed corpus with the columns of ``docs``, whatever their names."""
    (whole,) = free(docs, "_whole")
    # The row travels as one column beside the three that decide.
    packed = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole))
    return emit(plan(packed, **settings)).select(f"{whole}.*")

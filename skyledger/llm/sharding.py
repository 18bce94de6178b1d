"""Sharding by sampled splitters: size-weighted key samples bound ranges of near equal bytes.

The key of a record is a hash of its text, so copies of a text are neighbours.
A size-weighted sample of keys gives quantile boundaries of many fine ranges.
Ranges that hold far more than their part, such as those of a hot group of
copies, are subdivided at sampled quantiles of ``doc_id``, into as many pieces as
the range holds mean ranges. Each fine range is then ordered and summed on its own, and the sums of the ranges before it place
every record on one line of bytes that is cut into equal shards.

Defined cases: a null text has no bytes and is a copy of the empty text; a null
``doc_id`` sorts first, in an overfull range in several pieces; repeated rows are sharded one by one, in any order among
themselves; an empty table gives an empty result; columns beside ``doc_id`` and
``text`` are ignored by ``assign``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import cut, search_in, search_sorted

SHARDS = 40
#: Bytes a record counts beside its text.
OVERHEAD = 16
#: Fine ranges a shard at least, rows a fine range beyond that, expected samples a fine range.
FINE, ROWS, SAMPLES = 32, 1_000_000, 8
#: A range with this many times the mean is overfull.
OVERFULL = 4
#: Groups of copies with up to this part of a shard stay in one shard.
WHOLE = 1 / 32


def records(docs: DataFrame) -> DataFrame:
    """Key, size and checksum of every document; narrow, so it is written once."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(raw).cast("long") + OVERHEAD).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(raw).alias("key"),
    )


def splitters(rows: DataFrame, total: int, ranges: int, samples: int = SAMPLES) -> list[int]:
    """Boundaries between ``ranges`` ranges of keys, from a sample weighted by size.

    About ``ranges * samples`` keys are drawn, whatever the number of rows, each
    row with a probability in proportion to its size; the sample is reduced to
    ``ranges - 1`` quantiles before the driver sees it.
    """
    chance = F.col("size") * F.lit(float(ranges * samples) / total)
    draw = F.pmod(F.xxhash64("doc_id", "key", "size", F.lit(17)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    quantiles = [i / ranges for i in range(1, ranges)]
    found = (
        rows.where(draw < chance)
        .agg(F.percentile_approx("key", quantiles, ranges * samples * 4).alias("splits"))
        .first()
    )
    return sorted(set(found.splits or []))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document: doc_id, size, text_crc32, shard, slot.

    Shards hold near equal bytes: each differs from the mean by at most one
    document, or one group of copies kept whole, at either end.
    """
    rows = cut(records(docs))
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if not total:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = max(shards * FINE, -(-count // ROWS))
    # Rows without id are told apart by their place in the written table.
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("_place")
    ranged = rows.select("*", place, search_sorted(splitters(rows, total, ranges), F.col("key")).alias("range"))
    ranged = cut(ranged)

    # Overfull ranges, at most ranges / OVERFULL of them, with the number of their pieces: together
    # at most twice the ranges. Of as many quantiles as the fullest one needs each keeps every n-th.
    full = ranged.groupBy("range").agg(F.ceil(F.sum("size") * F.lit(ranges / total)).cast("int").alias("pieces"))
    full = cut(full.where(F.col("pieces") > OVERFULL))
    most = max(2, full.agg(F.max("pieces")).first()[0] or 0)
    quantiles = [i / most for i in range(1, most)]
    step = F.floor(F.lit(most) / F.col("pieces"))
    cuts = (
        ranged.join(F.broadcast(full), "range")
        .groupBy("range", "pieces")
        .agg(F.percentile_approx("doc_id", quantiles, 16 * most).alias("splits"))
        .select("range", "pieces", F.filter("splits", lambda _, i: F.pmod(i + 1, step) == 0).alias("splits"))
    )
    pieced = ranged.join(F.broadcast(cuts), "range", "left").withColumn(
        "piece",
        F.when(F.col("pieces").isNull(), 0)
        .when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("_place"), F.col("pieces")))
        .otherwise(search_in(F.col("splits"), most, F.col("doc_id"))),
    )
    pieced = pieced.drop("splits", "pieces", "_place")

    # One row per range and piece: at most a few times the ranges, which follow the rows.
    parts = pieced.groupBy("range", "piece").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    before = Window.orderBy("range", "piece").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "range",
        "piece",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
    )
    inside = Window.partitionBy("range", "piece").orderBy("key", "doc_id")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    copies = Window.partitionBy("range", "piece", "key")
    placed = (
        pieced.withColumn("_end", F.sum("size").over(upto))
        .withColumn("_row", F.row_number().over(inside))
        .withColumn("_group", F.sum("size").over(copies))
        .withColumn("_group_end", F.max("_end").over(copies))
        .join(F.broadcast(parts), ["range", "piece"])
    )
    whole = F.col("_group") <= F.lit(total * WHOLE / shards)
    middle = F.col("_bytes") + F.when(whole, F.col("_group_end") - F.col("_group") / 2).otherwise(
        F.col("_end") - F.col("size") / 2
    )
    placed = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(total))).cast("int").alias("shard"),
        (F.col("_rows") + F.col("_row") - 1).alias("_place"),
    )
    first = placed.groupBy("shard").agg(F.min("_place").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_place") - F.col("_first")).alias("slot")
    )

"""What the vector searches share: packed vectors, and groups of blocks and queries of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import cut

#: Sorts after every id.
NO_ID = np.iinfo(np.int64).max
#: Rows of three numbers that may go to every task.
SMALL = 50_000
#: Tasks that groups are dealt to at most; beyond, a task has several, one after another.
TASKS = 16_384


def packed(vectors: DataFrame, turn: Callable[[np.ndarray], bytes | None], *kept: Column) -> DataFrame:
    """vec_id, x (what ``turn`` makes of the vector as little-endian doubles), size and the columns ``kept``.

    Rows without a vector, with a null or non-finite component, or for which
    ``turn`` gives nothing are left out.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *kept, F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.where(F.col("e").isNotNull())
    names = [c for c in rows.columns if c != "e"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for value in batch.column("e"):
                raw = None
                if not value.values.null_count:
                    x = value.values.to_numpy(zero_copy_only=False).astype("<f8", copy=False)
                    raw = turn(x) if np.isfinite(x).all() else None
                made.append((raw, len(value)))
            good = pa.array([raw is not None for raw, _ in made])
            columns = [batch.column(c) for c in names]
            columns += [pa.array([raw for raw, _ in made], pa.binary()), pa.array([n for _, n in made], pa.int32())]
            yield pa.record_batch(columns, names=[*names, "x", "size"]).filter(good)

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes if name != "e")
    return rows.mapInArrow(pack, f"{kinds}, x binary, size int")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` written once, with a number ``r`` of each row that stays the same from then on."""
    return cut(cut(rows).withColumn("r", F.monotonically_increasing_id()))


def stacked(packs: pa.Array, kind: str, size: int) -> np.ndarray:
    """Packed vectors of one size as the rows of a matrix."""
    if isinstance(packs, pa.ChunkedArray):
        packs = packs.combine_chunks()
    if not len(packs) or not size:
        return np.zeros((len(packs), size), kind)
    return np.frombuffer(b"".join(packs.to_pylist()), kind).reshape(len(packs), size)


def met(rows: DataFrame, queries: DataFrame, keys: list[str], block: int, chunk: int) -> DataFrame:
    """Rows and queries of each key side by side, grouped by ``keys``, ``block`` and ``chunk``.

    Both have the columns ``keys`` and the same others, ``is_query`` tells them
    apart. A group holds about ``block`` rows and ``chunk`` queries, so its size
    does not depend on the input: each block meets each chunk of its key. Keys
    without queries are not moved.
    """
    chunks = queries.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("chunks"))
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    shape = cut(chunks.join(sizes, keys))
    known, groups = shape.agg(F.count("*"), F.sum(F.col("blocks") * F.col("chunks"))).first()
    shape = F.broadcast(shape) if known <= SMALL else shape
    from_zero = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("r"), F.col(n)).cast("int")
    posted = rows.join(shape, keys).withColumn("block", part("blocks")).withColumn("chunk", from_zero("chunks"))
    asked = queries.join(shape, keys).withColumn("chunk", part("chunks")).withColumn("block", from_zero("blocks"))
    both = posted.withColumn("is_query", F.lit(False)).unionByName(asked.withColumn("is_query", F.lit(True)))
    # A group is little to read and much to compute, so groups are not put together by their bytes.
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.drop("blocks", "chunks").repartition(max(usual, min(TASKS, groups or 1)), *keys, "block", "chunk")


def first_rows(anchor: np.ndarray, order: tuple[np.ndarray, ...], most: int) -> np.ndarray:
    """Places of the first ``most`` entries of each anchor by ``order`` (the main key first)."""
    by = np.lexsort((*reversed(order), anchor))
    sorted_anchor = anchor[by]
    starts = np.flatnonzero(np.r_[True, sorted_anchor[1:] != sorted_anchor[:-1]]) if len(by) else by
    rank = np.arange(len(by)) - np.repeat(starts, np.diff(np.r_[starts, len(by)]))
    return by[rank < most]

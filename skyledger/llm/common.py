"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import session

#: A word is a run of anything but these six white space characters.
WORD = "[^\\x20\\x09-\\x0D]+"


#: Rows that Spark sends to Python at once; whole texts and token sets are wide rows.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Bound what Spark sends to Python at once, and let workers import this package.

    Workers find the package where the driver found it; a cluster that ships it
    with ``--py-files`` does not need that.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(rows))
    spark.conf.set(rows, str(min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """Write ``frame`` to the shared checkpoint folder and go on from there.

    A lost executor costs no work before this point, and what follows reads the
    rows as often as it likes without computing them again.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(session.scratch_folder(frame.sparkSession))
    return frame.checkpoint()


def n_words(text: str) -> Column:
    """Words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def search_sorted(splits: list[int], value: Column) -> Column:
    """Number of ``splits`` (ascending) that are at most ``value``, by binary search.

    The value travels in the accumulator. As a name in the lambda's body it would be
    hidden from the optimizer, which would then derive filters that cannot know it.
    """
    if not splits:
        return F.lit(0)
    steps, step = [], 1 << (len(splits).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1
    ordered = F.array(*[F.lit(s) for s in splits])

    def further(found: Column, step: Column) -> Column:
        at = found["at"]
        more = (at + step <= len(splits)) & (F.get(ordered, at + step - 1) <= found["value"])
        return F.struct(F.when(more, at + step).otherwise(at).alias("at"), found["value"].alias("value"))

    start = F.struct(F.lit(0).alias("at"), value.alias("value"))
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), start, further, lambda found: found["at"])


def search_in(ordered: Column, most: int, value: Column) -> Column:
    """As ``search_sorted``, for splits in an array column with at most ``most`` elements."""
    steps = [1 << bit for bit in reversed(range(most.bit_length()))]

    def further(found: Column, step: Column) -> Column:
        at = found["at"] + step
        more = (at <= F.size(found["splits"])) & (F.get(found["splits"], at - 1) <= found["value"])
        return F.struct(F.when(more, at).otherwise(found["at"]).alias("at"), found["value"].alias("value"), found["splits"].alias("splits"))

    start = F.struct(F.lit(0).alias("at"), value.alias("value"), ordered.alias("splits"))
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), start, further, lambda found: found["at"])


def free(frame: DataFrame, *names: str) -> list[str]:
    """These names, each with as many underscores in front as it takes to clash with no column."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


#: Bits of a filter that keeps texts nobody wants from being moved.
FILTER_BITS = 1 << 26


def split_texts(docs: DataFrame, wanted: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``names`` may be among the wanted ones, and rows where they cannot.

    The filter has a fixed size, 8 MB, so it can go to every task. It never takes
    a wanted row for an unwanted one.
    """
    row, bucket, held, hit = free(docs, "_row", "_bucket", "_bits", "_hit")
    slot = F.pmod(F.xxhash64(*names), F.lit(FILTER_BITS)) + 1
    bits = (
        wanted.select(slot.alias("_slot"))
        .groupBy(F.bitmap_bucket_number("_slot").alias(bucket))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias(held))
    )
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col(held), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = (
        docs.withColumn(row, F.bitmap_bucket_number(slot))
        .join(F.broadcast(bits), F.col(row) == F.col(bucket), "left")
        .withColumn(hit, F.coalesce(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")), F.lit(0)) == 1)
        .drop(row, bucket, held)
    )
    return marked.where(F.col(hit)).drop(hit), marked.where(~F.col(hit)).drop(hit)


def some_texts(docs: DataFrame, wanted: DataFrame, *names: str) -> DataFrame:
    return split_texts(docs, wanted, *names)[0]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column, null as empty, without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at.astype(np.int64) - at[0]


def slices(offsets: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes, a longer row alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches: a task's Python objects then stay few, whatever Spark sends at once."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)


def squeezed(raw: bytes) -> bytes:
    """Bytes packed with zstd behind their length."""
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unsqueezed(packed: bytes) -> bytes:
    return pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit of 64-bit values over all bits."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Polynomial hashes modulo 2**64 of any byte ranges of a buffer."""

    BASE = 0x9E3779B97F4A7C15 | 1
    _power = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        size = len(data) + 1
        if len(Rolling._power) < size:
            room = max(size, 1 << 20)
            for name, base in (("_power", self.BASE), ("_inverse", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(room, base, np.uint64)
                steps[0] = 1
                setattr(Rolling, name, np.cumprod(steps))
        self.sums = np.zeros(size, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(np.uint64)
        return mixed((self.sums[end] - self.sums[start]) * self._inverse[start] + size)

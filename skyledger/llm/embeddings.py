"""Embedding near-duplicates by randomised-rotation binary codes with bounds.

A unit vector is rotated at random and kept as the signs of its coordinates with
one correction factor, the inner product of the vector with its code. From code
and factor follows an unbiased estimate of the inner product with any other
vector and a confidence bound on its error. Code, factor and a rounded form of the
vector, which plays the other side, are stored once, and blocks exchange only these.
Vectors with a pair whose estimate plus bound reaches the limit are fetched in double
precision and such pairs recomputed exactly, so no pair below the limit is ever linked.

Which vectors meet: equal vectors are one vector from the start. Centroids come
from a bounded sample; every vector goes to its ``PROBES`` nearest cells, and two
vectors are compared in the first cell they share. A cell larger than ``BLOCK``
is compared in pairs of blocks, so a task holds two blocks at most.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing; vectors of different lengths never link; a null
``vec_id`` links but names a component only if no other vector of it has an id;
repeated rows are equal vectors; columns beside ``vec_id`` and ``embedding`` are
ignored by ``near`` and kept by ``deduplicated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import cut, free
from skyledger.llm.components import components

LIMIT = 0.95
#: Standard errors the bound of an estimate covers.
ERRORS = 4.0
#: Cells a vector goes to, vectors of a block, rows compared at once.
PROBES, BLOCK, ROWS = 4, 4096, 256
#: Cells at most, and vectors the centroids are fitted on, about, for each of them.
CELLS, SAMPLE, TURNS = 4096, 16, 6
#: Bytes of all these vectors, about.
SAMPLE_BYTES = 1 << 28
SEED = 11
NO_CELL = np.iinfo(np.int32).max


def vector_key(value: pa.Scalar) -> tuple[int | None, bytes | None]:
    """Key of equal vectors and the vector's doubles; nothing if it can link with nothing."""
    if value.is_valid and len(value) and not value.values.null_count:
        x = value.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
        if np.isfinite(x).all() and x.any():
            pack = x.tobytes()
            return int.from_bytes(hashlib.blake2b(pack, digest_size=8).digest(), "little", signed=True), pack
    return None, None


def classes(vectors: DataFrame) -> DataFrame:
    """vec_id, k (key of equal vectors, null if it can link with nothing) and the vector."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, packs = zip(*map(vector_key, batch.column("embedding"))) if len(batch) else ((), ())
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array(keys, pa.int64()), pa.array(packs, pa.binary())],
                names=["vec_id", "k", "x"],
            )

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        keyed, "vec_id long, k long, x binary"
    )


def unit(packs: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(p, "<f8") for p in packs])
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def rotation(size: int) -> np.ndarray:
    """A random rotation that every task makes alike."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def centroids(distinct: DataFrame, n: int) -> dict[int, tuple[int, np.ndarray]]:
    """For each length in the sample the number of its first cell and unit centroids.

    A length gets as many cells as its share allows; lengths the sample lacks have one each.
    """
    cells = int(min(CELLS, max(1, np.sqrt(n))))
    size = distinct.agg(F.avg(F.length("x"))).first()[0] or 8.0
    rows = max(1, int(min(SAMPLE * cells, SAMPLE_BYTES / size)))
    chance = min(1.0, rows / max(1, n))
    drawn = distinct.where(F.pmod(F.xxhash64("k", F.lit(3)), F.lit(1 << 30)) < int(chance * (1 << 30)))
    packs = sorted(row.x for row in drawn.select("x").limit(2 * rows).collect())
    found, first = {}, 0
    for length, count in zip(*np.unique([len(p) for p in packs], return_counts=True)):
        x = unit([p for p in packs if len(p) == length]).astype(np.float32)
        own = int(min(cells, max(1, np.sqrt(n * count / len(packs)))))
        centres = x[np.random.default_rng(SEED).permutation(len(x))[:own]]
        for _ in range(TURNS):
            nearest = np.concatenate([(part @ centres.T).argmax(1) for part in np.array_split(x, 1 + len(x) // 4096)])
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, x)
            norms = np.sqrt((sums * sums).sum(1, keepdims=True))
            centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
        found[int(length) // 8] = first, centres
        first += len(centres)
    return found


def signs_of(codes: np.ndarray, size: int) -> np.ndarray:
    """Unit vectors with the signs that the codes hold."""
    return (2.0 * np.unpackbits(codes, axis=1, count=size) - 1).astype(np.float32) / np.float32(np.sqrt(size))


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code and factor of unit vectors, and their turned coordinates as multiples (one byte each) of a scale."""
    turned = x @ rotation(x.shape[1])
    codes = np.packbits(turned > 0, axis=1)
    factor = (signs_of(codes, x.shape[1]) * turned).sum(1)
    scale = np.abs(turned).max(1) / 127
    return codes, factor, np.rint(turned / scale[:, None]).astype(np.int8), scale


STORED = "k long, m long, cells array<int>, code binary, factor float, rounded binary, scale float"
NAMES = ["k", "m", "cells", "code", "factor", "rounded", "scale"]


def stored(distinct: DataFrame, centres: dict[int, tuple[int, np.ndarray]]) -> DataFrame:
    """One row for each vector: its cells, code, factor and rounded form."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packs = batch.column("x").to_pylist()
            forms: list[tuple] = [()] * len(packs)
            for length in {len(p) for p in packs}:
                rows = [i for i, p in enumerate(packs) if len(p) == length]
                for start in range(0, len(rows), 1024):
                    part = rows[start : start + 1024]
                    x = unit([packs[i] for i in part])
                    cells = [[-(length // 8)]] * len(part)
                    if length // 8 in centres:
                        first, centre = centres[length // 8]
                        best = np.argsort(-(x.astype(np.float32) @ centre.T), 1, kind="stable")[:, :PROBES]
                        cells = np.sort(best + first, 1).tolist()
                    for i, own, code, factor, rounded, scale in zip(part, cells, *coded(x)):
                        forms[i] = own, code.tobytes(), float(factor), rounded.tobytes(), float(scale)
            columns = zip(*forms) if forms else ((),) * 5
            kinds = (pa.list_(pa.int32()), pa.binary(), pa.float32(), pa.binary(), pa.float32())
            yield pa.record_batch(
                [batch.column("k"), batch.column("m"), *(pa.array(list(c), t) for c, t in zip(columns, kinds))], names=NAMES
            )

    return distinct.select("k", "m", "x").mapInArrow(placed, STORED)


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def join_up(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining the pairs (a, b); the lesser root wins."""
    while len(a):
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        apart = low != high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(parent, high[apart], low[apart])
        parent = roots(parent)
    return parent


def first_shared(left: np.ndarray, right: np.ndarray, cell: int) -> np.ndarray:
    """Whether ``cell`` is the least cell that both rows name."""
    same = left[:, :, None] == right[:, None, :]
    least = np.where(same, left[:, :, None], NO_CELL).min((1, 2))
    return least == cell


def ordered(group: pa.Table) -> pa.Table:
    """Rows of a pair of blocks, one block after the other, always in the same order."""
    return group.combine_chunks().sort_by([("chunk", "ascending"), ("k", "ascending")])


def candidates(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (a, b) of an ordered pair of blocks whose estimate plus bound reaches the limit, in parts.

    A pair is looked at in the first cell that both vectors share. The rounding of ``a``
    shifts a coordinate by half a scale at most, which the bound includes.
    """
    cell, chunk = group.column("cell")[0].as_py(), group.column("chunk").to_numpy()
    own = group.column("i")[0].as_py() == group.column("j")[0].as_py()
    listed = group.column("cells").to_pylist()
    width = max(map(len, listed))
    cells = np.array([own_cells + [NO_CELL] * (width - len(own_cells)) for own_cells in listed], np.int64)
    rounded = np.stack([np.frombuffer(r, np.int8) for r in group.column("rounded").to_pylist()])
    size = rounded.shape[1]
    signs = signs_of(np.stack([np.frombuffer(c, np.uint8) for c in group.column("code").to_pylist()]), size)
    factor, scale = (group.column(c).to_numpy().astype(np.float64) for c in ("factor", "scale"))
    bound = ERRORS * np.sqrt(np.maximum(0, 1 - factor**2)) / factor / np.sqrt(max(1, size - 1))

    split = 0 if own else int(np.searchsorted(chunk, chunk[0], "right"))
    rows = len(chunk) if own else split
    for first in range(0, rows, ROWS):
        last = min(first + ROWS, rows)
        start = first if own else split
        product = rounded[first:last].astype(np.float32) @ signs[start:].T
        most = (product + np.float32(np.sqrt(size) / 2)) * scale[first:last, None] / factor[start:] + bound[start:]
        a, b = np.nonzero(most >= LIMIT)
        a, b = a + first, b + start
        if own:
            a, b = a[a < b], b[a < b]
        for part in range(0, len(a), 1 << 16):
            p, q = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
            once = first_shared(cells[p], cells[q], cell)
            yield p[once], q[once]


def promising(group: pa.Table) -> pa.Table:
    """The vectors of a pair of blocks that are in a candidate pair."""
    group = ordered(group)
    hit = np.zeros(len(group), bool)
    for a, b in candidates(group):
        hit[a] = hit[b] = True
    return group.select(["cell", "i", "j", "chunk", "k"]).filter(pa.array(hit))


def compare(group: pa.Table) -> pa.Table:
    """Links of one pair of blocks: for each vector its linked vectors, and a spanning edge."""
    group = ordered(group)
    keys, weight = group.column("k").to_numpy(), group.column("m").to_numpy()
    x = unit(group.column("x").to_pylist())
    found = np.zeros(len(x), np.int64)
    parent = np.arange(len(x))
    for p, q in candidates(group):
        exact = np.einsum("ij,ij->i", x[p], x[q]) >= LIMIT
        p, q = p[exact], q[exact]
        found += np.bincount(p, weight[q], len(x)).astype(np.int64)
        found += np.bincount(q, weight[p], len(x)).astype(np.int64)
        parent = join_up(parent, p, q)
    linked = np.flatnonzero(found)
    return pa.table({"k": keys[linked], "n": found[linked], "root": keys[parent[linked]]})


def pairs(index: DataFrame, distinct: DataFrame) -> DataFrame:
    """(k, n, root): what each pair of blocks found for each of its vectors."""
    placed = index.withColumn("cell", F.explode("cells"))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("chunks"))
    rows = placed.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int"))
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "cell", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", *NAMES
    )
    hits = cut(met.groupBy("cell", "i", "j").applyInArrow(promising, "cell int, i int, j int, chunk int, k long"))
    fetched = hits.join(index, "k").join(distinct.select("k", "x"), "k")
    return fetched.groupBy("cell", "i", "j").applyInArrow(compare, "k long, n long, root long")


def members(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """vec_id and k of every vector; for each k: n_links, component_id and k of the row that stays (first)."""
    keyed = cut(classes(vectors))
    distinct = keyed.where("k IS NOT NULL").groupBy("k").agg(
        F.count("*").alias("m"), F.min("vec_id").alias("least"), F.first("x").alias("x")
    )
    distinct = cut(distinct)
    centres = centroids(distinct, distinct.count())
    found = cut(pairs(cut(stored(distinct, centres)), distinct))
    counts = found.groupBy("k").agg(F.sum("n").alias("n"))
    found_roots = components(found.select(F.col("k").alias("a"), F.col("root").alias("b")))
    rooted = distinct.select("k", "m", "least").join(
        found_roots.select(F.col("node").alias("k"), "root"), "k", "left"
    ).withColumn("root", F.coalesce("root", "k"))
    order = F.struct(F.col("least").isNull(), "least", "k")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min_by("k", order).alias("first"))
    known = rooted.join(counts, "k", "left").join(named, "root").select(
        F.col("k").alias("_k"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id", "first"
    )
    return keyed.select("vec_id", "k"), known


def near(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    keyed, known = members(vectors)
    result = keyed.join(known, F.col("k") == F.col("_k"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def deduplicated(vectors: DataFrame) -> DataFrame:
    """``vectors`` with one row of each component: that with the least vec_id, of one id with the least vector key.

    Rows are decided by id and vector, so unlike vectors under one id, or none, all
    stay, and so do vectors that can link with nothing.
    """
    own, first, least = free(vectors, "_key", "_first", "_least")
    schema = T.StructType([*vectors.schema.fields, T.StructField(own, T.LongType())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([vector_key(value)[0] for value in batch.column("embedding")], pa.int64())
            yield pa.record_batch([*batch.columns, keys], names=[*batch.schema.names, own])

    known = members(vectors)[1].where(F.col("_k") == F.col("first"))
    known = known.select(F.col("first").alias(first), F.col("component_id").alias(least))
    rows = vectors.mapInArrow(keyed, schema)
    same = (F.col(own) == F.col(first)) & F.col("vec_id").cast("long").eqNullSafe(F.col(least))
    stay = rows.where(F.col(own).isNotNull()).join(known, same, "left_semi").dropDuplicates(["vec_id", own])
    return stay.unionByName(rows.where(F.col(own).isNull())).drop(own)

"""Approximate nearest neighbours by a permutation index.

A few vectors of the table are pivots. Every vector is represented by its nearest
pivots in order of distance, and posted in the inverted file of each of them with
the pivot's place in that order. A query reads the files of its own pivots; what
it adds up there is the footrule distance of the two orders. The vectors with the
least footrule distance are reranked by the true distance.

How it is spread: rows are dealt by the region of their nearest pivot. Small
regions share a bucket, large ones have several blocks, and each block is an
index of its own, so a task holds one block and one chunk of queries. A query
first searches the bucket of its own region. The distance of its last neighbour
there rules out, by the triangle inequality and without loss, regions that lie
too far away; it then searches the others. On data with clusters few buckets
are read; on data without structure all of them are, in blocks.

The depth of reranking is a share of each block's leading orders, so that many near
copies, whose orders begin alike, count once and crowd nothing out; every row that
is as near by footrule as the last of them is reranked. Pivots are kept apart for the
same reason. Recall against brute force is measured in the tests.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, are neither queries nor candidates; vectors of another length are no
candidates; each row is a query or candidate by itself, also if its id or vector
repeats; a candidate without id is returned without one, after those that tie
with it; an empty table, or one without queries, gives no rows; other columns are
ignored. A distance beyond the largest double is infinite.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import cut
from skyledger.llm.vectors import NO_ID, met, numbered, packed, stacked

NEIGHBOURS, EVERY = 10, 100
#: Pivots of a length, and how many of them a vector is posted under.
PIVOTS, POSTED = 128, 96
#: Rows the pivots are drawn from at most, and their bytes.
SAMPLE, SAMPLE_BYTES = 8192, 1 << 26
#: Rows of a block, queries of a chunk.
BLOCK, CHUNK = 8192, 4096
#: Share of a block's leading orders that is reranked, and the least number; a leading order is that of so many pivots.
DEPTH, LEAST, LEADING = 1 / 6, 256, 4
#: Vectors the pivots are chosen from, for each pivot.
CHOICE = 4
FIELDS = ["r", "vec_id", "x", "size", "order"]


def nonzero(x: np.ndarray) -> bytes | None:
    return x.tobytes() if x.any() else None


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots; one of the table is enough to rank by, so they are not exact."""
    with np.errstate(all="ignore"):
        squares = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (x @ pivots.T)
        return np.sqrt(np.maximum(squares, 0))


def pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """Pivots of every length that the sample holds; the sample is bounded in rows and bytes."""
    longest = rows.agg(F.max("size")).first()[0] or 1
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * longest)))
    drawn = rows.select("x", "size", F.xxhash64("r", F.lit(17)).alias("h")).orderBy("h").limit(most).collect()
    found: dict[int, dict[bytes, None]] = {}
    for row in drawn:
        own = found.setdefault(row.size, {})
        if len(own) < CHOICE * PIVOTS:
            own[bytes(row.x)] = None
    return {size: apart(stacked(pa.array(list(own), pa.binary()), "<f8", size)) for size, own in found.items()}


def apart(x: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Up to ``most`` rows, first those that are no near copies of one taken before."""
    away = np.nan_to_num(distances(x, x), nan=np.inf)
    np.fill_diagonal(away, np.inf)
    # Near copies may be the most, so what is far apart tells how far is far.
    least = np.quantile(away.min(1), 0.9) / 2 if len(x) > 1 else 0.0
    taken: list[int] = []
    for i in range(len(x)):
        if away[i, taken].min(initial=np.inf) >= least:
            taken.append(i)
    rest = sorted(set(range(len(x))) - set(taken))
    return x[(taken + rest)[:most]]


def indexed(rows: DataFrame, chosen: dict[int, np.ndarray]) -> DataFrame:
    """r, vec_id, x, size, order (nearest pivots, 16 bits each), region (nearest pivot) and its distance.

    Vectors of a length without pivots lie in one region.
    """

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            orders = np.full(len(batch), b"", object)
            region, far = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                if int(size) not in chosen:
                    continue
                away = distances(stacked(batch.column("x").take(pa.array(at)), "<f8", int(size)), chosen[int(size)])
                nearest = np.argsort(away, 1, kind="stable")[:, :POSTED].astype("<u2")
                orders[at] = [order.tobytes() for order in nearest]
                region[at], far[at] = nearest[:, 0], np.nan_to_num(away[np.arange(len(at)), nearest[:, 0]], nan=np.inf)
            yield pa.record_batch(
                [*(batch.column(c) for c in ("r", "vec_id", "x", "size")), pa.array(orders, pa.binary()), pa.array(region), pa.array(far)],
                names=[*FIELDS, "region", "far"],
            )

    schema = "r long, vec_id long, x binary, size int, order binary, region int, far double"
    return rows.select("r", "vec_id", "x", "size").mapInArrow(post, schema)


class Inverted:
    """The inverted files of one block: for each pivot the rows posted under it, and the pivot's places there."""

    def __init__(self, orders: np.ndarray):
        rows, self.posted = orders.shape
        pivot = orders.ravel().astype(np.int64)
        by = np.argsort(pivot, kind="stable")
        self.starts = np.searchsorted(pivot[by], np.arange(PIVOTS + 1))
        self.rows = by // max(1, self.posted)
        # A pivot at place i of one order and j of the other takes 2 * (posted - max(i, j)) off the footrule distance.
        self.worth = (self.posted - by % max(1, self.posted)).astype(np.int32)
        self.held = rows
        lead, group = np.unique(orders[:, :LEADING], axis=0, return_inverse=True)
        self.by_lead = np.argsort(group, kind="stable")
        self.lead_starts = np.searchsorted(group[self.by_lead], np.arange(len(lead)))

    def nearness(self, order: np.ndarray) -> np.ndarray:
        """By how much each row's footrule distance to ``order`` is below that of unlike orders, halved."""
        total = np.zeros(self.held, np.int32)
        for place, pivot in enumerate(order):
            a, b = self.starts[pivot], self.starts[pivot + 1]
            total[self.rows[a:b]] += np.minimum(self.worth[a:b], len(order) - place)
        return total

    def near(self, order: np.ndarray) -> np.ndarray:
        """Rows to rerank: all that are as near as the last leading order within the depth."""
        leads = len(self.lead_starts)
        depth = max(LEAST, int(DEPTH * leads))
        if not self.posted or leads <= depth:
            return np.arange(self.held)
        like = self.nearness(order)
        best = np.maximum.reduceat(like[self.by_lead], self.lead_starts)
        return np.flatnonzero(like >= np.partition(best, -depth)[-depth])


def search(group: pa.Table) -> pa.Table:
    """The nearest rows of one block for each query of a chunk, no farther than the query's limit."""
    asked = group.column("is_query").to_numpy()
    size = group.column("size")[0].as_py()
    x = stacked(group.column("x"), "<f8", size)
    orders = group.column("order").to_pylist()
    width = len(orders[0]) // 2
    orders = np.frombuffer(b"".join(orders), "<u2").reshape(len(x), width)
    r, limit = group.column("r").to_numpy(), group.column("limit").to_numpy()
    ids = group.column("vec_id").fill_null(NO_ID).to_numpy()
    none = group.column("vec_id").is_null().to_numpy()
    rows, queries = np.flatnonzero(~asked), np.flatnonzero(asked)
    files, block = Inverted(orders[rows]), x[rows]
    found: list[tuple] = []
    for q in queries:
        near = files.near(orders[q])
        with np.errstate(all="ignore"):
            gap = block[near] - x[q]
            score = np.sqrt((gap * gap).sum(1))
        use = (score <= limit[q]) & (r[rows[near]] != r[q])
        near, score = near[use], score[use]
        best = np.lexsort((none[rows[near]], ids[rows[near]], score))[:NEIGHBOURS]
        found += [(r[q], ids[q], r[rows[i]], None if none[rows[i]] else ids[rows[i]], s) for i, s in zip(near[best], score[best])]
    columns = list(zip(*found)) or [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["q", "query_id", "r", "vec_id", "score"])


def ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("q").orderBy("score", F.col("vec_id").asc_nulls_last(), "r")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEIGHBOURS)


def searched(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """The best rows of the buckets that each query is sent to."""
    columns = [*FIELDS, "bucket", "limit"]
    groups = met(rows.withColumn("limit", F.lit(0.0)).select(*columns), queries.select(*columns), ["size", "bucket"], BLOCK, CHUNK)
    fields = "q long, query_id long, r long, vec_id long, score double"
    return groups.groupBy("size", "bucket", "block", "chunk").applyInArrow(search, fields)


def regions(rows: DataFrame) -> dict[int, list[tuple[int, int, float, float]]]:
    """For each length its regions: (region, bucket, least and greatest distance from the pivot).

    There are at most ``PIVOTS`` regions a length. A bucket is a run of regions
    with ``BLOCK`` rows together, or one larger region.
    """
    counts = rows.groupBy("size", "region").agg(F.count("*").alias("n"), F.min("far").alias("low"), F.max("far").alias("high"))
    layout: dict[int, list[tuple[int, int, float, float]]] = {}
    held: dict[int, int] = {}
    for row in sorted(counts.collect()):
        before = held.get(row.size, 0)
        layout.setdefault(row.size, []).append((row.region, before // BLOCK, row.low, row.high))
        held[row.size] = before + row.n
    return layout


def sent(queries: DataFrame, chosen: dict[int, np.ndarray], layout: dict[int, list[tuple[int, int, float, float]]]) -> DataFrame:
    """A row for each query and each bucket, but its own, that may hold a row within its limit."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            limit, home = batch.column("limit").to_numpy(), batch.column("bucket").to_numpy()
            source: list[int] = []
            target: list[int] = []
            for size in np.unique(sizes):
                if int(size) not in chosen:
                    continue
                at = np.flatnonzero(sizes == size)
                away = distances(stacked(batch.column("x").take(pa.array(at)), "<f8", int(size)), chosen[int(size)])
                own = away.min(1)
                open_to: dict[int, np.ndarray] = {}
                for region, bucket, low, high in layout[int(size)]:
                    far = away[:, region]
                    with np.errstate(all="ignore"):
                        least = np.maximum(np.maximum(far - high, low - far), (far - own) / 2)
                        slack = 1e-6 * (far + high)  # pivot distances are not exact
                    # Anything that is not a number opens the region.
                    may = ~(least - slack > limit[at])
                    open_to[bucket] = open_to.get(bucket, np.zeros(len(at), bool)) | may
                for bucket, may in open_to.items():
                    rows = at[may & (home[at] != bucket)]
                    source += rows.tolist()
                    target += [bucket] * len(rows)
            taken = batch.select([*FIELDS, "limit"]).take(pa.array(source, pa.int64()))
            yield pa.record_batch([*taken.columns, pa.array(target, pa.int32())], names=[*FIELDS, "limit", "bucket"])

    fields = "r long, vec_id long, x binary, size int, order binary, limit double, bucket int"
    return queries.select(*FIELDS, "limit", "bucket").mapInArrow(send, fields)


def nearest(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id and score of the neighbours of every row whose id is divisible by ``EVERY``."""
    kept = numbered(packed(vectors, nonzero))
    chosen = pivots(kept)
    posted = cut(indexed(kept, chosen))
    layout = regions(posted)
    bucket = F.lit(0)
    places = [(size, region, b) for size, own in layout.items() for region, b, _, _ in own if b]
    if places:
        pairs = [v for size, region, b in places for v in (F.lit(f"{size}:{region}"), F.lit(b))]
        bucket = F.coalesce(F.create_map(*pairs)[F.concat_ws(":", "size", "region")], F.lit(0))
    rows = posted.withColumn("bucket", bucket.cast("int"))
    queries = rows.where(F.col("vec_id") % EVERY == 0)
    first = cut(ranked(searched(rows, queries.withColumn("limit", F.lit(float("inf"))))))
    last = first.where(F.col("rank") == NEIGHBOURS).select(F.col("q").alias("r"), F.col("score").alias("limit"))
    bounded = queries.join(last, "r", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    others = searched(rows, cut(sent(bounded, chosen, layout)))
    both = ranked(first.drop("rank").unionByName(others))
    return both.select("query_id", "rank", "vec_id", "score")

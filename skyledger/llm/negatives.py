"""Hard negatives by threshold joins with a shortened inverted index.

An anchor's positives are its best rows of the same label; its hard negatives are
the best rows of other labels in a window below each positive's score. Both are
threshold joins: all rows whose inner product with the anchor reaches a threshold.
A block of rows is indexed by dimension, the strongest dimension first, but a row
is posted only until the norm of its remaining dimensions, times the greatest
anchor norm, is below the threshold: what is left out cannot lift a row over it
alone. Scores are added up over the posted dimensions, and a pair is dropped as
soon as its sum and the product of both remaining norms stay below the threshold.
Thresholds start high and are lowered until the anchor's windows are full or wholly
covered, so every result is exact.

How it is spread: rows of a label (for positives) or of all labels (for negatives)
are dealt into blocks by their number, anchors into chunks; a task holds one block
and one chunk, hands back as many rows of an anchor as a window needs, and the
best of all blocks are taken by a window function. A label with a third of all
rows has as many blocks as its rows need. An anchor is sent only to blocks of
vectors of its own length.

Scores are whole numbers: each component x becomes floor(256 * x). Defined cases:
rows with a null label, a null vector or a null or non-finite component take no
part, nor do rows whose squared whole vector reaches 2**62, whose products need
not fit in a long; vectors of unlike length are not compared; an empty vector has
the product 0 with others; each row is an anchor or partner by itself, also if its
id repeats; rows without id keep their label, are no anchors and come last among
ties; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import cut
from skyledger.llm.vectors import NO_ID, first_rows, met, numbered, packed, stacked

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
SCALE = 256
#: A window's scores lie between these parts of the positive's, in hundredths.
WINDOW = (50, 95)
#: Every so-manieth id has the next label, of so many.
MOVED, LABELS = 7, 10
#: Rows of a block, anchors of a chunk, dimensions added up before pairs are dropped.
BLOCK, CHUNK, STEP = 16384, 1024, 8
#: Share of pairs below which they are added up one by one.
FEW = 0.05
#: Pairs of one block that are held at once.
PAIRS = 1 << 21
#: Thresholds as parts of the greatest product an anchor can have in a block; the last one covers everything.
LADDER = (0.8, 0.6, 0.45, 0.3, 0.2, 0.1, 0.0, -2.0)
#: Doubles hold whole numbers exactly below this.
EXACT = float(1 << 53)
FIELDS = ["r", "vec_id", "label", "x", "size"]


def whole(x: np.ndarray) -> bytes | None:
    """floor(256 * x) as 64-bit numbers; nothing if products need not fit in a long."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
        if float((scaled * scaled).sum()) >= float(1 << 62):
            return None
    return scaled.astype("<i8").tobytes()


def moved_label() -> Column:
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % MOVED == 0, (label + 1) % LABELS).otherwise(label).alias("label")


def usable(vectors: DataFrame) -> DataFrame:
    """r, vec_id, label, x and size of the rows that take part."""
    return numbered(packed(vectors.where(F.col("label").isNotNull()), whole, moved_label()))


class Block:
    """Rows of one block with their dimensions from the strongest on, and the norms of what remains of each row."""

    def __init__(self, x: np.ndarray):
        self.turn = np.argsort(-(x.astype(float) ** 2).sum(0), kind="stable")
        self.x = x[:, self.turn]
        self.rest = self.remaining(self.x)

    @staticmethod
    def remaining(x: np.ndarray) -> np.ndarray:
        """Column j: norm of each row from dimension j on, rounded up; the last column is 0."""
        squares = np.cumsum((x.astype(float) ** 2)[:, ::-1], axis=1)[:, ::-1]
        return np.concatenate([np.sqrt(squares) * (1 + 1e-9), np.zeros((len(x), 1))], axis=1)

    def reaching(self, anchors: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, score) of all pairs whose product is at least ``least`` of the anchor, some anchors at a time."""
        if not len(self.x):
            return
        width = max(1, PAIRS // len(self.x))
        for first in range(0, len(anchors), width):
            found = self.joined(anchors[first : first + width][:, self.turn], least[first : first + width])
            yield found[0] + first, found[1], found[2]

    def joined(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        left = self.remaining(q)
        size = self.x.shape[1]
        safe = left[:, 0].max(initial=0) * self.rest[:, 0].max(initial=0) < EXACT
        kind = np.float64 if safe else np.int64
        low, strong = least.min(initial=0), left[:, 0].max(initial=0)
        # A row's posted dimensions: up to where the others alone stay below every threshold.
        posted = np.full(len(self.x), size + 1)
        if low > 0:
            posted = np.where(self.rest * strong >= low, np.arange(1, size + 2), 0).max(1)
        rows = np.argsort(-posted, kind="stable")[: np.count_nonzero(posted)]
        x, rest, posted = self.x[rows].astype(kind), self.rest[rows], posted[rows]
        # While most pairs may still reach a threshold, those of posted dimensions are added up as a matrix.
        score, begun, end, held = np.zeros((len(q), len(rows)), kind), 0, min(STEP, size), len(rows)
        left_over: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
        while True:
            score[:, :held] += q[:, begun:end].astype(kind) @ x[:held, begun:end].T
            may = score[:, :held] + left[:, [end]] * rest[:held, end] >= least[:, None]
            more = int(np.searchsorted(-posted, -end, "left"))
            if end == size or np.count_nonzero(may) < FEW * may.size:
                more = 0
            # Rows that are posted no further leave with the pairs that the rest of them may still lift.
            a, b = np.nonzero(may[:, more:])
            left_over.append((a, b + more, score[a, b + more], end))
            if not more:
                break
            held, begun, end = more, end, min(2 * end, size)
        found = []
        for a, b, score, end in left_over:
            for begun in range(end, size, STEP):
                end = min(begun + STEP, size)
                score = score + np.einsum("ij,ij->i", q[a, begun:end].astype(kind), x[b, begun:end])
                may = score + left[a, end] * rest[b, end] >= least[a]
                a, b, score = a[may], b[may], score[may]
            found.append((a, rows[b], score))
        a, b, score = (np.concatenate(c) for c in zip(*found))
        by = np.argsort(a, kind="stable")
        a, b, score = a[by], b[by], score[by]
        return a, b, score.astype(np.int64)


def columns(group: pa.Table, name: str) -> np.ndarray:
    return group.column(name).fill_null(NO_ID).to_numpy() if name == "vec_id" else group.column(name).to_numpy()


def told(ids: np.ndarray, none: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=none)


def sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of a group, places of its rows and of its anchors."""
    asked = group.column("is_query").to_numpy()
    size = group.column("size")[0].as_py()
    return stacked(group.column("x"), "<i8", size), np.flatnonzero(~asked), np.flatnonzero(asked)


def positives_of(group: pa.Table) -> pa.Table:
    """Each anchor's best other rows of one block of its label."""
    x, rows, anchors = sides(group)
    r, ids, none = columns(group, "r"), columns(group, "vec_id"), group.column("vec_id").is_null().to_numpy()
    block = Block(x[rows])
    bound = np.sqrt((x[anchors].astype(float) ** 2).sum(1)) * block.rest[:, 0].max(initial=0) + 1
    found: list[tuple[np.ndarray, ...]] = []
    open_now = np.arange(len(anchors))
    for part in LADDER:
        missing = []
        for a, b, score in block.reaching(x[anchors[open_now]], part * bound[open_now]):
            other = r[rows[b]] != r[anchors[open_now[a]]]
            a, b, score = a[other], b[other], score[other]
            best = first_rows(a, (-score, ids[rows[b]], none[rows[b]], r[rows[b]]), POSITIVES)
            enough = np.bincount(a[best], minlength=len(open_now)) >= POSITIVES
            done = enough[a[best]] | (part == LADDER[-1])
            found.append((anchors[open_now[a[best][done]]], rows[b[best][done]], score[best][done]))
            missing.append(enough)
        open_now = open_now[~np.logical_or.reduce(missing)] if missing else open_now[:0]
        if not len(open_now):
            break
    a, b, score = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return pa.table(
        {"a": r[a], "anchor_id": ids[a], "p": r[b], "positive_id": told(ids[b], none[b]), "positive_score": score}
    )


def negatives_of(group: pa.Table) -> pa.Table:
    """The best rows of one block in the window below each positive of each anchor."""
    x, rows, anchors = sides(group)
    r, ids, none = columns(group, "r"), columns(group, "vec_id"), group.column("vec_id").is_null().to_numpy()
    label = columns(group, "label")
    block = Block(x[rows])
    windows = [(np.array(w, np.int64)) for w in group.column("windows").take(pa.array(anchors)).to_pylist()]
    # (anchor's place, positive, least and greatest score) of every window that can hold a row.
    place = np.repeat(np.arange(len(anchors)), [len(w) // 2 for w in windows])
    flat = np.concatenate(windows).reshape(-1, 2) if len(place) else np.zeros((0, 2), np.int64)
    positive, top = flat[:, 0], flat[:, 1]
    low, high = lowest(top), highest(top)
    use = low <= high
    place, positive, top, low, high = place[use], positive[use], top[use], low[use], high[use]
    found: list[tuple[np.ndarray, ...]] = []
    open_now = np.arange(len(place))
    for part in LADDER:
        if not len(open_now):
            break
        asked = np.unique(place[open_now])
        least, most = np.full(len(anchors), np.iinfo(np.int64).max), np.full(len(anchors), np.iinfo(np.int64).min)
        np.minimum.at(least, place[open_now], low[open_now])
        np.maximum.at(most, place[open_now], high[open_now])
        # The threshold goes down from the highest window's top to the lowest one's bottom.
        down = least[asked] + np.maximum(part, 0) * (most[asked].astype(float) - least[asked])
        full = np.zeros(len(place), bool)
        for a, b, score in block.reaching(x[anchors[asked]], down):
            a = asked[a]
            unlike = label[rows[b]] != label[anchors[a]]
            a, b, score = a[unlike], b[unlike], score[unlike]
            starts = np.searchsorted(a, np.arange(len(anchors) + 1))
            mine = open_now[(starts[place[open_now] + 1] > starts[place[open_now]])]
            counts = starts[place[mine] + 1] - starts[place[mine]]
            w = np.repeat(mine, counts)
            pair = np.arange(len(w)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts[place[mine]], counts)
            inside = (score[pair] >= low[w]) & (score[pair] <= high[w])
            w, pair = w[inside], pair[inside]
            partner = rows[b[pair]]
            best = first_rows(w, (-score[pair], ids[partner], none[partner], r[partner]), NEGATIVES)
            w, pair = w[best], pair[best]
            enough = np.bincount(w, minlength=len(place)) >= NEGATIVES
            done = enough[w] | (part <= 0)
            found.append((anchors[place[w[done]]], w[done], rows[b[pair[done]]], score[pair[done]]))
            full |= enough
        open_now = open_now[~full[open_now]] if part > 0 else open_now[:0]
    a, w, b, score = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
    return pa.table(
        {
            "a": r[a], "anchor_id": ids[a], "p": positive[w], "positive_score": top[w],
            "n": r[b], "negative_id": told(ids[b], none[b]), "negative_score": score,
        }
    )


def lowest(top: np.ndarray) -> np.ndarray:
    """Least whole score n with 50 * top <= 100 * n, without products that overflow."""
    whole_part, rest = top // 100, top % 100
    return whole_part * WINDOW[0] + -(-(rest * WINDOW[0]) // 100)


def highest(top: np.ndarray) -> np.ndarray:
    """Greatest whole score n with 100 * n <= 95 * top."""
    whole_part, rest = top // 100, top % 100
    return whole_part * WINDOW[1] + rest * WINDOW[1] // 100


def best_of(found: DataFrame, keys: list[str], score: str, id_: str, row: str, most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.col(id_).asc_nulls_last(), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def positives(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """a, anchor_id, p, positive_id, positive_score and rank: each anchor's best other rows of its label."""
    groups = met(rows.select(*FIELDS), anchors.select(*FIELDS), ["size", "label"], BLOCK, CHUNK)
    fields = "a long, anchor_id long, p long, positive_id long, positive_score long"
    found = groups.groupBy("size", "label", "block", "chunk").applyInArrow(positives_of, fields)
    return best_of(found, ["a"], "positive_score", "positive_id", "p", POSITIVES)


def mined(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of every anchor."""
    rows = usable(vectors)
    anchors = rows.where(F.col("vec_id") % EVERY == 0)
    paired = cut(positives(rows, anchors))
    windows = paired.groupBy("a").agg(F.flatten(F.collect_list(F.array("p", "positive_score"))).alias("windows"))
    asked = cut(anchors.join(windows, anchors.r == windows.a).select(*FIELDS, "windows"))
    empty = F.lit(None).cast("array<bigint>").alias("windows")
    groups = met(rows.select(*FIELDS, empty), asked, ["size"], BLOCK, CHUNK)
    fields = "a long, anchor_id long, p long, positive_score long, n long, negative_id long, negative_score long"
    found = groups.groupBy("size", "block", "chunk").applyInArrow(negatives_of, fields)
    best = best_of(found, ["a", "p"], "negative_score", "negative_id", "n", NEGATIVES)
    names = paired.select("a", "p", "positive_id")
    return best.join(names, ["a", "p"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

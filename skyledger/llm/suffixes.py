"""Suffix-array dedup: a sparse distributed suffix array, merged with known common prefixes.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
earlier, in a lesser document or further up in the same one.

1. Documents equal to a lesser one are set aside; all their bytes go.
2. Every string of ``LENGTH`` bytes names one anchor inside it: the place of its
   least ``GRAM``-byte hash. Equal strings name anchors at the same place, so a
   string can only be a repetition if its anchor's gram occurs twice. Tasks
   exchange packed gram hashes to find those; few anchors are left.
3. The suffixes at these anchors are sorted in runs. Equal contexts within a run
   are kept once, the later ones are repetitions already. Runs are front-coded,
   each suffix as its common prefix with the one before and the rest, and
   exchanged by ranges of a sampled set of splitters.
4. A range is merged by a loser tree that keeps the common prefix of each run's
   head with the last output: heads with different prefixes need no comparison,
   equal ones are compared behind the known prefix only.
5. In the merged order, strings that start ``o`` bytes before their anchor are
   equal where the common prefix stays at least ``LENGTH - o`` and the ``o`` bytes
   on the left agree. All but the earliest of them are removed.

6. A gram with more than ``HOT`` anchors is left out of the ranges, which cannot be
   cut inside a gram. Contexts that differ within a run send each of their strings
   as a 128-bit hash instead, and equal hashes meet in buckets of bounded size.

Only anchors are sorted, yet every string is decided, each by its own anchor.

Defined cases: a null text is empty; texts below ``LENGTH`` bytes lose nothing
unless a longer text is meant; documents are ordered by ``doc_id`` (nulls first),
those of one id by text hash; rows equal in id and text are one document whose
result is given for each; columns beside ``doc_id`` and ``text`` are ignored by
``removed`` and kept by ``deduplicated``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import Rolling, cut, slices, some_texts, split_texts, squeezed, unsqueezed, utf8

LENGTH, GRAM = 100, 32
#: Anchor candidates inside a string.
REACH = LENGTH - GRAM + 1
#: Suffixes of a run and, about, of a range; documents sampled for the splitters.
RUN, RANGE, SAMPLED = 30_000, 30_000, 2_000
#: Documents whose anchors a task holds at once, about.
HELD = 2_000
#: Anchors whose grams one task counts, about.
COUNTED = 1 << 18
#: Anchors of a gram that one task may hold; strings of such grams, and decided spans, in one task, about.
HOT, STRINGS, SPANS = 100_000, 1 << 20, 1 << 20


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and ``uid``, a unique number in document order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        return rows.withColumn("uid", F.col("doc_id"))
    # Ids that are not unique: number the distinct (id, text hash) within ranges of ids.
    hashed = rows.withColumn("_h", F.xxhash64("text"))
    keys = cut(hashed.select("doc_id", "_h").distinct())
    inside = Window.partitionBy("_part").orderBy("doc_id", "_h")
    keys = keys.withColumn("_part", F.coalesce(F.floor(F.col("doc_id") / 1_000_000), F.lit(-(1 << 60))))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = keys.groupBy("_part").agg(F.count("*").alias("_n"))
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    keys = keys.join(parts, "_part").select(
        F.col("doc_id").alias("_id"),
        F.col("_h").alias("_k"),
        (F.col("_first") + F.row_number().over(inside)).cast("long").alias("uid"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_k"))
    return hashed.join(keys, same).select("doc_id", "text", "uid")


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of all strings of the texts of a buffer: gram hash, row, place, least and greatest offset.

    A string starts ``offset`` bytes before its anchor; an anchor's strings are
    those with offsets from the least to the greatest.
    """
    size = len(data)
    nothing = tuple(np.zeros(0, np.int64) for _ in range(5))
    if size < LENGTH:
        return nothing
    starts = np.arange(size - GRAM + 1)
    grams = Rolling(data).of(starts, starts + GRAM)
    bits = np.uint64(max(1, int(size).bit_length()))
    least = (grams >> bits << bits) | starts.astype(np.uint64)
    width = 1
    while 2 * width <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < REACH:
        least = np.minimum(least[: len(least) - (REACH - width)], least[REACH - width :])
    sizes = np.diff(offsets)
    ends = np.repeat(offsets[1:], sizes)
    valid = np.flatnonzero(starts[: len(least)] + LENGTH <= ends[: len(least)])
    if not len(valid):
        return nothing
    place = (least[valid] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.searchsorted(offsets, valid, "right") - 1
    # A string that crosses into no other text has its anchor in its own text.
    change = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    last = np.concatenate([change[1:], [len(valid)]]) - 1
    at = place[change]
    return grams[at], row[change], at - offsets[row[change]], at - valid[last], at - valid[change]


def batch_anchors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchors`` of parts of a batch, rows counted from its start."""
    data, offsets = utf8(batch.column("text"))
    for first, last in slices(offsets):
        part = offsets[first : last + 1]
        found = anchors(data[part[0] : part[-1]], part - part[0])
        yield found[0], found[1] + first, *found[2:]


def grouped_blocks(keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Columns as bytes for each distinct key."""
    order = np.argsort(keys, kind="stable")
    found, first = np.unique(keys[order], return_index=True)
    parts = [np.split(c[order], first[1:]) for c in columns]
    for i, key in enumerate(found.tolist()):
        yield key, [p[i].tobytes() for p in parts]


def name_bits(total: int) -> int:
    """Bits of the buckets in which grams are counted; a gram's name has 32 more."""
    return max(4, int(np.ceil(np.log2(max(1, total / (REACH + 1) * 2 / COUNTED)))))


def repeated_anchors(docs: DataFrame, total: int) -> DataFrame:
    """(uid, places) of the anchors whose gram occurs more than once; several rows a document.

    Rows without ``uid`` have names and counts of hot grams in ``places``.
    """
    bits, known_groups = name_bits(total), max(64, -(-total // (REACH * SPANS)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(first, HELD) for b in batches for first in range(0, len(b), HELD)):
            parts = list(batch_anchors(batch))
            if not parts:
                continue
            grams, rows, places = (np.concatenate([p[i] for p in parts]) for i in range(3))
            uids = batch.column("uid").to_numpy()[rows]
            bucket = (grams >> np.uint64(64 - bits)).astype(np.int64)
            name = (grams >> np.uint64(32 - bits)).astype(np.uint32)
            full = grams >> np.uint64(32 - bits)
            _, first, inverse, counts = np.unique(full, return_index=True, return_inverse=True, return_counts=True)
            times = counts[inverse].astype(np.uint32)
            # Repeated within the batch: known already, so only the first one is exchanged.
            known = np.flatnonzero(counts[inverse] > 1)
            first = np.sort(first)
            out = []
            for rows, keys in ((known, -1 - uids[known] // 16 % known_groups), (first, bucket[first])):
                # Steps between the numbers of neighbours are small and pack well.
                steps = np.zeros(len(rows), np.int64)
                order = np.argsort(keys, kind="stable")
                steps[order] = np.diff(uids[rows][order], prepend=0)
                starts = np.unique(keys[order], return_index=True)[1]
                steps[order[starts]] = uids[rows][order[starts]]
                for key, (a, b, c, d) in grouped_blocks(keys, name[rows], steps, places[rows].astype(np.uint32), times[rows]):
                    # Most grams are there once: their counts are not sent.
                    d = squeezed(d) if key >= 0 and (np.frombuffer(d, np.uint32) > 1).any() else b""
                    out.append((key, a, squeezed(b), squeezed(c), d))
            columns = list(zip(*out)) or [[], [], [], [], []]
            yield pa.record_batch(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                names=["bucket", "names", "uids", "places", "times"],
            )

    def counted(group: pa.Table) -> pa.Table:
        names = np.concatenate([np.frombuffer(b.as_py(), np.uint32) for b in group.column("names")])
        uids = np.concatenate([np.cumsum(np.frombuffer(unsqueezed(b.as_py()), np.int64)) for b in group.column("uids")])
        places = np.concatenate([np.frombuffer(unsqueezed(b.as_py()), np.uint32) for b in group.column("places")])
        bucket, hot = group.column("bucket")[0].as_py(), []
        if bucket >= 0:
            found, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
            again = counts[inverse] > 1
            uids, places = uids[again], places[again]
            times = [
                np.frombuffer(unsqueezed(t.as_py()), np.uint32) if len(t.as_py()) else np.ones(len(b.as_py()) // 4, np.uint32)
                for b, t in zip(group.column("names"), group.column("times"))
            ]
            sums = np.bincount(inverse, np.concatenate(times), len(found)).astype(np.int64)
            most = sums > HOT
            full = (found[most].astype(np.int64)) + (bucket << 32)
            hot = [(None, np.stack([full, sums[most]], 1).tobytes())] if most.any() else []
        rows = hot + [(uid, blocks[0]) for uid, blocks in grouped_blocks(uids, places)]
        return pa.table(
            {"uid": pa.array([r[0] for r in rows], pa.int64()), "places": pa.array([r[1] for r in rows], pa.binary())}
        )

    blocks = docs.select("uid", "text").mapInArrow(
        packed, "bucket long, names binary, uids binary, places binary, times binary"
    )
    return blocks.groupBy("bucket").applyInArrow(counted, "uid long, places binary")


def chosen(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Gram hash, uid, place, offsets and context bytes of the repeated anchors of a batch.

    A context is the right side, ``LENGTH`` bytes padded with zeros, and the left
    side read backwards, padded too; both only as far as the anchor's strings go.
    """
    wanted = [
        np.unique(np.concatenate([np.frombuffer(p, np.uint32) for p in row])) if row else np.zeros(0, np.uint32)
        for row in batch.column("places").to_pylist()
    ]
    uids = batch.column("uid").to_numpy()
    data, offsets = utf8(batch.column("text"))
    sizes = np.array([len(w) for w in wanted])
    listed = (np.repeat(np.arange(len(wanted)), sizes).astype(np.int64) << 32) | np.concatenate([*wanted, np.zeros(0)]).astype(np.int64)
    for gram, row, place, low, high in batch_anchors(batch):
        keep = np.isin((row << 32) | place, listed)
        gram, row, place, low, high = gram[keep], row[keep], place[keep], low[keep], high[keep]
        at = offsets[row] + place
        steps = np.arange(LENGTH)
        right = np.where(steps < (LENGTH - low)[:, None], data[np.minimum(at[:, None] + steps, len(data) - 1)], 0)
        steps = np.arange(REACH - 1)
        left = np.where(steps < high[:, None], data[np.maximum(at[:, None] - 1 - steps, 0)], 0)
        yield gram, uids[row], place, low, high, right.astype(np.uint8), left.astype(np.uint8)


def splitters(active: DataFrame, documents: int, ranges: int) -> list[bytes]:
    """Boundaries of ranges of suffixes, from the suffixes of a bounded sample of documents."""
    if ranges <= 1:
        return []
    chance = min(1.0, SAMPLED / max(1, documents))

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, right, _ in chosen(batch):
                picked = right[:: max(1, len(right) // 4096), :GRAM]
                yield pa.record_batch([pa.array([r.tobytes() for r in picked], pa.binary())], names=["start"])

    drawn = active.where(F.pmod(F.xxhash64("uid", F.lit(9)), F.lit(1 << 40)) < int(chance * (1 << 40)))
    found = sorted({row.start for row in drawn.mapInArrow(starts, "start binary").collect()})
    return sorted({bytes(found[len(found) * i // ranges]) for i in range(1, ranges)}) if found else []


def prefix_lengths(right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it; 0 for the first."""
    out = np.zeros(len(right), np.int64)
    if len(right) > 1:
        apart = right[1:] != right[:-1]
        out[1:] = np.where(apart.any(1), apart.argmax(1), LENGTH)
        out[1:] = np.minimum(out[1:], np.minimum(sizes[1:], sizes[:-1]))
    return out


RUNS = "range int, uids binary, places binary, lows binary, highs binary, prefixes binary, rests binary, lefts binary"
RUN_NAMES = [field.split()[0] for field in RUNS.split(", ")]


def strings(low: np.ndarray, high: np.ndarray, right: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit hash (as two numbers) of every string of some anchors, the anchor's row and the string's offset."""
    hashes = []
    for a, b, after, before in zip(low.tolist(), high.tolist(), right, left[:, ::-1]):
        whole = before.tobytes() + after.tobytes()
        for offset in range(a, b + 1):
            start = REACH - 1 - offset
            hashes.append(hashlib.blake2b(whole[start : start + LENGTH], digest_size=16).digest())
    counts = high - low + 1
    row = np.repeat(np.arange(len(low)), counts)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + low[row]
    return np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2), row, offset


def later_strings(hashes: np.ndarray, uid: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the strings in order of hash, uid and start, and which of them have an equal one before."""
    order = np.lexsort((start, uid, hashes[:, 1], hashes[:, 0]))
    again = np.zeros(len(order), bool)
    again[1:] = (hashes[order[1:]] == hashes[order[:-1]]).all(1)
    return order, again


def runs(active: DataFrame, bounds: list[bytes], total: int, hot: np.ndarray) -> DataFrame:
    """Front-coded sorted runs by range; negative ranges hold byte spans that are decided already.

    ``hot`` has names and counts of hot grams, at most one for ``HOT`` anchors; ranges above the last one hold
    hashes of their strings.
    """
    shift = np.uint64(32 - name_bits(total))
    span_groups = max(64, -(-total // (REACH * SPANS)))
    buckets = max(1, -(-int(hot[:, 1].sum()) * REACH // (2 * STRINGS)))

    def hot_strings(uid, place, low, high, right, left) -> Iterator[tuple]:
        hashes, row, offset = strings(low, high, right, left)
        owner, start = uid[row], (place[row] - offset).astype(np.int32)
        order, again = later_strings(hashes, owner, start)
        late, order = order[again], order[~again]
        spans = np.stack([start[late], start[late] + LENGTH], 1).astype(np.int32)
        for key, blocks in grouped_blocks(owner[late] // 16, owner[late], spans):
            yield (-1 - key % span_groups, blocks[0], blocks[1], b"", b"", b"", b"", b"")
        bucket = (hashes[order, 0] % np.uint64(buckets)).astype(np.int64)
        for key, blocks in grouped_blocks(bucket, owner[order], start[order], hashes[order]):
            yield (len(bounds) + 1 + key, blocks[0], blocks[1], b"", b"", b"", blocks[2], b"")

    def run(parts: list[tuple[np.ndarray, ...]]) -> Iterator[tuple]:
        gram, uid, place, low, high, right, left = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((place, uid))
        whole = np.concatenate([right, left, low[:, None].astype(np.uint8), high[:, None].astype(np.uint8)], 1)[order]
        kind = np.dtype((np.void, whole.shape[1]))
        by_bytes = np.argsort(np.ascontiguousarray(whole).view(kind).ravel(), kind="stable")
        order, whole = order[by_bytes], whole[by_bytes]
        later = np.concatenate([[False], (whole[1:] == whole[:-1]).all(1)])
        again = order[later]
        spans = np.stack([place[again] - high[again], place[again] - low[again] + LENGTH], 1).astype(np.int32)
        for key, blocks in grouped_blocks(uid[again] // 16, uid[again], spans):
            yield (-1 - key % span_groups, blocks[0], blocks[1], b"", b"", b"", b"", b"")
        order = order[~later]
        if len(hot):
            is_hot = np.isin((gram[order] >> shift).astype(np.int64), hot[:, 0])
            those, order = order[is_hot], order[~is_hot]
            # Few at a time: each has up to REACH strings.
            for first in range(0, len(those), RUN // 4):
                yield from hot_strings(*(c[those[first : first + RUN // 4]] for c in (uid, place, low, high, right, left)))
        uid, place, low, high, right, left = (c[order] for c in (uid, place, low, high, right, left))
        size = LENGTH - low
        starts = [r.tobytes() for r in right[:, :GRAM]]
        cuts = [0, *(bisect_left(starts, b) for b in bounds), len(starts)]
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                known = prefix_lengths(right[a:b], size[a:b])
                rest = right[a:b][(np.arange(LENGTH) >= known[:, None]) & (np.arange(LENGTH) < size[a:b, None])]
                behind = left[a:b][np.arange(REACH - 1) < high[a:b, None]]
                yield (
                    number, uid[a:b].tobytes(), place[a:b].astype(np.int32).tobytes(), low[a:b].astype(np.uint8).tobytes(),
                    high[a:b].astype(np.uint8).tobytes(), known.astype(np.uint8).tobytes(),
                    squeezed(rest.tobytes()), squeezed(behind.tobytes()),
                )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for first in range(0, len(batch), 500):
                for part in chosen(batch.slice(first, 500)):
                    held.append(part)
                    size += len(part[0])
                    if size >= RUN:
                        yield pa.RecordBatch.from_pylist([dict(zip(RUN_NAMES, r)) for r in run(held)], RUN_SCHEMA)
                        held, size = [], 0
        if size:
            yield pa.RecordBatch.from_pylist([dict(zip(RUN_NAMES, r)) for r in run(held)], RUN_SCHEMA)

    return active.select("uid", "text", "places").mapInArrow(made, RUNS)


RUN_SCHEMA = pa.schema([("range", pa.int32())] + [(name, pa.binary()) for name in RUN_NAMES[1:]])


def entries(block: dict) -> Iterator[tuple]:
    """Suffixes of a front-coded run in order: suffix, known prefix, uid, place, low, high, left side."""
    uids, places = np.frombuffer(block["uids"], np.int64).tolist(), np.frombuffer(block["places"], np.int32).tolist()
    rests, lefts, suffix, rest, left = unsqueezed(block["rests"]), unsqueezed(block["lefts"]), b"", 0, 0
    for uid, place, low, high, known in zip(uids, places, block["lows"], block["highs"], block["prefixes"]):
        more = LENGTH - low - known
        suffix = suffix[:known] + rests[rest : rest + more]
        rest += more
        yield suffix, known, uid, place, low, high, lefts[left : left + high]
        left += high


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that share their first ``known`` bytes."""
    size = min(len(a), len(b))
    if a[known:size] == b[known:size]:
        return size
    low, high = known, size
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def merged(sources: list[Iterator[tuple]]) -> Iterator[tuple[int, tuple]]:
    """All entries in order of their suffixes, each with its common prefix with the one before.

    A loser tree in which every head carries its common prefix with the last
    output. Of two heads the one with the longer prefix comes first, and the
    other's prefix holds for the pair; only equal prefixes need a comparison,
    which starts behind them.
    """
    count = len(sources)
    heads: list[tuple | None] = [next(s, None) for s in sources]
    known = [0] * count
    losers = [-1] * count

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two heads; the loser's prefix then is that with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        shared = common_prefix(x[0], y[0], known[a])
        first = x[0][shared : shared + 1] <= y[0][shared : shared + 1]
        winner, loser = (a, b) if first else (b, a)
        known[loser] = shared
        return winner, loser

    def build(node: int) -> int:
        if node >= count:
            return node - count
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1) if count > 1 else 0
    while heads[top] is not None:
        entry = heads[top]
        yield known[top], entry
        following = next(sources[top], None)
        heads[top] = following
        if following is not None:
            known[top] = following[1]
        node = (top + count) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


def repetitions(ordered: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, int, int]]:
    """(uid, start, end) of byte spans whose strings all start earlier too."""
    seen: list[dict[bytes, tuple[int, int]]] = [{} for _ in range(REACH)]
    pending: tuple | None = None

    def decide(entry: tuple) -> Iterator[tuple[int, int, int]]:
        _, _, uid, place, low, high, left = entry
        own, run = (uid, place), None
        for offset in range(low, high + 1):
            held = seen[offset]
            key = left[:offset]
            first = held.setdefault(key, own)
            if first < own:
                run = offset if run is None else run
                continue
            if own < first:
                held[key] = own
                yield first[0], first[1] - offset, first[1] - offset + LENGTH
            if run is not None:
                yield uid, place - offset + 1, place - run + LENGTH
                run = None
        if run is not None:
            yield uid, place - high, place - run + LENGTH

    for shared, entry in ordered:
        if shared < GRAM:
            # Another gram: nothing that came before can repeat from here on.
            if pending is None:
                for held in seen:
                    held.clear()
            pending = entry
            continue
        if pending is not None:
            yield from decide(pending)
            pending = None
        for held in seen[: LENGTH - shared]:
            held.clear()
        yield from decide(entry)


def merge_range(group: pa.Table, ranges: int) -> pa.Table:
    """(uid, spans) that one range of suffixes, a bucket of strings or a set of decided spans removes."""
    if group.column("range")[0].as_py() >= ranges:
        uids = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in group.column("uids")])
        starts = np.concatenate([np.frombuffer(b.as_py(), np.int32) for b in group.column("places")])
        hashes = np.concatenate([np.frombuffer(b.as_py(), np.uint64) for b in group.column("rests")]).reshape(-1, 2)
        order, again = later_strings(hashes, uids, starts)
        uids, starts = uids[order[again]], starts[order[again]]
        spans = np.stack([starts, starts + LENGTH], 1).astype(np.int32)
    elif group.column("range")[0].as_py() < 0:
        uids = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in group.column("uids")])
        spans = np.concatenate([np.frombuffer(b.as_py(), np.int32) for b in group.column("places")]).reshape(-1, 2)
    else:
        found = list(repetitions(merged([entries(block) for block in group.to_pylist()])))
        table = np.array(found, np.int64).reshape(-1, 3)
        uids, spans = table[:, 0], table[:, 1:].astype(np.int32)
    rows = list(grouped_blocks(uids, spans))
    return pa.table(
        {"uid": pa.array([k for k, _ in rows], pa.int64()), "spans": pa.array([b[0] for _, b in rows], pa.binary())}
    )


def union(spans: np.ndarray) -> np.ndarray:
    """Maximal spans of a set of (start, end)."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    opens = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(spans) - 1]])
    return np.stack([spans[opens, 0], reach[last]], 1)


def find(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For numbered documents: uids that equal a lesser document, and (uid, text, spans) of others that lose bytes."""
    narrow = cut(rows.select("uid", F.octet_length("text").alias("n"), F.md5(F.col("text").cast("binary")).alias("m")))
    firsts = narrow.groupBy("m", "n").agg(F.min("uid").alias("_first"), F.count("*").alias("_copies")).where("_copies > 1")
    copies = cut(narrow.join(firsts, ["m", "n"]).where("uid > _first").select("uid"))
    total = narrow.agg(F.sum("n")).first()[0] or 0
    # Copies are told apart without moving the other texts.
    maybe, others = split_texts(rows.select("uid", "text"), copies, "uid")
    texts = others.unionByName(maybe.join(copies, "uid", "left_anti"))
    counted = cut(repeated_anchors(texts, total))
    names = [np.frombuffer(row.places, np.int64).reshape(-1, 2) for row in counted.where("uid IS NULL").collect()]
    hot = np.concatenate([np.zeros((0, 2), np.int64), *names])
    places = counted.where("uid IS NOT NULL")
    sums = places.agg(F.sum(F.octet_length("places") / 4), F.countDistinct("uid")).first()
    count, documents = int(sums[0] or 0), sums[1]
    listed = places.groupBy("uid").agg(F.collect_list("places").alias("places"))
    active = cut(some_texts(rows.select("uid", "text"), places, "uid").dropDuplicates(["uid"]).join(listed, "uid"))
    bounds = splitters(active, documents, -(-count // RANGE))
    merge = lambda group: merge_range(group, len(bounds) + 1)
    found = cut(runs(active, bounds, total, hot).groupBy("range").applyInArrow(merge, "uid long, spans binary"))
    spans = found.groupBy("uid").agg(F.collect_list("spans").alias("spans"))
    # Only texts that lose bytes are moved again.
    return copies, some_texts(active.select("uid", "text"), found, "uid").join(spans, "uid")


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    rows = numbered(docs)
    copies, losing = find(rows)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for uid, text, spans in zip(*(batch.column(c) for c in ("uid", "text", "spans"))):
                gone, kept = kept_bytes(text.as_py(), spans.as_py())
                out.append((uid.as_py(), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["uid", "r", "s", "kept"])

    lost = losing.mapInArrow(digested, "uid long, r long, s long, kept string")
    whole = copies.select(F.col("uid").alias("_copy"))
    size = F.octet_length("text").cast("long")
    every = (
        rows.select("doc_id", "uid", size.alias("n_bytes"), F.sha2("text", 256).alias("_sha"))
        .join(lost, "uid", "left")
        .join(whole.distinct(), F.col("uid") == F.col("_copy"), "left")
    )
    gone = F.col("_copy").isNotNull() & (F.col("n_bytes") >= LENGTH)
    return every.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("r", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("s", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept", "_sha")).alias("kept_sha256"),
    )


def kept_bytes(text: str, spans: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Maximal removed spans of a text and the bytes that stay."""
    raw = text.encode()
    gone = union(np.concatenate([np.frombuffer(s, np.int32).reshape(-1, 2) for s in spans]).astype(np.int64))
    at, parts = 0, []
    for start, end in gone.tolist():
        parts.append(raw[at:start])
        at = end
    return gone, b"".join([*parts, raw[at:]])


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id and ``kept`` (the bytes that stay, cut characters as they are) of every document."""
    rows = numbered(docs)
    copies, losing = find(rows)

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [kept_bytes(t.as_py(), s.as_py())[1] for t, s in zip(batch.column("text"), batch.column("spans"))]
            yield pa.record_batch([batch.column("uid"), pa.array(kept, pa.binary())], names=["uid", "_kept"])

    lost = losing.mapInArrow(stay, "uid long, _kept binary")
    whole = copies.select(F.col("uid").alias("_copy")).distinct()
    raw = F.col("text").cast("binary")
    gone = F.col("_copy").isNotNull() & (F.octet_length("text") >= LENGTH)
    every = rows.join(lost, "uid", "left").join(whole, F.col("uid") == F.col("_copy"), "left")
    return every.select("doc_id", F.when(gone, F.lit(b"")).otherwise(F.coalesce("_kept", raw)).alias("kept"))

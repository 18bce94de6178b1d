"""N-gram Jaccard join with a token-group matrix.

Documents become sets of hashed word shingles; equal sets are one set from then
on. Similar sets are partitioned into groups, the matrix holds the union of each
group's tokens, and a query set opens only groups whose union can hold enough of
its tokens: a set links with a member only if the group holds 80 % of the set.

How the groups come about and which sets meet which groups:

* Every set has a prefix of a fifth of its tokens in one global order. Linked
  sets share a prefix token. Frequent tokens come last in that order, so passages
  that many documents share are in few prefixes. The order's counts cover all
  documents; only the ``HOT_MOST`` most frequent tokens are kept, which bounds
  what is sent to the tasks and changes work, never results.
* Sets that share a prefix token are candidates, unless sizes, the token's places
  in both prefixes, or parity bits rule a link out: a set has a row of
  ``SIGN_BITS`` parity bits, and two sets differ in at least as many tokens as
  their rows differ in bits. These bounds are exact.
* Each set is compared with the most typical of its candidates. What links is one
  class, and the classes, in chunks of ``GROUP`` sets, are the groups of the
  matrix. Within a class no pair has to be compared again.
* All other candidates become queries of a set to the group of its candidate. The
  matrix is stored, one row with the token union of each group that is asked; queries
  meet these rows, and only groups where one qualifies are opened and compared member
  by member.
* Tokens that more than ``LONG`` sets share take part twice: first each set meets
  the most typical one, then, once the classes are known, sets of different
  classes meet in blocks, and blocks of one class never meet each other.

So every linked pair is either within a class, compared, or ruled out by a bound,
and the components are exact, up to collisions of 64-bit hashes.

Defined cases: null and empty texts have an empty set and link with nothing; a
text of one to four words is one shingle; repeated rows are documents with equal
sets; rows that share an id, or have none, are documents of their own, told apart by
a 64-bit hash of their text; a null ``doc_id`` never names a component unless it has
no other document; columns beside ``doc_id`` and ``text`` are ignored by ``linked``
and kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import Rolling, cut, free, mixed, slices, some_texts, split_texts, utf8
from skyledger.llm.components import components

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Sets a group holds at most, about, and queries a task compares with a group.
GROUP, QUERIES_A_TASK = 64, 256
#: Sets that share a token and are paired at once; sets of a block beyond that; postings of a task, about.
LONG, BLOCK, POSTINGS = 32, 1024, 200_000
#: A token in at least HOT_LEAST sets is frequent; the HOT_MOST most frequent are known to all tasks.
HOT_LEAST, HOT_MOST = 8, 1 << 18
#: What names a pair of blocks of a token.
PAIR = ("token", "alone_a", "unit_a", "chunk_a", "alone_b", "unit_b", "chunk_b")
#: Tokens counted together in one task, about.
COUNTED = 1 << 22
#: Parity bits of a set.
SIGN_BITS = 2048

FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def token_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a buffer."""
    upper = (data >= 65) & (data <= 90)
    data = data + (upper * np.uint8(32))
    word = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    hashes = Rolling(data).of(starts, ends)
    bounds = np.searchsorted(starts, offsets)
    size = len(hashes)
    every = np.zeros(max(0, size - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        every += hashes[k : k + len(every)] * FACTORS[k]
    every = mixed(every)
    sets = []
    for first, last in zip(bounds[:-1], bounds[1:]):
        if last - first >= SHINGLE:
            sets.append(np.unique(every[first : last - SHINGLE + 1]))
        elif last > first:
            short = (hashes[first:last] * FACTORS[: last - first]).sum(dtype=np.uint64)
            sets.append(mixed(np.array([short + np.uint64(last - first)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def batch_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and token set of every text of a batch."""
    data, offsets = utf8(batch.column("text"))
    for first, last in slices(offsets):
        part = offsets[first : last + 1]
        for row, tokens in enumerate(token_sets(data[part[0] : part[-1]], part - part[0]), first):
            yield row, tokens


def set_key(tokens: np.ndarray) -> int:
    """One number for a set, whatever the order of its tokens; as a signed long."""
    total = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mixed(np.array([total + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def parity(tokens: np.ndarray) -> bytes:
    """Each token flips one bit."""
    flips = np.bincount((tokens & np.uint64(SIGN_BITS - 1)).astype(np.int64), minlength=SIGN_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def may_link(sizes: np.ndarray, bits: np.ndarray, n: int, own: np.ndarray) -> np.ndarray:
    """Which sets (rows of 64-bit words) the sizes and parity bits do not rule out for one set.

    Linked sets differ in at most (n + m) * (100 - PERCENT) / (100 + PERCENT) tokens.
    """
    apart = np.bitwise_count(bits ^ own).sum(1, dtype=np.int64)
    near_size = 100 * np.minimum(sizes, n) >= PERCENT * np.maximum(sizes, n)
    return near_size & (apart * (100 + PERCENT) <= (sizes + n) * (100 - PERCENT))


def words64(packs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packs), np.uint64).reshape(-1, SIGN_BITS // 64)


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text) and text; doc_id alone does not name a row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def set_keys(docs: DataFrame) -> DataFrame:
    """doc_id, h, n (tokens of the set), k (the set's key, null for an empty set) and its parity bits."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, bits = [], [], []
            for _, tokens in batch_sets(batch):
                sizes.append(len(tokens))
                keys.append(set_key(tokens) if len(tokens) else None)
                bits.append(parity(tokens))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("h"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(bits, pa.binary()),
                ],
                names=["doc_id", "h", "n", "k", "bits"],
            )

    return texts_of(docs).mapInArrow(keyed, "doc_id long, h long, n long, k long, bits binary")


def short_names(tokens: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` + 32 bits of the tokens in the lower half of all hashes."""
    return tokens >> np.uint64(63 - bits - 32)


def lower_half(tokens: np.ndarray) -> np.ndarray:
    return tokens[: int(np.searchsorted(tokens, np.uint64(1 << 63)))]


def frequent(docs: DataFrame, total: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The most frequent tokens: bits of their names, names (sorted) and counts.

    Counts come from the lower half of the hash range of all sets: prefixes are
    taken from there unless most of a set is frequent. Tasks exchange packed
    32-bit names by range, so counting moves two bytes a token of the corpus.
    """
    bits = max(4, int(np.ceil(np.log2(max(1, total / 2 / COUNTED)))))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            names = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            held.clear()
            buckets = (names >> np.uint64(32)).astype(np.int64)
            found, first = np.unique(buckets, return_index=True)
            blocks = np.split(names.astype("<u4"), first[1:]) if len(found) else []
            return pa.record_batch(
                [pa.array(found, pa.int64()), pa.array([b.tobytes() for b in blocks], pa.binary())],
                names=["bucket", "block"],
            )

        for batch in batches:
            for _, tokens in batch_sets(batch):
                held.append(short_names(lower_half(tokens), bits))
                if len(held) >= 4096:
                    yield flush()
        yield flush()

    def counted(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        names = np.concatenate([np.frombuffer(b.as_py(), "<u4") for b in group.column("block")])
        names, counts = np.unique(names, return_counts=True)
        keep = counts >= HOT_LEAST
        full = (names[keep].astype(np.int64)) + (bucket << 32)
        return pa.table({"name": pa.array(full, pa.int64()), "count": pa.array(counts[keep], pa.int64())})

    blocks = docs.select("text").mapInArrow(named, "bucket long, block binary")
    counts = blocks.groupBy("bucket").applyInArrow(counted, "name long, count long")
    kept = counts.orderBy(F.desc("count"), "name").limit(HOT_MOST).toArrow()
    names = kept.column("name").to_numpy().astype(np.uint64)
    order = np.argsort(names)
    return bits, names[order], kept.column("count").to_numpy()[order]


def postings(docs: DataFrame, hot: tuple[int, np.ndarray, np.ndarray]) -> DataFrame:
    """(token, k, n, place, typical) for the prefix tokens that several sets share; places count from 0."""
    bits, names, counts = hot

    def ordered(tokens: np.ndarray) -> tuple[np.ndarray, float]:
        frequency = np.zeros(len(tokens), np.int64)
        low = lower_half(tokens)
        if len(names) and len(low):
            own = short_names(low, bits)
            at = np.minimum(np.searchsorted(names, own), len(names) - 1)
            frequency[: len(low)] = np.where(names[at] == own, counts[at], 0)
        prefix = len(tokens) - (PERCENT * len(tokens) + 99) // 100 + 1
        order = np.argsort(frequency, kind="stable")[:prefix]
        return tokens[order], float(np.log2(frequency + 1.0).sum() / len(tokens))

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            tokens_of, keys, sizes, scores = [], [], [], []
            for _, tokens in batch_sets(batch):
                key = set_key(tokens) if len(tokens) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                prefix, typical = ordered(tokens)
                tokens_of.append(prefix)
                keys.append(key)
                sizes.append(len(tokens))
                scores.append(typical)
            each = [len(t) for t in tokens_of]
            yield pa.record_batch(
                [
                    pa.array(np.concatenate(tokens_of).view(np.int64) if each else [], pa.int64()),
                    pa.array(np.repeat(np.array(keys, np.int64), each)),
                    pa.array(np.repeat(np.array(sizes, np.int32), each)),
                    pa.array(np.concatenate([np.arange(e, dtype=np.int32) for e in each]) if each else [], pa.int32()),
                    pa.array(np.repeat(np.array(scores, np.float32), each)),
                ],
                names=["token", "k", "n", "place", "typical"],
            )

    rows = docs.select("text").mapInArrow(posted, "token long, k long, n int, place int, typical float")
    by_token = Window.partitionBy("token")
    shared = rows.withColumn("_low", F.min("k").over(by_token)).withColumn("_high", F.max("k").over(by_token))
    return shared.where("_low <> _high").select("token", "k", "n", "place", "typical").distinct()


def token_table(docs: DataFrame, distinct: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """(k, n, tokens) of the wanted sets, each from its least document; ``repeated`` if one may be there twice."""
    wanted = distinct.join(wanted.select("k").distinct(), "k", "left_semi").select(
        "k", F.col("least.doc_id").alias("_id"), F.col("least.h").alias("_h")
    )
    texts = some_texts(texts_of(docs), wanted.select(F.col("_id").alias("doc_id"), F.col("_h").alias("h")), "doc_id", "h")
    if repeated:
        texts = texts.dropDuplicates(["doc_id", "h"])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    texts = texts.join(wanted, same).select("k", "text")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, packs = [], [], []
            expected = batch.column("k").to_pylist()
            for row, tokens in batch_sets(batch):
                if len(tokens) and set_key(tokens) == expected[row]:
                    keys.append(expected[row])
                    sizes.append(len(tokens))
                    packs.append(tokens.tobytes())
            yield pa.record_batch(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(packs, pa.binary())],
                names=["k", "n", "tokens"],
            )

    return texts.mapInArrow(packed, "k long, n int, tokens binary")


def common(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(left) > len(right):
        left, right = right, left
    at = np.searchsorted(right, left)
    at[at == len(right)] = 0
    return int((right[at] == left).sum())


def links(left: np.ndarray, right: np.ndarray) -> bool:
    low, high = sorted((len(left), len(right)))
    if 100 * low < PERCENT * high:
        return False
    both = common(left, right)
    return 100 * both >= PERCENT * (low + high - both)


def may_meet(n: np.ndarray, place: np.ndarray, m: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sets of sizes n and m may link if their first common token has these places.

    All common tokens are at or behind the first one.
    """
    both = 1 + np.minimum(n - place - 1, m - other - 1)
    sizes = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    return sizes & ((100 + PERCENT) * both >= PERCENT * (n + m))


def short_pairs(posts: DataFrame, total: int) -> DataFrame:
    """Pairs (a, b), a below b, of sets that share a token and may link by size and place."""

    def paired(group: pa.Table) -> pa.Table:
        token, k, n, place = (group.column(c).to_numpy() for c in ("token", "k", "n", "place"))
        order = np.lexsort((k, token))
        token, k, n, place = token[order], k[order], n[order].astype(np.int64), place[order].astype(np.int64)
        found = []
        # Rows of one token are neighbours: pair each with those up to LONG rows on.
        for step in range(1, min(LONG, len(token))):
            same = np.flatnonzero(token[step:] == token[:-step])
            if not len(same):
                break
            other = same + step
            good = may_meet(n[same], place[same], n[other], place[other])
            found.append(np.stack([k[same[good]], k[other[good]]], 1))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    buckets = F.pmod(F.xxhash64("token"), F.lit(-(-total // POSTINGS) or 1)).alias("bucket")
    rows = posts.select(buckets, "token", "k", "n", "place")
    return rows.groupBy("bucket").applyInArrow(paired, "a long, b long").distinct()


def thinned(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and parity bits do not rule out."""
    own = distinct.select(F.col("k").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    other = distinct.select(F.col("k").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            left, right = (words64(batch.column(c).to_pylist()) for c in ("bits_a", "bits_b"))
            yield batch.select(["a", "b"]).filter(pa.array(may_link(n, left, m, right)))

    return pairs.join(own, "a").join(other, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(
        kept, "a long, b long"
    )


def meeting(posts: DataFrame, classes: DataFrame) -> DataFrame:
    """The postings (token, k, n, place) with class c, once for each pair of blocks they take part in.

    A pair is named by ``PAIR`` columns, and ``second`` tells its sides apart. A class of
    more than ``BLOCK`` sets under a token is a unit of its own there (``alone``), the
    smaller classes of the token are one unit together. Units are paired before their
    blocks, so the blocks of one large class are never set against each other.
    """
    rows = posts.join(classes, F.col("k") == F.col("node"), "left").withColumn("c", F.coalesce("root", "k"))
    sizes = rows.groupBy("token", "c").agg(F.count("*").alias("sets"), (F.count("*") > BLOCK).alias("alone"))
    several = sizes.groupBy("token").agg(F.min("c").alias("_low"), F.max("c").alias("_high")).where("_low <> _high")
    sizes = sizes.join(several.select("token"), "token").withColumn("unit", F.when(F.col("alone"), F.col("c")).otherwise(0))
    sizes = cut(sizes)
    units = sizes.groupBy("token", "alone", "unit").agg(
        F.ceil(F.sum("sets") / F.lit(BLOCK)).cast("int").alias("chunks"), F.count("*").alias("held")
    )
    left, right = (units.toDF("token", *(f"{c}_{side}" for c in units.columns[1:])) for side in "ab")
    same = (F.col("alone_a") == F.col("alone_b")) & (F.col("unit_a") == F.col("unit_b"))
    ahead = F.struct("alone_a", "unit_a") < F.struct("alone_b", "unit_b")
    pairs = left.join(right, "token").where(ahead | (same & ~F.col("alone_a") & (F.col("held_a") > 1)))
    pairs = cut(pairs.withColumn("same", same).drop("held_a", "held_b"))

    rows = rows.join(sizes.select("token", "c", "alone", "unit"), ["token", "c"])
    sides = []
    for side, other, second in (("a", "b", False), ("b", "a", True)):
        taking = [rows["token"] == pairs["token"], rows["alone"] == pairs[f"alone_{side}"], rows["unit"] == pairs[f"unit_{side}"]]
        sent = rows.join(pairs, taking).drop(pairs["token"])
        sent = sent.withColumn(f"chunk_{side}", F.pmod(F.xxhash64("k", F.lit(2)), F.col(f"chunks_{side}")).cast("int"))
        sent = sent.withColumn(f"chunk_{other}", F.explode(F.sequence(F.lit(0), F.col(f"chunks_{other}") - 1)))
        # Within the shared unit each pair of blocks once, and a block against itself with one side.
        once = F.col("chunk_a") < F.col("chunk_b") if second else F.col("chunk_a") <= F.col("chunk_b")
        sides.append(sent.where(~F.col("same") | once).select(*PAIR, F.lit(second).alias("second"), "same", "k", "n", "place", "c"))
    return sides[0].unionByName(sides[1])


def long_pairs(posts: DataFrame, distinct: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of different classes that share a token of very many sets and may link.

    A token's sets meet in pairs of blocks, so no task holds them all.
    """

    def compared(group: pa.Table) -> pa.Table:
        k, n, place, c = (group.column(x).to_numpy() for x in ("k", "n", "place", "c"))
        n, place = n.astype(np.int64), place.astype(np.int64)
        bits = words64(group.column("bits").to_pylist())
        own = group.column("same")[0].as_py() and group.column("chunk_a")[0].as_py() == group.column("chunk_b")[0].as_py()
        second = group.column("second").to_numpy(zero_copy_only=False)
        low = np.flatnonzero(~second)
        high = low if own else np.flatnonzero(second)
        found = []
        for at in low:
            good = (c[high] != c[at]) & may_meet(n[at], place[at], n[high], place[high])
            if own:
                good &= k[high] > k[at]
            near = high[good]
            near = near[may_link(n[near], bits[near], int(n[at]), bits[at])]
            found += [(min(int(k[at]), int(x)), max(int(k[at]), int(x))) for x in k[near]]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    rows = meeting(posts, classes).join(distinct.select("k", "bits"), "k")
    return rows.groupBy(*PAIR).applyInArrow(compared, "a long, b long").distinct()


def class_links(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """The linked ones of the pairs (a, b)."""
    own = tokens.select(F.col("k").alias("a"), F.col("tokens").alias("x"))
    other = tokens.select(F.col("k").alias("b"), F.col("tokens").alias("y"))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("x"), batch.column("y"))
            good = [links(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) for x, y in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(own, "a").join(other, "b").select("a", "b", "x", "y").mapInArrow(verified, "a long, b long")


def met(rows: DataFrame, queries: DataFrame, work, schema: str) -> DataFrame:
    """``work(rows, queries)`` for each group (c, g) and chunk of the sets that query it."""
    tasks = queries.groupBy("c", "g").agg(F.ceil(F.count("*") / F.lit(QUERIES_A_TASK)).cast("int").alias("tasks"))
    salt = F.pmod(F.xxhash64("k", F.lit(1)), F.col("tasks")).cast("int")
    asked = queries.join(tasks, ["c", "g"]).withColumn("tasks", salt)
    asked = asked.toDF(*[f"q_{c}" for c in asked.columns])
    every = F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))
    rows = rows.join(tasks, ["c", "g"]).withColumn("tasks", every)
    both = rows.groupBy("c", "g", "tasks").cogroup(asked.groupBy("q_c", "q_g", "q_tasks"))
    return both.applyInArrow(work, schema)


def unpacked(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(tokens.as_py(), np.uint64) for tokens in column]


def unions(held: DataFrame) -> DataFrame:
    """The matrix: one row (c, g, union) for each group, from the (c, g, tokens) of its sets."""

    def joined(group: pa.Table) -> pa.Table:
        union = np.unique(np.concatenate(unpacked(group.column("tokens"))))
        return pa.table(
            {
                "c": group.column("c").slice(0, 1),
                "g": group.column("g").slice(0, 1),
                "union": pa.array([union.tobytes()], pa.binary()),
            }
        )

    return held.select("c", "g", "tokens").groupBy("c", "g").applyInArrow(joined, "c long, g int, union binary")


def qualifying(row: pa.Table, asking: pa.Table) -> pa.Table:
    """Queries (k, c, g) that hold enough of the group's union to link with a member."""
    union = unpacked(row.column("union"))
    union = union[0] if union else np.zeros(0, np.uint64)
    good = [100 * common(query, union) >= PERCENT * len(query) for query in unpacked(asking.column("q_tokens"))]
    return asking.select(["q_k", "q_c", "q_g"]).rename_columns(["k", "c", "g"]).filter(pa.array(good, pa.bool_()))


def opened(group: pa.Table, asking: pa.Table) -> pa.Table:
    """Links of the queries with members of their group; one link each.

    The members are one class already: the first link joins the query to all.
    """
    found = []
    held, names = unpacked(group.column("tokens")), group.column("k").to_pylist()
    for key, query in zip(asking.column("q_k").to_pylist(), unpacked(asking.column("q_tokens"))):
        first = next((name for name, tokens in zip(names, held) if links(query, tokens)), None)
        if first is not None:
            found.append((key, first))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def matrix_links(pairs: DataFrame, docs: DataFrame, distinct: DataFrame, classes: DataFrame, repeated: bool) -> DataFrame:
    """Links (a, b) between sets of different classes, by way of the token-group matrix.

    ``pairs`` holds every pair that no bound has ruled out. Of a pair, the first
    set is the query and the second one names the group. Queries meet the stored
    union of the group first; the members move only for those that qualify.
    """
    sets = pairs.select(F.col("a").alias("k")).union(pairs.select("b")).distinct()
    named = sets.join(classes, F.col("k") == F.col("node"), "left").select("k", F.coalesce("root", "k").alias("c"))
    chunks = named.groupBy("c").agg(F.ceil(F.count("*") / F.lit(GROUP)).cast("int").alias("chunks"))
    grouped = cut(named.join(chunks, "c").select("k", "c", F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int").alias("g")))
    own = grouped.select(F.col("k").alias("a"), F.col("c").alias("own"))
    other = grouped.withColumnRenamed("k", "b")
    queries = cut(pairs.join(own, "a").join(other, "b").where("own <> c").select(F.col("a").alias("k"), "c", "g").distinct())
    held = grouped.join(queries.select("c", "g").distinct(), ["c", "g"], "left_semi").select("c", "g", "k")
    tokens = cut(token_table(docs, distinct, queries.select("k").union(held.select("k")), repeated))
    matrix = cut(unions(held.join(tokens, "k")))
    passed = cut(met(matrix, queries.join(tokens, "k"), qualifying, "k long, c long, g int"))
    open_groups = held.join(passed.select("c", "g").distinct(), ["c", "g"], "left_semi")
    return met(open_groups.join(tokens, "k"), passed.join(tokens, "k"), opened, "a long, b long")


def members(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``set_keys``, and (_k, first) of every set: the least document (doc_id, h) of its component."""
    sets = cut(set_keys(docs))
    total = sets.agg(F.sum("n")).first()[0] or 0
    # Structs compare field by field, so a null id comes after all others.
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    distinct = sets.where("k IS NOT NULL").groupBy("k").agg(
        F.min(row).alias("least"),
        F.first("n").alias("n"),
        F.first("bits").alias("bits"),
    )
    distinct = cut(distinct)
    repeated = not sets.where("k IS NOT NULL").groupBy("doc_id", "h").count().where("count > 1").isEmpty()
    posts = cut(postings(docs, frequent(docs, total)))
    typical = F.max(F.struct("typical", "n", "k")).alias("top")
    lists = posts.groupBy("token").agg(F.count("*").alias("sets"), typical)
    long = cut(posts.join(lists.where(F.col("sets") > LONG), "token"))
    short = posts.join(lists.where(F.col("sets") <= LONG).select("token"), "token", "left_semi")
    # A linked pair's sets meet at their first common token, whatever the length of its list.
    stars = long.select(F.least("k", "top.k").alias("a"), F.greatest("k", "top.k").alias("b")).where("a <> b")
    pairs = short_pairs(short, posts.count()).unionByName(stars).distinct()
    pairs = cut(thinned(pairs, distinct))

    # Each set and the most typical of its candidates make the classes.
    score = F.max_by("b", F.struct("typical", "b")).alias("b")
    scores = posts.groupBy("k").agg(F.max("typical").alias("typical"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = both.join(scores.withColumnRenamed("k", "b"), "b").groupBy("a").agg(score)
    best = cut(best)
    tokens = cut(token_table(docs, distinct, best.select(F.col("a").alias("k")).union(best.select("b")), repeated))
    classes = cut(components(class_links(best, tokens)))
    rest = cut(pairs.unionByName(long_pairs(long, distinct, classes)).distinct())
    between = matrix_links(rest, docs, distinct, classes, repeated)
    known = classes.select(F.col("node").alias("a"), F.col("root").alias("b"))
    found = components(known.unionByName(between))
    rooted = distinct.select("k", "least").join(found, F.col("k") == F.col("node"), "left").withColumn("_root", F.coalesce("root", "k"))
    named = rooted.groupBy("_root").agg(F.min("least").alias("first"))
    return sets, rooted.select("k", "_root").join(named, "_root").select(F.col("k").alias("_k"), "first")


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    sets, first = members(docs)
    return sets.join(first, F.col("k") == F.col("_k"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("first.doc_id", "doc_id").alias("component_id")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the one with the least doc_id, of one id with the least text hash.

    Rows are decided by id and text, so a row is only left out if it is a copy of
    one that stays. Rows without words are copies of nothing and all stay. Only
    texts that may have to go are moved.
    """
    sets, first = members(docs)
    keep = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h"))
    rows = sets.join(first, F.col("k") == F.col("_k")).groupBy("doc_id", "h").agg(F.first(keep).alias("keep"), F.count("*").alias("rows"))
    own, text_hash, once = free(docs, "_id", "_h", "_once")
    ruled = rows.where("NOT keep OR rows > 1").select(F.col("doc_id").alias(own), F.col("h").alias(text_hash), F.col("keep").alias(once))
    ruled = cut(ruled)
    row, row_hash = free(docs.select("*", *[F.lit(None).alias(c) for c in (own, text_hash, once)]), "_doc", "_text")
    named = docs.withColumn(row, F.col("doc_id").cast("long")).withColumn(row_hash, F.xxhash64("text"))
    maybe, others = split_texts(named, ruled.select(F.col(own).alias(row), F.col(text_hash).alias(row_hash)), row, row_hash)
    same = F.col(row).eqNullSafe(F.col(own)) & (F.col(row_hash) == F.col(text_hash))
    kept = others.unionByName(maybe.join(ruled, same, "left_anti"))
    repeated = ruled.where(once)
    if not repeated.isEmpty():
        kept = kept.unionByName(maybe.join(repeated, same, "left_semi").dropDuplicates([row, row_hash]))
    return kept.drop(row, row_hash)

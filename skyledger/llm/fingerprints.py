"""Merkle fingerprints: a hash tree of sections, paragraphs, sentences and pieces.

Blank lines part sections, line ends part paragraphs, full stops part sentences, and
a sentence that is still long is cut into pieces where its words meet a condition, so
that an edit in a text without any of these ends is located too. A leaf is the SHA-256
of its piece; every other node hashes its children's hashes, and the root is the
fingerprint: equal texts have equal roots. Two trees are compared from the top: equal
roots are alike by 1, and else the share of common leaves among all leaves, each as
often as it occurs and weighed by its characters, tells how much of the text is shared.
``differences`` walks two trees down their unequal branches to the places of the edits.

Defined cases: a null text is the empty text, which has a fingerprint of its own;
documents follow each other by ``doc_id``, nulls first, then by text hash;
repeated rows of one id and text are one document whose result is given for each
of them; a single document is its own next; columns beside ``doc_id`` and
``text`` are ignored by ``edits`` and kept by ``with_tree``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import cut, free, search_sorted

# Each end is one fixed string and pieces lose nothing, so no two texts split into the same tree.
SECTION_END = "\n\n"
PARAGRAPH_END = "\n"
SENTENCE_END = r"\. "
#: Sentences of more code points are cut after a word that ends in one of these letters or marks,
#: and after ``LEAF`` code points where no such word comes.
LEAF = 64
PIECE = r"(?s).{16,62}?(?:[dnrty!?;:,] |[。！？])|.{1,64}"
#: Levels below the root, from the top.
LEVELS = ("section", "paragraph", "sentence", "piece")
#: A leaf's key is a hash whose last seven bits hold its weight, at most LEAF + 1.
WEIGHT = 127
#: Ranges of ids in which neighbours are found side by side.
RANGES = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces(sentence: Column) -> Column:
    """Leaves of a sentence; put together they are the sentence."""
    return F.when(
        F.char_length(sentence) > LEAF, F.regexp_extract_all(sentence, F.lit(PIECE), F.lit(0))
    ).otherwise(F.array(sentence))


def branches(text: Column) -> Column:
    """The whole tree: every node with its ``hash`` and its ``parts``, a leaf with its ``size``."""

    def node(parts: Column) -> Column:
        return let(
            parts,
            lambda p: F.struct(
                F.sha2(F.array_join(F.transform(p, lambda x: x["hash"]), ","), 256).alias("hash"), p.alias("parts")
            ),
        )

    def leaf(piece: Column) -> Column:
        return F.struct(F.sha2(piece, 256).alias("hash"), F.char_length(piece).alias("size"))

    def sentence(s: Column) -> Column:
        return node(F.transform(pieces(s), leaf))

    def paragraph(s: Column) -> Column:
        return node(F.transform(F.split(s, SENTENCE_END), sentence))

    def section(s: Column) -> Column:
        return node(F.transform(F.split(s, PARAGRAPH_END), paragraph))

    return node(F.transform(F.split(text, SECTION_END), section))


def numbered(keys: Column) -> Column:
    """Keys told apart by how many equal ones come before them, so that sets of them count repetitions.

    In a sorted list a key's run is measured by halving steps, so that a text that repeats
    one line throughout costs no more than n log n.
    """

    def run(ordered: Column, value: Column, i: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(1 << b) for b in range(29, -1, -1)]), lambda step: step < F.size(ordered))
        return F.aggregate(
            steps,
            F.lit(0),
            lambda n, step: F.when(
                (i - n - step >= 0) & (F.get(ordered, F.greatest(F.lit(0), i - n - step)) == value), n + step
            ).otherwise(n),
        )

    def again(value: Column, k: Column) -> Column:
        return F.when(k == 0, value).otherwise(weighted(F.xxhash64(value, k), value.bitwiseAND(F.lit(WEIGHT))))

    return let(
        F.array_sort(keys),
        lambda o: F.when(F.size(F.array_distinct(o)) == F.size(o), o).otherwise(
            F.transform(o, lambda v, i: let(run(o, v, i), lambda k: again(v, k)))
        ),
    )


def weighted(key: Column, weight: Column) -> Column:
    return key.bitwiseAND(F.lit(~WEIGHT)).bitwiseOR(weight)


def tree(text: Column) -> Column:
    """Root and the leaves below it, in 64 bits each."""

    def short(b: Column) -> Column:
        leaves = b["parts"]
        for _ in LEVELS[1:]:
            leaves = F.flatten(F.transform(leaves, lambda x: x["parts"]))
        keys = F.transform(leaves, lambda x: weighted(F.xxhash64(x["hash"]), (x["size"] + 1).cast("long")))
        return F.struct(b["hash"].alias("root"), numbered(keys).alias("leaves"))

    return let(branches(text), short)


def likeness(left: Column, right: Column) -> Column:
    """Share of common leaves of two trees by weight, 1 for equal roots."""

    def weight(keys: Column) -> Column:
        return F.aggregate(keys, F.lit(0).cast("long"), lambda n, key: n + key.bitwiseAND(F.lit(WEIGHT)))

    common = weight(F.array_intersect(left["leaves"], right["leaves"]))
    every = weight(left["leaves"]) + weight(right["leaves"]) - common
    return F.when(left["root"] == right["root"], F.lit(1.0)).otherwise(common / every)


def differences(pairs: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """Where two trees of ``with_tree`` differ, one row per differing branch.

    Only unequal children are opened. Children that begin and end alike are passed over;
    what remains between is paired in order if it is equally many on both sides, and else
    given as a whole. ``path`` holds the place at each of ``LEVELS``, as deep as the
    difference goes, counted on the left; ``n_left`` and ``n_right`` say how many children from there on
    stand against each other, 0 where one side has none. The other columns stay. Equal trees and null
    trees give no row.
    """
    path, n_left, n_right, found = free(pairs, "path", "n_left", "n_right", "found")
    kind = "array<struct<path: array<int>, n_left: int, n_right: int>>"

    def ends_alike(a: Column, b: Column, most: Column, at: Callable[[Column, Column], Column]) -> Column:
        """How many children are equal, from where ``at`` counts."""
        places = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
        unlike = F.filter(places, lambda i: at(a, i)["hash"] != at(b, i)["hash"])
        return F.coalesce(F.array_min(unlike), most)

    def within(a: Column, b: Column, above: Column, level: int) -> Column:
        from_start = ends_alike(a, b, F.least(F.size(a), F.size(b)), lambda x, i: F.get(x, i))

        def behind(start: Column) -> Column:
            rest = F.least(F.size(a), F.size(b)) - start
            from_end = ends_alike(a, b, rest, lambda x, i: F.get(x, F.size(x) - 1 - i))
            return let(F.struct(start.alias("start"), from_end.alias("end")), between)

        def between(same: Column) -> Column:
            start = same["start"]
            more_left, more_right = F.size(a) - start - same["end"], F.size(b) - start - same["end"]
            whole = F.array(
                F.struct(
                    F.concat(above, F.array(start)).alias("path"),
                    more_left.alias("n_left"),
                    more_right.alias("n_right"),
                )
            ).cast(kind)
            if level == len(LEVELS) - 1:
                return whole

            def opened(i: Column) -> Column:
                x, y = F.get(a, i), F.get(b, i)
                deeper = within(x["parts"], y["parts"], F.concat(above, F.array(i)), level + 1)
                return F.when(x["hash"] == y["hash"], F.array().cast(kind)).otherwise(deeper)

            inner = F.flatten(F.transform(F.sequence(start, start + more_left - 1), opened))
            return F.when(more_left == more_right, inner).otherwise(whole)

        return let(from_start, behind)

    trees = F.col(left), F.col(right)
    unequal = F.coalesce(trees[0]["hash"] != trees[1]["hash"], F.lit(False))
    places = within(trees[0]["parts"], trees[1]["parts"], F.array().cast("array<int>"), 0)
    kept = [F.col(f"`{c}`") for c in pairs.columns if c not in (left, right)]
    return pairs.where(unequal).select(*kept, F.explode(places).alias(found)).select(
        *kept,
        F.col(found)["path"].alias(path),
        F.col(found)["n_left"].alias(n_left),
        F.col(found)["n_right"].alias(n_right),
    )


def with_tree(docs: DataFrame, name: str = "tree") -> DataFrame:
    """Documents with the whole tree of their text, for ``differences``."""
    return docs.withColumn(name, branches(F.coalesce(F.col("text"), F.lit(""))))


def neighbours(ids: DataFrame) -> DataFrame:
    """Every distinct (doc_id, h, n) with the one before it; the last comes before the first.

    Ids are ranged by sampled quantiles and ordered within a range; a table with
    one row per range, at most ``RANGES + 1``, bridges from range to range.
    """
    ids = cut(ids.distinct())
    quantiles = [i / RANGES for i in range(1, RANGES)]
    splits = ids.agg(F.percentile_approx("doc_id", quantiles, 20 * RANGES)).first()[0] or []
    ranged = ids.withColumn(
        "range", F.when(F.col("doc_id").isNull(), -1).otherwise(search_sorted(sorted(set(splits)), F.col("doc_id")))
    )
    row = F.struct("doc_id", "h", "n")
    order = Window.orderBy("range")
    ends = ranged.groupBy("range").agg(F.max(row).alias("_last"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bridge = ends.select(
        "range", F.coalesce(F.lag("_last").over(order), F.last("_last").over(whole)).alias("_bridge")
    )
    inside = Window.partitionBy("range").orderBy("doc_id", "h")
    return (
        ranged.withColumn("_before", F.lag(row).over(inside))
        .join(F.broadcast(bridge), "range")
        .withColumn("_before", F.coalesce("_before", "_bridge"))
        .select(
            F.col("doc_id").alias("_id"),
            F.col("h").alias("_h"),
            F.col("_before.doc_id").alias("before_id"),
            F.col("_before.h").alias("before_h"),
            F.col("_before.n").alias("before_n"),
        )
    )


def keyed(doc_id: str, h: str, prefix: str) -> list[Column]:
    """An id that may be null, and a hash, as columns to group and to join by plain equality.

    A null-safe join would be dealt by other expressions than the grouping before it, and
    so move all texts' starts and leaves twice.
    """
    return [
        F.coalesce(doc_id, F.lit(0).cast("long")).alias(f"{prefix}id"),
        F.isnull(doc_id).alias(f"{prefix}none"),
        F.col(h).alias(f"{prefix}hash"),
    ]


def same(left: str, right: str) -> Column:
    """Equality of two sets of ``keyed`` columns."""
    id_, none, hash_ = (F.col(f"{left}{c}") == F.col(f"{right}{c}") for c in ("id", "none", "hash"))
    return id_ & none & hash_


def tail(n_chars: Column) -> Column:
    """Code points of a text that its edited text takes from the next one."""
    return F.floor(n_chars / 4).cast("int")


def edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    Whole texts are shuffled once, by their own id. What a text gives to the one
    before it, its first characters and its leaves, is shuffled a second time.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn(
        "h", F.xxhash64("text")
    )
    order = neighbours(texts.select("doc_id", "h", F.char_length("text").alias("n"))).select(
        *keyed("_id", "_h", "at_"), *keyed("before_id", "before_h", "before_"), "before_n"
    )
    # The id is taken from its key later, so that both uses of the texts read one exchange.
    own = texts.select("text", *keyed("doc_id", "h", "own_"))
    placed = own.join(order, same("own_", "at_"))
    given = (
        placed.select(
            "before_id",
            "before_none",
            "before_hash",
            F.struct(
                F.substring("text", F.lit(1), tail(F.col("before_n"))).alias("start"),
                tree(F.col("text")).alias("tree"),
            ).alias("_given"),
        )
        .groupBy("before_id", "before_none", "before_hash")
        .agg(F.first("_given").alias("_given"))
    )
    both = placed.select("text", "own_id", "own_none", "own_hash").join(given, same("own_", "before_"))
    n_chars = F.char_length("text")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - tail(n_chars)), F.col("_given.start"))
    trees = both.select(F.when(~F.col("own_none"), F.col("own_id")).alias("doc_id"), "text", "_given", edited.alias("edited")).select(
        "doc_id",
        n_chars.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own"),
        tree(F.col("edited")).alias("changed"),
        F.col("_given.tree").alias("after"),
    )
    return trees.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.col("own.root").alias("fingerprint"),
        F.col("changed.root").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )

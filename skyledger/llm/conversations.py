"""Conversation structure repair with a persistent audit DP; damage for trying it out.

A conversation is legal if its roles are nothing, or an optional system turn and
then pairs of a user and an assistant turn. Blank and repeated rows are deleted;
further rows are kept, get another role or are deleted, and empty turns inserted,
at the least total cost. The edits' initials are the audit; of equal costs the
audit that comes first in ASCII order is taken (``audits``).

How it is spread: rows without their texts are range-partitioned by conversation
and turn and read in order, so a conversation with a third of all rows lies in
many partitions. A conversation inside one partition is finished there. One that
crosses a border, or has more than ``SEGMENT`` rows, is cut into parts, each solved
from every state to every state, and its parts are joined in order. Whole
texts move once, to the hash of a conversation as its definition wants one after
another, and are never held: sorted batches pass through. What grows with a
conversation in one task is its audit, which is one value of the result.

Defined cases: a null role or text is one space, so such a row is blank; a null
conv_id is a conversation by itself and a null turn comes first, both one space in
the damage's key; rows of one turn are ordered by a hash of role and text, equal rows
stay together; an empty role has an empty initial and is never legal as it is;
only texts without anything but white space are blank, also empty ones; whole
texts are read however long; a conversation without rows after damage has zeros,
an empty audit and the hash of nothing; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import audits
from skyledger.llm.common import cut

SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
#: Of so many kinds of damage by hash, the first five do something.
DAMAGES = 20
DROPPED, EMPTIED, CUT_OFF, DOUBLED, MADE_USER = range(5)
LEGAL_PAIRS = ("su", "ua", "au")
#: Rows of a conversation that are solved at once; a longer one is solved in parts.
SEGMENT = 8192
COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def rows_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (null as one space), tie (orders rows of one turn) and copy (0)."""
    return conversations.select(
        "conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
        F.xxhash64(spaced("role"), spaced("text")).alias("tie"), F.lit(0).alias("copy"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as :func:`rows_of` gives them, damaged by a hash of conversation and turn."""
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % DAMAGES
    rows = rows_of(conversations).withColumn("_kind", kind).where(F.col("_kind") != DROPPED)
    copies = F.when(F.col("_kind") == DOUBLED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("_kind") == EMPTIED, F.lit("")).when(
        F.col("_kind") == CUT_OFF, F.translate("text", STOPS, "")
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == MADE_USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        "tie",
        F.explode(copies).alias("copy"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, tie, copy, uid, initial and fault of every row, without its text.

    The first row of a role and text in a conversation is found by a grouped
    minimum, so that a passage that repeats very often is summed before it moves.
    """
    bare = F.rtrim("text", F.lit(SPACE))
    last = F.substring(bare, -1, 1)
    fault = F.when(last == "", F.lit("blank")).when(~last.isin(*STOPS), F.lit("truncated")).otherwise(F.lit(""))
    said = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    order = ["turn", "tie", "copy"]
    narrow = cut(rows.select("conv_id", *order, F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), said.alias("said")))
    narrow = narrow.withColumn("uid", F.monotonically_increasing_id())
    place = F.struct(*order, "uid")
    groups = narrow.where("fault <> 'blank'").groupBy("conv_id", "said").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    again = groups.where("n > 1").select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said"))
    later = F.col("first").isNotNull() & (F.col("uid") != F.col("first.uid")) & (F.col("fault") != "blank")
    return narrow.join(again, same, "left").select(
        "conv_id", *order, "uid", "initial", F.when(later, F.lit("duplicate")).otherwise(F.col("fault")).alias("fault")
    )


PART = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        *[(name, pa.int64()) for name in COUNTS],
        ("first", pa.string()),
        ("last", pa.string()),
        ("costs", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.string())),
    ]
)
PART_FIELDS = (
    "conv_id long, part long, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, costs array<long>, texts array<string>"
)


class Part:
    """Rows of a conversation, read in order: from the start state, or from every state if rows may come before."""

    def __init__(self, conv: int | None, edge: bool):
        self.conv, self.counts, self.first, self.last = conv, dict.fromkeys(COUNTS, 0), None, None
        self.edits = [audits.Edits(state) for state in (range(audits.STATES) if edge else (audits.START,))]

    def read(self, initial: str, fault: str) -> None:
        if fault:
            self.counts[fault] += 1
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL_PAIRS:
            self.counts["illegal"] += 1
        self.last = initial
        for edits in self.edits:
            edits.read(initial, fault in ("blank", "duplicate"), fault == "truncated")

    def row(self, part: int) -> tuple:
        """Costs and texts by state before and after; one of each if the conversation is whole."""
        told = [edits.told() for edits in self.edits]
        if len(told) == 1:
            cost, text = min(told[0][state] for state in audits.ENDS if told[0][state] is not None)
            costs, texts = [cost], [text]
        else:
            costs = [None if held is None else held[0] for row in told for held in row]
            texts = [None if held is None else held[1] for row in told for held in row]
        return (self.conv, part, *self.counts.values(), self.first, self.last, costs, texts)


def solved(rows: DataFrame) -> DataFrame:
    """The parts of conversations in every partition of rows in order; see ``PART_FIELDS``."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "tie", "copy", "uid"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("part", F.spark_partition_id().cast("long") * (1 << 32))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows wait until it is known whether their conversation is whole: it is if others
        # come before and behind it in the partition, and if no rows of it were solved before.
        held: list[tuple[str, str]] = []
        conv, part, edge = None, None, True
        done: list[dict] = []

        def finish(edge: bool) -> None:
            nonlocal part
            one = Part(conv, edge)
            for initial, fault in held:
                one.read(initial, fault)
            held.clear()
            done.append(dict(zip(PART.names, one.row(part))))
            part += 1

        for batch in batches:
            names = ("conv_id", "part", "initial", "fault")
            for own, place, initial, fault in zip(*(batch.column(name).to_pylist() for name in names)):
                if part is None:
                    conv, part = own, place
                elif own != conv:
                    finish(edge)
                    conv, edge = own, False
                elif len(held) >= SEGMENT:
                    edge = True
                    finish(edge)
                held.append((initial, fault))
            yield pa.RecordBatch.from_pylist(done, schema=PART)
            done.clear()
        if held:
            finish(True)
        yield pa.RecordBatch.from_pylist(done, schema=PART)

    return ordered.select("conv_id", "part", "initial", "fault").mapInArrow(solve, PART_FIELDS)


WHOLE_FIELDS = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
WHOLE = ["conv_id", *COUNTS, "cost", "audit"]
AUDITED = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in (*COUNTS, "cost")], ("audit", pa.string())])


def whole(parts: DataFrame) -> DataFrame:
    """conv_id, counts, cost and audit of each conversation from its parts.

    Only conversations with several parts are moved; their parts pass by in order.
    """
    single = parts.where(F.size("costs") == 1).select(
        "conv_id", *COUNTS, F.get("costs", F.lit(0)).alias("cost"), F.get("texts", F.lit(0)).alias("audit")
    )
    several = parts.where(F.size("costs") > 1)
    several = several.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: audits.Joined | None = None
        sums: dict = {}
        last = ""
        out: list[dict] = []

        def finish() -> None:
            if now is not None:
                cost, audit = now.end()
                out.append({**sums, "cost": cost, "audit": audit})

        for batch in batches:
            for i in range(len(batch)):
                (row,) = batch.slice(i, 1).to_pylist()
                if now is None or row["conv_id"] != sums["conv_id"]:
                    finish()
                    now, sums = audits.Joined(), {"conv_id": row["conv_id"], **dict.fromkeys(COUNTS, 0)}
                elif last + row["first"] not in LEGAL_PAIRS:
                    sums["illegal"] += 1
                for name in COUNTS:
                    sums[name] += row[name]
                now.add(steps(row))
                last = row["last"]
            yield pa.RecordBatch.from_pylist(out, schema=AUDITED)
            out.clear()
        finish()
        yield pa.RecordBatch.from_pylist(out, schema=AUDITED)

    return single.unionByName(several.mapInArrow(join, WHOLE_FIELDS))


def steps(row: dict) -> list[list[tuple[int, str] | None]]:
    held = [None if cost is None else (cost, text) for cost, text in zip(row["costs"], row["texts"])]
    return [held[i : i + audits.STATES] for i in range(0, len(held), audits.STATES)]


class Repaired:
    """Turns of a repaired conversation, made from its audit as its rows pass by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, audits.START

    def chosen(self) -> str:
        self.state = audits.CHOSEN[self.state]
        return "user" if self.state == audits.USER else "assistant"

    def inserted(self) -> Iterator[tuple[str, str]]:
        """Empty turns before the next row, or at the end."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self.chosen(), ""

    def turns(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = audits.LEGAL[self.state, role[:1]]
            yield role, text
        elif edit == "R":
            yield self.chosen(), text


def turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Conversations in order: first the row with a conversation's audit, then its rows with role and text."""
    heads = audited.select("*", F.lit(0).alias("kind"))
    for name in ("turn", "tie"):
        heads = heads.withColumn(name, F.lit(None).cast("long"))
    heads = heads.withColumns({"copy": F.lit(0), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    texts = rows.withColumn("kind", F.lit(1)).withColumn("turn", F.col("turn").cast("long"))
    both = heads.unionByName(texts, allowMissingColumns=True)
    order = ["conv_id", "kind", F.col("turn").asc_nulls_first(), "tie", "copy"]
    return both.repartition("conv_id").sortWithinPartitions(*order)


def hashed(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with ``repaired_sha256``: of the repaired turns as ``role:text``, joined by line ends."""
    fields = f"{WHOLE_FIELDS}, repaired_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: dict | None = None
        repaired, sha, any_turn = Repaired(""), hashlib.sha256(), False
        out: list[dict] = []
        schema = AUDITED.append(pa.field("repaired_sha256", pa.string()))

        def take(pairs: Iterator[tuple[str, str]]) -> None:
            nonlocal any_turn
            for role, text in pairs:
                sha.update((("\n" if any_turn else "") + f"{role}:{text}").encode())
                any_turn = True

        def finish() -> None:
            if head is not None:
                take(repaired.inserted())
                out.append({**head, "repaired_sha256": sha.hexdigest()})

        for batch in batches:
            heads = iter(batch.filter(pc.equal(batch.column("kind"), 0)).select(WHOLE).to_pylist())
            for kind, role, text in zip(*(batch.column(name).to_pylist() for name in ("kind", "role", "text"))):
                if kind == 0:
                    finish()
                    head = next(heads)
                    repaired, sha, any_turn = Repaired(head["audit"]), hashlib.sha256(), False
                else:
                    take(repaired.turns(role, text))
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
        finish()
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return turns(rows, audited).select(*WHOLE, "kind", "role", "text").mapInArrow(digest, fields)


def audited(rows: DataFrame) -> DataFrame:
    """conv_id, counts of faults, cost and audit of every conversation among ``rows``."""
    return cut(whole(cut(solved(cut(faults(rows))))))


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, position, role and text of the repaired turns of rows as :func:`rows_of` gives them."""
    fields = "conv_id long, position long, role string, text string"
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, now, at = None, Repaired(""), 0
        for batch in batches:
            out: list[tuple] = []
            names = ("conv_id", "kind", "audit", "role", "text")
            for own, kind, audit, role, text in zip(*(batch.column(name).to_pylist() for name in names)):
                made = now.inserted() if kind == 0 else now.turns(role, text)
                for turn in made:
                    out.append((conv, at, *turn))
                    at += 1
                if kind == 0:
                    conv, now, at = own, Repaired(audit), 0
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema=schema)
        last = [(conv, at + i, *turn) for i, turn in enumerate(now.inserted())]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in last], schema=schema)

    ordered = turns(rows, audited(rows)).select("conv_id", "kind", "audit", "role", "text")
    return ordered.mapInArrow(repair, fields)


def report(conversations: DataFrame) -> DataFrame:
    """A row for each conv_id of the table: gaps, faults, cost, audit and hash of its repair after damage."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = damaged(ids)
    known = hashed(rows, audited(rows)).withColumnRenamed("conv_id", "_conv")
    seen = rows.groupBy("conv_id").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.countDistinct("turn").alias("n"))
    seen = seen.select(F.col("conv_id").alias("_own"), F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).alias("gaps"))
    every = ids.select("conv_id").distinct()
    full = every.join(seen, F.col("conv_id").eqNullSafe(F.col("_own")), "left").join(
        known, F.col("conv_id").eqNullSafe(F.col("_conv")), "left"
    )
    empty = hashlib.sha256().hexdigest()
    return full.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )

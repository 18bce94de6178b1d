"""Personal data: regular expressions propose, checksums confirm, context scores.

A kind has a pattern, a check and a prior score. Words within ``NEAR`` code
points of a span raise or lower its score; ``redact`` replaces what scores at
least ``LEAST``. Base kinds (email, ip, card, phone) score high enough to stay
whatever stands around them; the added ones (iban with mod-97, ssn) need their
checksum or their context.

All patterns run in time linear in the text: a run of digits is tried once, and
an address is looked for only around an ``@``.

Defined cases: null and empty texts have no spans (``redact`` keeps null);
offsets count code points, the end is exclusive; spans of different kinds may
overlap, ``redact`` then replaces their union once, named by the first; repeated
rows are treated one by one; extra columns are kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyledger.llm.common import parts

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
KINDS = BASE + ADDED
#: Code points on either side in which context words count.
NEAR = 40
#: Spans that score at least this are redacted.
LEAST = 0.5
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4}
# Words that speak for a kind, and words that speak against any.
FOR = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "iban": ("iban", "account", "bank", "transfer", "bic"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
AGAINST = ("version", "example", "sample", "isbn", "order", "invoice", "serial", "part")
BONUS, MALUS = 0.2, 0.1

#: What a text without any span of any kind lacks.
HINT = re.compile("[0-9@]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LETTERS = re.compile("[a-z]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, leftmost first.

    No character before the ``@`` can be one, so a match starts where the run of
    allowed characters before its ``@`` starts.
    """
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Check digits of an account number: moved to the end, letters as 10 to 35, rest 1."""
    rest = 0
    for sign in code[4:] + code[:4]:
        value = int(sign, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def digits_of(text: str) -> str:
    return "".join(sign for sign in text if "0" <= sign <= "9")


def part_ok(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or "0") <= 255


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of every kind, by kind and then by start."""
    if not HINT.search(text):
        return
    for start, end in emails(text):
        yield "email", start, end
    for found in IP.finditer(text):
        if all(map(part_ok, found[0].split("."))):
            yield "ip", *found.span()
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 13:
            digits = digits_of(found[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", *found.span()
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= len(digits_of(found[0])) <= 15:
                yield "phone", *found.span()
    for found in IBAN.finditer(text):
        code = found[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield "iban", *found.span()
    for found in SSN.finditer(text):
        area, group, serial = found[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *found.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Prior of the kind, changed by the words beside the span, from 0 to 1."""
    around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    words = set(LETTERS.findall(around.lower()))
    value = PRIOR[kind] + BONUS * any(w in words for w in FOR[kind]) - MALUS * any(w in words for w in AGAINST)
    return round(min(1.0, max(0.0, value)), 3)


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score of every span: all base ones, added ones that score enough."""
    text = text or ""
    scored = ((kind, a, b, score(text, kind, a, b)) for kind, a, b in proposals(text))
    return [s for s in scored if s[0] in BASE or s[3] >= LEAST]


def joined(found: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in found)


def masked(text: str, found: list[tuple[str, int, int, float]]) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for kind, start, end, value in sorted(found, key=lambda s: (s[1], -s[2])):
        if value < LEAST or end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


REPORT = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS]
    + [
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("scores", T.ArrayType(T.DoubleType())),
    ]
)


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of every document; narrow, without a shuffle."""

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            columns = {field.name: [] for field in REPORT}
            for text in batch.column("text"):
                found = spans(text.as_py())
                base = [s for s in found if s[0] in BASE]
                for kind in KINDS:
                    columns[f"n_{kind}"].append(sum(s[0] == kind for s in found))
                columns["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                columns["spans"].append(joined(found))
                columns["scores"].append([s[3] for s in found])
            columns["doc_id"] = batch.column("doc_id")
            yield pa.RecordBatch.from_pydict(columns, SCHEMA)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(found_in, REPORT)


SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{kind}", pa.int64()) for kind in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string()), ("scores", pa.list_(pa.float64()))]
)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``n_chars``, if there, counts the new text.

    Other columns stay as they are.
    """

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            at = batch.schema.get_field_index("text")
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                texts.append(masked(text, spans(text)) if text and HINT.search(text) else text)
            kind = batch.schema.field(at).type
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, kind))
            if "n_chars" in batch.schema.names:
                place = batch.schema.get_field_index("n_chars")
                sizes = [n if t is None else len(t) for n, t in zip(batch.column(place).to_pylist(), texts)]
                field = batch.schema.field(place)
                batch = batch.set_column(place, field, pa.array(sizes, field.type))
            yield batch

    return docs.mapInArrow(replaced, docs.schema)

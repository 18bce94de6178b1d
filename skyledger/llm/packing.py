"""Packing along a space-filling curve: neighbours on a Hilbert curve share sequences.

A document's tokens are hashed into a vector of a few signed sums, the vector is
quantised, and its place on a Hilbert curve is the sort key. Documents are ranged
and sorted by that key; each range is one stream of tokens that is cut into
sequences of ``LENGTH``. Documents are cut where a sequence ends, so only the last
sequence of a range is padded.

Defined cases: a null or empty text has only the end token; documents with equal
keys are ordered by ``doc_id`` (nulls first) and then by token ids; repeated rows
are packed one by one; a document longer than a sequence spans several; an empty
table gives an empty result; columns beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import cut, mixed, parts

LENGTH = 2048
END = 1
TOKENIZER = "word_bpe_49k.json"
#: Dimensions of the hashed vector and bits of each on the curve.
DIMENSIONS, BITS = 4, 12
#: Distinct words whose ids a Python worker remembers at most.
WORDS_KEPT = 200_000

# ASCII, Latin letters and common signs: the same letters, spaces and normal form to Python and the tokenizer.
PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7e\\xa0\\xab\\xbb\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u012f\\u0131-\\u017e\\u2013-\\u2026\\u20ac]*")
# The tokenizer's pattern for lower-case texts of such signs.
PARTS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|(?:[^\s\w]|_)+")

#: What every special token of the vocabulary begins with.
SPECIAL = "<|"


def byte_signs() -> dict[int, int]:
    """The sign by which a byte-level vocabulary spells each byte that is no visible sign itself."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {byte: 256 + place for place, byte in enumerate(b for b in range(256) if b not in shown)}


BYTE_SIGNS = byte_signs()
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
PIECE_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class Words(dict):
    """Ids of a word as 16-bit little-endian numbers, made at its first use."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        spelled = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(BYTE_SIGNS)
        ids = np.array([token.id for token in self.model.tokenize(spelled)], "<u2").tobytes()
        self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts.

    Texts of plain signs (nearly all of a corpus in Latin script) are parted into
    words as the tokenizer would, and only words not seen before go to its model.
    Any other text, and one that may hold a special token of the vocabulary, goes to
    the tokenizer whole. What is remembered is dropped when
    full, so the memory of a worker is bounded.
    """

    _made: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.words = Words(self.tokenizer.model)

    @classmethod
    def at(cls, path: str) -> "Encoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def ids(self, text: str) -> bytes:
        """Ids as 16-bit little-endian numbers, without the end token."""
        if SPECIAL not in text and PLAIN.fullmatch(text):
            return b"".join(map(self.words.__getitem__, PARTS.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


def hash_tables() -> tuple[np.ndarray, np.ndarray]:
    """Dimension and sign of every id."""
    hashes = mixed(np.arange(1 << 16) + 1)
    place = ((hashes & np.uint64(0xFFFF)) % np.uint64(DIMENSIONS)).astype(np.int64)
    return place, 1.0 - 2.0 * ((hashes >> np.uint64(20)) & np.uint64(1)).astype(np.float64)


PLACE, SIGN = hash_tables()


def vector(ids: np.ndarray) -> np.ndarray:
    """Signed sums of hashed ids over the dimensions, by the square root of the length."""
    return np.bincount(PLACE[ids], SIGN[ids], DIMENSIONS) / max(1.0, len(ids) ** 0.5)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places of integer points (one row each) on a Hilbert curve of their dimension.

    The coordinates are turned into the curve's transposed form one bit plane at
    a time, from the highest, and the planes are then interleaved.
    """
    x = points.astype(np.int64).T.copy()
    size = len(x)
    plane = 1 << (bits - 1)
    while plane > 1:
        low = plane - 1
        for i in range(size):
            high = (x[i] & plane) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        plane >>= 1
    for i in range(1, size):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    plane = 1 << (bits - 1)
    while plane > 1:
        flip ^= np.where((x[size - 1] & plane) != 0, plane - 1, 0)
        plane >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(size):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def keys(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of vectors; coordinates beyond three lie on the edge."""
    most = (1 << BITS) - 1
    return hilbert(np.rint((np.clip(vectors, -3, 3) + 3) / 6 * most).astype(np.int64))


def tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids (16-bit little-endian, end token included) and curve key."""
    path = tokenizer or default_tokenizer()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("key", pa.int64())])
    end = np.array([END], "<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(path)
        for part in parts(batches):
            ids = [encoder.ids(text.as_py() or "") + end for text in part.column("text")]
            places = keys(np.stack([vector(np.frombuffer(x, "<u2")) for x in ids]))
            yield pa.record_batch([part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(places)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, "doc_id long, ids binary, key long"
    )


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Token ids are written once before the range sort, which samples its input. Copies
    of one text under one id, or none, are told apart by their place, so that they
    need not lie in one range.
    """
    placed = cut(tokens(docs, tokenizer)).withColumn("place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange("key", "doc_id", "place")
    ordered = ordered.sortWithinPartitions("key", "doc_id", "ids").withColumn("part", F.spark_partition_id())

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = filled = 0
        for batch in parts(batches):
            rows = []
            columns = [batch.column(name).to_pylist() for name in ("doc_id", "ids", "part")]
            for doc, raw, part in zip(*columns):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                start = 0
                while start < len(ids):
                    take = min(length - filled, len(ids) - start)
                    crc = zlib.crc32(ids[start : start + take].tobytes())
                    rows.append((doc, start, take, crc, len(ids), (part << 33) + sequence, filled))
                    start += take
                    filled += take
                    if filled == length:
                        sequence, filled = sequence + 1, 0
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)] or None, schema=PIECE_SCHEMA)

    return ordered.select("doc_id", "ids", "part").mapInArrow(cut_up, PIECES)

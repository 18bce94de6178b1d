import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from skyledger.llm import packing
from tests.llm import odd


def check(spark, docs):
    """Every id is in exactly one piece, sequences are gapless, and padding is little."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack(docs).collect()
    ids = {}
    for row in docs.select("doc_id", "text").collect():
        encoded = tokenizer.encode(row.text or "", add_special_tokens=False).ids + [1]
        ids.setdefault(row.doc_id, []).append(encoded)
    starts = {}
    for piece in pieces:
        starts.setdefault((piece.doc_id, piece.doc_tokens), []).append(piece)
    for doc, texts in ids.items():
        for encoded in texts:
            raw = np.array(encoded, "<u4")
            own = starts[doc, len(encoded)]
            covered = {p.start: p for p in own if p.ids_crc32 == zlib.crc32(raw[p.start : p.start + p.length].tobytes())}
            at = 0
            while at < len(encoded):
                at += covered[at].length
            assert at == len(encoded)
    assert sum(p.length for p in pieces) == sum(len(e) for texts in ids.values() for e in texts)
    sequences = {}
    for piece in pieces:
        sequences.setdefault(piece.sequence_id, []).append((piece.offset, piece.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    return sequences, pieces


def test_fixture_round_trip(spark):
    sequences, pieces = check(spark, odd.fixture_documents(spark))
    assert sum(p.length for p in pieces) > 0.9 * packing.LENGTH * len(sequences)


def test_odd_rows(spark):
    check(spark, odd.documents(spark))


def test_special_strings_are_encoded_as_the_tokenizer_does(spark):
    texts = ["one <|endoftext|> two", "<|startoftext|>", "a <| b", "<|ENDOFTEXT|> c", "<|endoftext|" * 3]
    check(spark, odd.documents(spark, list(enumerate(texts))))
    assert np.frombuffer(packing.Encoder.at(packing.default_tokenizer()).ids(texts[0]), "<u2").tolist() == [637, 49407, 1237]


def test_empty(spark):
    assert packing.pack(odd.documents(spark, [])).count() == 0


def test_words_are_encoded_as_whole_texts():
    encoder = packing.Encoder.at(packing.default_tokenizer())
    signs = [chr(i) for i in (*range(0x250), *range(0x2010, 0x2030), 0x20AC, 0x6F22, 0x1C5, 0x2BD, 0x301)]
    for sign in signs:
        for text in (f"a{sign}b {sign} '{sign}", f"It'{sign} DON'T {sign}'s{sign}{sign}"):
            whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder.ids(text), "<u2").tolist() == whole


def test_hilbert_curve_visits_every_cell_in_unit_steps():
    for dimensions, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.indices((1 << bits,) * dimensions).reshape(dimensions, -1).T
        keys = packing.hilbert(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()

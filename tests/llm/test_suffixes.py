import hashlib

import numpy as np
import pytest

from skyledger.llm import suffixes
from tests.llm import odd


def brute(rows):
    """Expected rows by marking every repeated string, documents in order of id and text hash."""
    seen, out = set(), []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - suffixes.LENGTH + 1):
            window = raw[i : i + suffixes.LENGTH]
            if window in seen:
                gone[i : i + suffixes.LENGTH] = b"\1" * suffixes.LENGTH
            seen.add(window)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(docs):
    rows = suffixes.removed(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted(map(tuple, rows), key=str)


def test_fixture_equals_brute_force(spark):
    docs = odd.fixture_documents(spark)
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert result(docs) == sorted(brute(rows), key=str)


def test_odd_rows(spark):
    docs = odd.documents(spark)
    hashed = docs.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()
    order = sorted({(r.doc_id is not None, r.doc_id or 0, r.h, r.doc_id, r.text) for r in hashed})
    expected = {(doc, text): row for (_, _, _, doc, text), row in zip(order, brute([(o[3], o[4]) for o in order]))}
    assert result(docs) == sorted((expected[r.doc_id, r.text] for r in hashed), key=str)


def test_small_runs_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "RUN", 40)
    monkeypatch.setattr(suffixes, "RANGE", 60)
    rows = [(i, odd.prose(1 + i % 3, 80)[i : i + 300] + odd.prose(50 + i, 15) + odd.prose(9, 40)) for i in range(60)]
    docs = odd.documents(spark, rows)
    assert result(docs) == sorted(brute(rows), key=str)


def test_kept_bytes(spark):
    rows = [(1, odd.prose(1, 40)), (2, "begin " + odd.prose(1, 40) + " end")]
    kept = {r.doc_id: bytes(r.kept) for r in suffixes.deduplicated(odd.documents(spark, rows)).collect()}
    assert kept[1] == rows[0][1].encode()
    assert kept[2] == b"begin  end"


def test_empty(spark):
    assert result(odd.documents(spark, [])) == []


@pytest.mark.parametrize("runs", [1, 2, 3, 5, 8])
def test_merge_gives_order_and_prefixes(runs):
    draw = np.random.default_rng(runs)
    sources, everything = [], []
    for _ in range(runs):
        words = sorted(bytes(draw.integers(0, 2, draw.integers(1, 12)).astype(np.uint8)) for _ in range(30))
        known = [0] + [suffixes.common_prefix(a, b, 0) for a, b in zip(words, words[1:])]
        sources.append(iter([(w, k) for w, k in zip(words, known)]))
        everything += words
    merged = list(suffixes.merged(sources))
    assert [entry[0] for _, entry in merged] == sorted(everything)
    words = [entry[0] for _, entry in merged]
    assert [k for k, _ in merged[1:]] == [suffixes.common_prefix(a, b, 0) for a, b in zip(words, words[1:])]


def test_hot_grams_meet_by_strings(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "RUN", 12)
    monkeypatch.setattr(suffixes, "STRINGS", 50)
    held = []
    passage = odd.prose(90, 40)
    rows = [(i, odd.prose(100 + i % 30, 25) + f" {i % 7} " + passage + " " + odd.prose(200 + i % 20, 25)) for i in range(60)]
    docs = odd.documents(spark, rows)
    find_runs = suffixes.runs

    def watched(active, bounds, total, hot):
        made = suffixes.cut(find_runs(active, bounds, total, hot))
        held.append((len(hot), made.where(f"range > {len(bounds)}").count()))
        return made

    monkeypatch.setattr(suffixes, "runs", watched)
    assert result(docs) == sorted(brute(rows), key=str)
    assert held[0][0] > 0 and held[0][1] > 0

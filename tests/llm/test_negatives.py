import duckdb
import numpy as np
import pytest

from skyledger.llm import negatives
from skyledger.llm.oracle import ORACLE

FIELDS = "vec_id long, embedding array<double>, label int, r long, size string, x int, windows int, a string, n string, p string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", 2, 3, "x", "x", "x") for row in rows], FIELDS).repartition(5)


def brute(rows):
    usable = []
    for vec, embedding, label in rows:
        if label is None or embedding is None or None in embedding or not np.isfinite(embedding).all():
            continue
        x = [int(np.floor(256 * c)) for c in embedding]
        if sum(c * c for c in x) >= 1 << 62:
            continue
        usable.append((vec, (label + 1) % 10 if vec is not None and vec % 7 == 0 else label, x))
    out = []
    for i, (anchor, label, x) in enumerate(usable):
        if anchor is None or anchor % 50:
            continue
        others = [(-sum(p * q for p, q in zip(x, y)), v is None, v or 0, j, v, own == label) for j, (v, own, y) in enumerate(usable) if j != i and len(y) == len(x)]
        others.sort()
        for score, _, _, _, positive, _ in [o for o in others if o[5]][:5]:
            fit = [o for o in others if not o[5] and 50 * -score <= 100 * -o[0] <= 95 * -score][:3]
            out += [(anchor, positive, k + 1, o[4], -score, -o[0]) for k, o in enumerate(fit)]
    return sorted(out, key=str)


def result(df):
    mined = negatives.mined(df)
    assert mined.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, mined.collect()), key=str)


def clustered(n, size, seed=0, labels=10):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, size)) * np.geomspace(3, 0.05, size)
    return [(i, (centres[i % 12] + draw.standard_normal(size) * 0.5).tolist(), int(draw.integers(labels))) for i in range(n)]


def test_all_rows_by_brute_force(spark):
    rows = clustered(700, 24)
    assert result(frame(spark, rows)) == brute(rows)


def test_small_blocks_and_a_common_label(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 40)
    monkeypatch.setattr(negatives, "CHUNK", 3)
    monkeypatch.setattr(negatives, "PAIRS", 70)
    rows = [(v, x, 1 if v % 3 else label) for v, x, label in clustered(500, 10, 1)]
    assert result(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (50, [1.0, 0.5], 1), (-50, [0.3, 0.3], 2), (1, [0.9, 0.4], 2), (2, [0.7, 0.2], 2), (3, [0.7, 0.2], 2),
        (4, None, 1), (5, [None, 1.0], 1), (6, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, 1.0], None), (100, [], 1), (101, [], 1), (102, [], 3),
        (150, [0.0, 0.0], 1), (10, [0.0, 0.0], 2), (11, [-1.0, -1.0], 1), (12, [1.0, 0.0, 0.0], 1), (None, [0.8, 0.4], 2), (None, [0.8, 0.4], 1),
        (13, [1e200, 0.0], 1), (16, [4e6, 1.0], 2), (200, [3e6, 2.0], 2), (17, [2e6, 0.0], 5), (14, [0.6, 0.3], 0), (35, [0.6, 0.3], 9), (18, [0.6, 0.3], -4),
    ]
    assert result(frame(spark, rows)) == brute(rows)


def test_empty(spark):
    assert result(frame(spark, [])) == []
    assert result(frame(spark, [(50, [1.0], 1)])) == []


def test_windows_hold_the_contract():
    top = np.array([-7, -1, 0, 1, 2, 3, 19, 20, 21, 99, 100, 101, 12345, (1 << 62) - 1], np.int64)
    for t, low, high in zip(top.tolist(), negatives.lowest(top).tolist(), negatives.highest(top).tolist()):
        assert 100 * low >= 50 * t > 100 * (low - 1) and 100 * high <= 95 * t < 100 * (high + 1)


@pytest.mark.parametrize("part", [0.9, 0.5, 0.2, 0.0])
def test_no_pair_above_a_threshold_is_lost(part):
    draw = np.random.default_rng(8)
    x = np.floor(draw.standard_normal((400, 40)) * np.geomspace(900, 3, 40) * draw.uniform(0.1, 2, (400, 1))).astype(np.int64)
    q = x[:30]
    least = (part * np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1)).max()).astype(np.int64)
    found = {(int(a), int(b)): int(s) for part_found in negatives.Block(x).reaching(q, least) for a, b, s in zip(*part_found)}
    full = q @ x.T
    assert found == {(a, b): int(full[a, b]) for a, b in zip(*np.nonzero(full >= least[:, None]))}


def test_sql_agrees_with_brute_force():
    rows = clustered(300, 6, 4)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    connection.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    single = [(v, np.array(x, np.float32).astype(float).tolist(), label) for v, x, label in rows]
    assert sorted(connection.execute(ORACLE["op12_hard_negatives"]).fetchall(), key=str) == brute(single)

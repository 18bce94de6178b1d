import numpy as np
import pytest

from skyledger.llm import embeddings


def brute(rows, limit=embeddings.LIMIT):
    usable = {
        i: np.array(v, float)
        for i, (_, v) in enumerate(rows)
        if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    }
    links = {i: 0 for i in range(len(rows))}
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in usable.items():
        for j, y in usable.items():
            if j < i and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= limit:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (vec, _) in enumerate(rows):
        if vec is not None:
            least[top(i)] = min(vec, least.get(top(i), vec))
    return sorted(((vec, links[i], least.get(top(i)) if i in usable else vec) for i, (vec, _) in enumerate(rows)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(v, e, 1, "x", 2) for v, e in rows], "vec_id long, embedding array<float>, label int, k string, m int")


def result(df):
    rows = embeddings.near(df).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


def clustered(n, size, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((n // 6 + 1, size))
    return [(i, (centres[i % len(centres)] + 0.15 * draw.standard_normal(size)).tolist()) for i in range(n)]


def test_recall_against_brute_force(spark):
    rows = clustered(1500, 64) + [(5000 + i, clustered(1500, 64)[3][1]) for i in range(40)]
    found, expected = result(frame(spark, rows)), brute([(v, np.array(e, np.float32).tolist()) for v, e in rows])
    assert sum(r[1] for r in found) >= 0.98 * sum(r[1] for r in expected)
    assert all(f[1] <= e[1] for f, e in zip(found, expected))


def test_blocks_give_the_same(spark, monkeypatch):
    rows = clustered(300, 16, 2)
    whole = result(frame(spark, rows))
    monkeypatch.setattr(embeddings, "BLOCK", 50)
    assert result(frame(spark, rows)) == whole == brute([(v, np.array(e, np.float32).tolist()) for v, e in rows])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [2.0, 0.01]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (None, [1.0, 0.001]), (11, [3e38, 0.0]), (12, [1e-40, 0.0]), (13, [-0.0, 1.0]), (14, [0.0, 1.0]),
    ]
    assert result(frame(spark, rows)) == brute(rows)


def test_empty_and_invalid_only(spark):
    assert result(frame(spark, [])) == []
    assert result(frame(spark, [(1, None)])) == [(1, 0, 1)]


def test_one_of_each_component_stays(spark):
    df = frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None)])
    kept = embeddings.deduplicated(df)
    assert sorted(r.vec_id for r in kept.collect()) == [1, 3, 4] and kept.columns == df.columns


def test_unlike_vectors_under_one_id_or_none_stay(spark):
    x, y, z = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(7, x), (7, y), (None, z), (None, [1.0, 1.0, 1.0]), (8, x), (8, x), (9, [1.0, 0.01, 0.0]), (None, y), (None, None), (None, None), (7, y)]
    kept = embeddings.deduplicated(frame(spark, rows)).collect()
    got = sorted(((r.vec_id, r.embedding) for r in kept), key=str)
    assert got == sorted([(7, x), (7, y), (None, z), (None, [1.0, 1.0, 1.0]), (None, None), (None, None)], key=str)


def test_estimates_are_unbiased_and_bounds_hold():
    draw = np.random.default_rng(1)
    size, q = 64, embeddings.rotation(64)
    errors, inside = [], []
    for _ in range(300):
        x = draw.standard_normal((2, size))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        turned = x @ q
        signs = np.sign(turned[0]) / np.sqrt(size)
        factor = signs @ turned[0]
        bound = embeddings.ERRORS * np.sqrt(1 - factor**2) / factor / np.sqrt(size - 1)
        errors.append(turned[1] @ signs / factor - x[0] @ x[1])
        inside.append(abs(errors[-1]) <= bound)
    assert abs(np.mean(errors)) < 0.02 and np.mean(inside) > 0.99
    assert q @ q.T == pytest.approx(np.eye(size), abs=1e-9)


def test_estimate_and_bound_cover_the_product():
    draw = np.random.default_rng(3)
    x = draw.standard_normal((300, 48))
    x[150:] = x[:150] + 0.2 * draw.standard_normal((150, 48))
    packs = [row.tobytes() for row in x]
    codes, factor, rounded, scale = embeddings.coded(embeddings.unit(packs))
    group = embeddings.pa.table(
        {
            "k": range(300), "chunk": [0] * 300, "cell": [0] * 300, "i": [0] * 300, "j": [0] * 300, "cells": [[0]] * 300,
            "code": [c.tobytes() for c in codes], "rounded": [r.tobytes() for r in rounded], "factor": factor, "scale": scale,
        }
    )
    found = {(int(a), int(b)) for p, q in embeddings.candidates(group) for a, b in zip(p, q)}
    y = embeddings.unit(packs)
    linked = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(y @ y.T, 1) >= embeddings.LIMIT))}
    assert len(linked) > 100 and len(linked - found) <= len(linked) // 100
    # Few others are fetched for the exact product.
    assert len(found - linked) < 300 * 299 // 2 // 20
    kept = embeddings.promising(group).column("k").to_pylist()
    assert sorted(kept) == sorted({k for pair in found for k in pair})


def test_several_lengths_have_cells_of_their_own(spark):
    draw = np.random.default_rng(8)
    rows = [(i, draw.standard_normal(16 if i % 3 else 24).tolist()) for i in range(300)]
    distinct = embeddings.classes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    distinct = distinct.groupBy("k").agg(embeddings.F.count("*").alias("m"), embeddings.F.first("x").alias("x"))
    centres = embeddings.centroids(distinct, 300)
    assert set(centres) == {16, 24} and all(len(c) > 5 for _, c in centres.values())
    cells = {24: set(), 16: set()}
    for row in embeddings.stored(distinct, centres).collect():
        cells[len(row.rounded)] |= set(row.cells)
    assert not cells[16] & cells[24]

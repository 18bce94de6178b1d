import numpy as np

from skyledger.llm import permutations

FIELDS = "vec_id long, embedding array<float>, label int, r long, size string, x int, `order` int, region int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(v, e, 1, 2, "x", 3, 4, 5, 6) for v, e in rows], FIELDS).repartition(5)


def brute(rows):
    """(query_id, rank, vec_id, score) by comparing every query with every row."""
    usable = [(v, np.array(e, np.float32).astype(float)) for v, e in rows if e and None not in e]
    usable = [(v, x) for v, x in usable if np.isfinite(x).all() and x.any()]
    out = []
    for i, (query, x) in enumerate(usable):
        if query is None or query % 100:
            continue
        others = [(float(np.sqrt(((x - y) ** 2).sum())), v is None, v or 0, v) for j, (v, y) in enumerate(usable) if j != i and len(y) == len(x)]
        out += [(query, k + 1, v, round(d, 9)) for k, (d, _, _, v) in enumerate(sorted(others)[:10])]
    return sorted(out, key=str)


def result(df):
    return sorted(((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in permutations.nearest(df).collect()), key=str)


def recall(spark, rows):
    found, expected = result(frame(spark, rows)), brute(rows)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    return len({(r[0], r[2]) for r in found} & {(r[0], r[2]) for r in expected}) / len(expected)


def unstructured(n, size, seed=0):
    return [(i, x.tolist()) for i, x in enumerate(np.random.default_rng(seed).standard_normal((n, size)))]


def test_recall_without_structure(spark):
    assert recall(spark, unstructured(3000, 48)) >= 0.95


def test_recall_with_one_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(permutations, "BLOCK", 700)
    draw, rows = np.random.default_rng(2), unstructured(3000, 32, 1)
    common = draw.standard_normal(32)
    rows = [(i, (common + 0.02 * draw.standard_normal(32)).tolist() if i % 3 == 0 else x) for i, x in rows]
    assert recall(spark, rows) >= 0.9


def test_far_regions_are_left_out_without_loss(spark, monkeypatch):
    monkeypatch.setattr(permutations, "BLOCK", 60)
    monkeypatch.setattr(permutations, "CHUNK", 3)
    draw = np.random.default_rng(3)
    centres = 40 * draw.standard_normal((30, 16))
    rows = [(i, (centres[i % 30] + draw.standard_normal(16)).tolist()) for i in range(1500)]
    assert result(frame(spark, rows)) == brute(rows)
    kept = permutations.numbered(permutations.packed(frame(spark, rows), permutations.nonzero))
    chosen = permutations.pivots(kept)
    posted = permutations.indexed(kept, chosen)
    layout = permutations.regions(posted)
    buckets = len({b for _, b, _, _ in layout[16]})
    queries = posted.where("vec_id % 100 = 0").withColumn("bucket", permutations.F.lit(-1)).withColumn("limit", permutations.F.lit(12.0))
    sent = permutations.sent(queries, chosen, layout).count()
    assert 0 < sent < 15 * buckets / 3


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [1.0, 0.0]), (-100, [0.5, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (200, [0.0, 0.0]),
        (300, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (400, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (None, [1.0, 0.001]), (None, [1.0, 0.001]),
        (11, [3e38, 0.0]), (12, [1e-40, 0.0]), (13, [2.0, 0.0]), (14, [1.0, 1.0]), (15, [0.0, 1.0, 0.0]), (500, [1.0] * 7), (16, [1.0, -1.0]), (17, [0.0, 1.0]),
    ]
    assert result(frame(spark, rows)) == brute(rows)


def test_empty_and_without_queries(spark):
    assert result(frame(spark, [])) == []
    assert result(frame(spark, [(1, [1.0]), (2, [2.0])])) == []
    assert result(frame(spark, [(100, [1.0])])) == []


def test_nearness_is_the_footrule_distance():
    draw = np.random.default_rng(4)
    orders = np.stack([draw.permutation(20)[:8] for _ in range(50)]).astype(np.uint16)
    files = permutations.Inverted(orders)
    whole = lambda order: np.array([list(order).index(p) if p in order else 8 for p in range(20)])
    for order in orders:
        footrule = np.array([np.abs(whole(order) - whole(other)).sum() for other in orders])
        assert (72 - 2 * files.nearness(order) == footrule).all()


def test_pivots_keep_apart():
    draw = np.random.default_rng(5)
    x = np.concatenate([1e-3 * draw.standard_normal((300, 8)) + 1, draw.standard_normal((150, 8))])[draw.permutation(450)]
    taken = permutations.apart(x, 100)
    assert (np.abs(taken - 1).max(1) < 0.1).sum() <= 3

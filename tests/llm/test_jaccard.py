import re

import numpy as np

from skyledger.llm import jaccard
from tests.llm import odd


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = least.get(top(i))
        least[top(i)] = doc if known is None else known if doc is None else min(known, doc)
    return sorted(
        ((doc, len(sets[i]), least[top(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str
    )


def result(docs):
    return sorted(map(tuple, jaccard.linked(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_fixture_equals_brute_force(spark):
    docs = odd.fixture_documents(spark)
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    assert result(odd.documents(spark)) == brute(odd.texts())


def test_many_near_copies_of_several_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 3)
    monkeypatch.setattr(jaccard, "QUERIES_A_TASK", 2)
    draw = np.random.default_rng(4)
    rows = []
    for i in range(90):
        words = (odd.prose(100 + i % 4, 90) + " " + odd.prose(7, 30)).split()
        for place in draw.integers(0, len(words), draw.integers(0, 6)):
            words[place] = f"new{i}"
        rows.append((i, " ".join(words)))
    assert result(odd.documents(spark, rows)) == brute(rows)


def test_many_near_copies_in_blocks(spark, monkeypatch):
    for name, value in (("GROUP", 3), ("QUERIES_A_TASK", 2), ("LONG", 3), ("BLOCK", 4)):
        monkeypatch.setattr(jaccard, name, value)
    draw = np.random.default_rng(5)
    rows = []
    for i in range(60):
        # One large class, two small ones and texts between them, all with a shared passage.
        words = (odd.prose(200 + (i % 12) // 10 + (i % 12) // 11, 60) + " " + odd.prose(9, 60)).split()
        for place in draw.integers(0, len(words), draw.integers(0, 5)):
            words[place] = f"new{i}"
        rows.append((i, " ".join(words)))
    assert result(odd.documents(spark, rows)) == brute(rows)


def test_blocks_of_one_class_never_meet(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    posts = [(1, k, 10, 0) for k in range(200)] + [(2, k, 10, 0) for k in range(150)] + [(3, k, 10, 0) for k in range(190, 200)]
    posts = spark.createDataFrame(posts, "token long, k long, n int, place int")
    # Sets 0 to 179 are one class, 180 to 189 another, each of the rest is its own.
    classes = spark.createDataFrame([(k, 0 if k < 180 else 180) for k in range(190)], "node long, root long")
    rows = jaccard.meeting(posts, classes).collect()
    groups, met = {}, set()
    for row in rows:
        groups.setdefault(tuple(row[c] for c in jaccard.PAIR), []).append(row)
    for name, own in groups.items():
        first = [r for r in own if not r.second]
        second = first if own[0].same and name[3] == name[6] else [r for r in own if r.second]
        met |= {(name[0], *sorted((x.k, y.k))) for x in first for y in second if x.c != y.c}
    klass = {k: 0 if k < 180 else 180 if k < 190 else k for k in range(200)}
    given = [[r.k for r in posts.collect() if r.token == t] for t in (1, 2, 3)]
    assert met == {(t, x, y) for t, ks in enumerate(given, 1) for x in ks for y in ks if x < y and klass[x] != klass[y]}
    # Token 2 has one class; the large class of token 1 meets four blocks of others, not its own 36.
    assert all(r.token != 2 for r in rows) and sum(r.c == 0 and r.token == 1 for r in rows) <= 180 * 4


def test_only_groups_whose_union_holds_enough_qualify():
    pack = lambda tokens: np.array(tokens, np.uint64).tobytes()
    row = jaccard.pa.table({"c": [7], "g": [0], "union": [pack(range(0, 20))]})
    asking = {"q_k": [1, 2, 3], "q_c": [7] * 3, "q_g": [0] * 3, "q_tokens": [pack(range(2, 12)), pack(range(12, 22)), pack(range(13, 23))]}
    found = jaccard.qualifying(row, jaccard.pa.table(asking))
    # 10, 8 and 7 of 10 tokens.
    assert found.to_pydict() == {"k": [1, 2], "c": [7, 7], "g": [0, 0]}


def test_one_of_each_component_stays(spark):
    kept = jaccard.deduplicated(odd.documents(spark))
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == odd.documents(spark).columns
    # Rows are told apart by id and text: both texts without id stay; those of id 17 are copies of others.
    assert len(rows) == len(set(rows)) and [d for d, _ in rows].count(None) == 2 and 17 not in dict(rows)
    ids = {d for d, _ in rows}
    assert 1 not in ids and -5 in ids and {4, 5, 6, 7, 8, 13} <= ids


def test_only_copies_go(spark):
    clean, near = odd.prose(40, 90), odd.prose(40, 90).split()
    near[50] = "changed"
    others = [odd.prose(41 + i, 60) for i in range(6)]
    rows = [(1, clean), (5, " ".join(near)), (5, others[0]), (5, others[1]), (None, others[2]), (None, others[3]),
            (None, others[4]), (None, others[4]), (None, clean), (6, others[5]), (6, others[5]), (7, None), (7, None)]
    docs = odd.documents(spark, rows)
    kept = sorted(((r.doc_id, r.text) for r in jaccard.deduplicated(docs).collect()), key=str)
    assert kept == sorted([(1, clean), (5, others[0]), (5, others[1]), *((None, t) for t in others[2:5]), (6, others[5]), (7, None), (7, None)], key=str)
    assert result(docs) == brute(rows)


def test_texts_of_null_ids_are_read_once(spark):
    rows = [(None, odd.prose(60 + i, 30)) for i in range(8)] + [(None, odd.prose(60, 30))] * 3
    docs = odd.documents(spark, rows)
    sets = jaccard.set_keys(docs)
    distinct = sets.groupBy("k").agg(jaccard.F.min(jaccard.F.struct(sets.doc_id.isNull().alias("none"), "doc_id", "h")).alias("least"))
    keys = [r.k for r in jaccard.token_table(docs, distinct, distinct, True).collect()]
    assert len(keys) == len(set(keys)) == 8


def test_bounds_never_rule_out_a_link():
    draw = np.random.default_rng(0)
    for n in (1, 4, 5, 30, 400):
        for _ in range(50):
            pool = draw.integers(0, 1 << 63, 2 * n).astype(np.uint64)
            a, b = (np.unique(draw.choice(pool[: n + n // 8 + 1], n)) for _ in range(2))
            if jaccard.links(a, b):
                bits = jaccard.words64([jaccard.parity(b)])
                assert jaccard.may_link(np.array([len(b)]), bits, len(a), jaccard.words64([jaccard.parity(a)])[0]).all()


def test_empty(spark):
    assert result(odd.documents(spark, [])) == []

import re
from collections import Counter

import pytest

from skyledger.llm import mixing
from tests.llm import odd


def levels(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    capped = {}
    while True:
        left = total - sum(capped.values())
        free = sum(weight[s] for s in order if s not in capped)
        goals = {s: capped.get(s, left * weight[s] / free if free else 0) for s in order}
        over = {s: most * sizes[s] for s in order if s not in capped and goals[s] > most * sizes[s]}
        if not over:
            return goals
        capped.update(over)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 5, "Z": 90}, {"a": 5}, {"a": 0, "b": 0}, {"é": 3, "z": 400}])
def test_targets_share_the_excess(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert found == pytest.approx(levels(sizes))


def test_odd_rows(spark):
    docs = odd.documents(spark)
    rows = mixing.plan(docs).collect()
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    assert len(rows) == len(odd.texts()) and [r.size for r in rows] == sizes
    per_source = Counter()
    for row, size in zip(rows, sizes):
        per_source[row.source] += size
    assert all(r.source_size == per_source[r.source] for r in rows)
    for row in rows:
        rate = row.target / row.source_size
        assert int(rate) <= row.copies <= int(rate) + 1 and row.copies <= 2


def test_copies_keep_all_columns_and_agree(spark):
    docs = odd.documents(spark)
    planned = {(r.doc_id, r.text, r.source): r.copies for r in mixing.plan(docs).collect()}
    first, second = (sorted(map(str, mixing.mix(docs).collect())) for _ in range(2))
    assert first == second and mixing.mix(docs).columns == docs.columns
    count = Counter((r.doc_id, r.text, r.source) for r in mixing.mix(docs).collect())
    rows = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    assert count == Counter({k: planned[k] * n for k, n in rows.items() if planned[k]})


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, odd.prose(i, 30)) for i in range(3000)]
    found = mixing.plan(odd.documents(spark, rows)).groupBy("source").agg(
        {"target": "max", "*": "count"}
    ).collect()
    taken = Counter()
    for row in mixing.plan(odd.documents(spark, rows)).collect():
        taken[row.source] += row.size * row.copies
    for row in found:
        assert taken[row.source] == pytest.approx(row["max(target)"], rel=0.1)


def test_empty(spark):
    assert mixing.plan(odd.documents(spark, [])).count() == 0

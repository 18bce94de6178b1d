import random

import numpy as np
import pytest

from skyledger.llm import toxicity
from tests.llm import odd

BAD = ["vilest", "grotter", "snarkle", "muckish"]


def corpus(n, seed=0):
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = odd.prose(seed * n + i, draw.randint(20, 60)).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words[draw.randrange(len(words))] = draw.choice(BAD) + draw.choice(["", "en", "er"])
        junk = i % 5 == 0
        rows.append((i, " ".join(words).upper() if junk else " ".join(words)))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus(900)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return toxicity.fit(odd.documents(spark, rows), frame, toxicity.CATEGORIES)


def test_held_out_accuracy(fitted):
    rows, labels = corpus(600, 7)
    p = fitted.score([t for _, t in rows])
    flags = p >= np.array([m[1] for m in fitted.models])
    assert (flags[:, 0] == np.array([1 - q for _, q, _ in labels])).mean() > 0.97
    assert (flags[:, 1] == np.array([t for _, _, t in labels])).mean() > 0.97


def test_later_models_take_earlier_predictions(fitted):
    width = len(fitted.place) + toxicity.SURFACE + 1
    assert [len(m[0]) for m in fitted.models] == [width, width + 1]


def test_filter_keeps_columns_and_odd_rows(spark):
    rows, labels = corpus(900)
    bad = " ".join(BAD) + " " + odd.prose(3, 20)
    docs = odd.documents(spark, rows + [(5000, bad), (5001, None), (5002, ""), (None, bad), (5003, bad), (5003, bad)])
    frame = spark.createDataFrame([*labels, (0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    kept = toxicity.filtered(docs, frame)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.schema == docs.schema
    assert {5001, 5002} <= ids and not ids & {None, 5000, 5003}


def test_without_labels_nothing_is_flagged(spark):
    docs = odd.documents(spark)
    frame = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.filtered(docs, frame).count() == docs.count()
    assert toxicity.filtered(odd.documents(spark, []), frame).count() == 0


def test_fixture_labels(spark):
    docs = odd.fixture_documents(spark)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    chain = toxicity.fit(full, labels, toxicity.CATEGORIES)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.scored(full.select("doc_id", "text"), chain).where("doc_id IN (%s)" % ",".join(map(str, truth))).collect()
    assert np.mean([r.is_toxic == bool(truth[r.doc_id]) for r in rows]) > 0.97
    assert docs.count()


def test_rare_categories_keep_their_examples(spark, monkeypatch):
    """One document in 60 is toxic, and the sample takes one labelled row in ten."""
    rows, labels = corpus(3000)
    labels = [(i, q, int(t and i % 60 == 0)) for i, q, t in labels]
    rows = [(i, text if not t or i % 60 == 0 else odd.prose(9000 + i, 30)) for (i, text), (_, _, t) in zip(rows, corpus(3000)[1])]
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 300)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = odd.documents(spark, rows)
    train = toxicity.labelled(docs, frame, toxicity.CATEGORIES, 300).collect()
    assert sum(r.y[1] for r in train) == 50 and len(train) < 400
    assert abs(sum(r.weight for r in train) - 3000) < 600
    chain = toxicity.fit(docs, frame, toxicity.CATEGORIES, 300)
    flags = {r.doc_id: r.is_toxic for r in toxicity.scored(docs.select("doc_id", "text"), chain).collect()}
    truth = {i: bool(t) for i, _, t in labels}
    assert sum(flags[i] for i in truth if truth[i]) >= 45 and sum(flags[i] for i in truth if not truth[i]) <= 15


def test_texts_of_one_id_are_bounded(spark):
    rows = [(7, odd.prose(i, 20)) for i in range(40)] + [(7, odd.prose(0, 20))] * 30 + [(None, "x")] * 20 + [(8, "y")] * 50
    frame = spark.createDataFrame([(7, 1, 1), (8, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    taken = [r.doc_id for r in toxicity.labelled(odd.documents(spark, rows), frame, toxicity.CATEGORIES).collect()]
    assert sorted(taken) == [7] * toxicity.TEXTS + [8]


def test_a_category_that_is_off_says_so(spark):
    frame = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    with pytest.warns(UserWarning, match="toxic"):
        toxicity.fit(odd.documents(spark), frame, toxicity.CATEGORIES)


def test_scored_replaces_columns_of_its_names(spark, fitted):
    docs = odd.documents(spark).withColumn("p_toxic", toxicity.F.lit("x"))
    scored = toxicity.scored(docs, fitted)
    assert dict(scored.dtypes)["p_toxic"] == "double" and scored.count() == docs.count()

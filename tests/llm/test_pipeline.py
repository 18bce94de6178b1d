import re

import corpus_pipeline
from skyledger.llm import pii
from tests.llm import test_jaccard, test_packing

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, out = docs.columns, {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert all(out[name].columns == columns for name in names[:-1])

    clean = {r.doc_id: r.text for r in out["toxicity"].collect()}
    single = {r.doc_id: r.text for r in out["ngram_jaccard_join"].collect()}
    component = {doc: c for doc, _, c in test_jaccard.brute(list(clean.items()))}
    assert set(single) == {doc for doc in clean if component[doc] == doc}
    masked = {r.doc_id: r.text for r in out["pii"].collect()}
    assert masked == {doc: pii.masked(text, pii.spans(text)) for doc, text in single.items()}
    assert not any(s[0] == "email" for text in masked.values() for s in pii.spans(text))
    mixed = out["mixing"].collect()
    assert {r.text for r in mixed} <= set(masked.values()) and len({r.doc_id for r in mixed}) <= len(mixed)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in masked.values())
    assert 1.2 * words < sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed) < 1.8 * words
    assert out["packing"].count() > 0
    test_packing.check(spark, out["mixing"])


def test_run_is_the_chain_of_stages(spark):
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert pieces.columns[:4] == ["doc_id", "start", "length", "ids_crc32"] and pieces.count() > 0

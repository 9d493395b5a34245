from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import bpe, pii
from millrace.session import materialize
from tests.llm.test_neardup import brute

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, SF), name)
        kept[name] = docs.collect()
        assert i == 4 or sorted(docs.columns) == sorted(columns), name
    source = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r.doc_id: r for r in kept["quality"]}
    assert all(good[k] == source[k] for k in good)
    assert np.mean([labels[k] for k in labels if k in good]) > 0.95
    assert np.mean([k in good for k in labels if labels[k]]) > 0.9

    firsts = {r.doc_id for r in kept["near_duplicates"]}
    want = brute([(k, r.text) for k, r in good.items()], 5)
    assert firsts == {k for k, root in want.items() if k == root}

    clean = {r.doc_id: r for r in kept["personal_data"]}
    assert set(clean) == firsts
    assert all(r.text == pii.redacted(good[k].text) and r.lang == good[k].lang for k, r in clean.items())
    assert sum(len(pii.spans(good[k].text)) for k in clean) > 0

    copies = Counter(r.doc_id for r in kept["mixing"])
    assert set(copies) <= firsts and all(clean[r.doc_id] == r for r in kept["mixing"])
    fine = [k for k in firsts if labels.get(k) == 1]
    assert np.mean([k in copies for k in fine]) > 0.85

    plain = Tokenizer.from_file(bpe.default_path())
    assert Counter(r.doc_id for r in kept["token_ids"]) == copies
    for r in kept["token_ids"][::10]:
        assert r.ids == plain.encode(clean[r.doc_id].text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_empty_table_passes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
    assert docs.count() == 0


def test_odd_rows_pass_every_stage(spark):
    """Null ids and texts, repeated rows, an empty, a long and a one-word text, and columns with the stages' own names."""
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    text = docs.filter("length(text) > 400").orderBy("doc_id").first()["text"]
    odd = spark.createDataFrame(
        [(None, text + " tail of its own", "en", None, 1), (90001, None, None, "s", None), (90002, "", "en", "s", 0),
         (90003, "word", "en", "s", 4), (90004, text[:300] + "x " * 400_000, "en", "s", 9), *[(90005, text, "de", "s", 5)] * 40],
        docs.schema)
    docs = docs.unionByName(odd).selectExpr("*", "'keep' as score", "1 as size", "'b' as bands")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = Counter((r.doc_id, r.lang) for r in docs.collect())
        docs = materialize(stage(spark, docs, small), name)
        after = Counter((r.doc_id, r.lang) for r in docs.collect())
        assert set(after) <= set(before), name
        assert i == 4 or docs.columns == columns, name
        if name in ("quality", "near_duplicates"):
            assert all(after[k] <= before[k] for k in after), name
        if name == "personal_data":
            assert after == before
        if i < 4:
            assert {r.score for r in docs.collect()} == {"keep"}
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]

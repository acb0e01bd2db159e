import re

from llm import test_decontam, test_linechunks, test_packing, test_quality, test_simhash
from onsetlake.llm import quality

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]

    verdicts, bad = test_quality.brute(rows, quality.Rules())
    kept = {r[0] for r in verdicts if r[-1]}
    texts = [(d, "\n".join(x for x in t.split("\n") if (h or "", test_quality.key(x)) not in bad)) for d, h, t in rows if d in kept]
    chunked = [(d, t) for d, _, gone, t in test_linechunks.brute(texts) if not gone or re.search(r"[^\x20\x09-\x0D]", t)]
    groups = test_simhash.brute(chunked)
    alone = [(d, t) for d, t in chunked if d in {c for _, _, c in groups}]
    clean = {r[0] for r in test_decontam.brute(alone, items) if not r[5]}
    want = [(d, t) for d, t in alone if d in clean]
    assert len(rows) > len(kept) > len(alone) > len(want)

    out = docs
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], (texts, chunked, alone, want)):
        out = stage(spark, out, SF)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        found = out.select("doc_id", "text", "n_chars").collect()
        assert sorted((r.doc_id, r.text) for r in found) == sorted(expected), name
        assert all(r.n_chars == len(r.text) for r in found)
    n = test_packing.check(want, corpus_pipeline.run(spark, SF).collect(), 2048)
    assert n > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_odd_documents_pass_through_every_stage(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    words = " ".join(f"word{k}" for k in range(70))
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, words, "en", None, 0), (None, words, "en", "a", 0),
            (3, words + " more\n" * 20_000, None, "b", 0), (2, words, "en", None, 0)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == schema.names
    assert docs.count() >= 1

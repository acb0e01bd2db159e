import zlib

import pytest

from onsetlake.llm import registry, toxicity


@pytest.mark.parametrize("size,least", [("sf0.001", 2), ("sf0.01", 10)])
def test_held_out_toxic_documents_of_small_tables(spark, size, least):
    sf = f"/root/testdata/{size}"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = registry.op5_nearest_toxicity(spark, sf).collect()
    assert len({r.score for r in got}) > 2
    held = [(labels[r.doc_id], r.predicted) for r in got if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(p for t, p in held if t) >= least
    assert sum(p for t, p in held if not t) <= 0.2 * len(held)


def test_every_term_of_the_examples_counts(spark):
    filler = [f"word{k} other{k}" for k in range(12)]
    docs = spark.createDataFrame([(k, x + (" zounds" if k < 3 else "")) for k, x in enumerate(filler)] + [(50, "zounds")],
                                 "doc_id long, text string")
    known = [k for k in range(12) if zlib.crc32(str(k).encode()) % 4 != 2]
    labels = spark.createDataFrame([(k, int(k < 3)) for k in known], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert got[50].neighbours and all(n.label == 1 and n.key < 3 for n in got[50].neighbours)
    assert all(r.neighbours for r in got.values() if r.doc_id in known)

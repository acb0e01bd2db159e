"""A null and texts that look like a mark for it are different rows in every operator that shares work by row keys."""

import pytest

from onsetlake.llm import common, decontam, linechunks, quality, secrets, suffixes

ROWS = [(1, None), (1, "\x00null"), (1, "null"), (None, "\x00null"), (None, None), (1, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "h") for r in ROWS], "doc_id long, text string, source string")


def test_keys_differ(docs):
    keys = common.with_row_key(docs, "doc_id", "text").collect()
    assert len({(r._k1, r._k2) for r in keys}) == len(ROWS)


def test_every_operator_returns_each_row_once(spark, docs):
    items = spark.createDataFrame([(1, "null")], "item_id long, text string")
    assert decontam.contamination(docs, items).count() == len(ROWS)
    assert sorted(r.n_words for r in quality.quality(docs).collect()) == [0, 0, 0, 1, 1, 1]
    assert linechunks.deduplicated(docs).count() == len(ROWS)
    assert secrets.scan(docs).count() == len(ROWS)
    assert suffixes.deduplicated(docs).count() == len(ROWS)


def test_a_null_host_is_no_empty_host(spark):
    line = "the very same line here"
    rows = [(k, f"{line}\nown {k} " + "word " * 60, None if k < 2 else "") for k in range(4)]
    got = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert all(r.n_boilerplate == 0 for r in got.collect())  # two texts of either host
    merged = spark.createDataFrame([(k, t, "") for k, t, _ in rows], "doc_id long, text string, source string")
    assert all(r.n_boilerplate > 0 for r in quality.quality(merged).collect())

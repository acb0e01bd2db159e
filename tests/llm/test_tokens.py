import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from onsetlake.llm import common, tokens

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_tokens int, ids string"


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_codes_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = tokens.encode_ranks(v)
    assert len(control) == -(-len(v) // 4)
    decoded = tokens.decode_ranks(control, data)
    assert np.array_equal(decoded[:len(v)], v) and not decoded[len(v):].any()


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab .,'\n\t 漢é1　"), max_size=40))
def test_cached_words_match_plain_encoding(text):
    t = common.tokenizer(common.tokenizer_path())
    assert t.encode([text, text, "a b"])[0] == t.ids(text).tobytes()


def expected(rows, end=2):
    t = common.WordTokenizer(common.tokenizer_path()).tokenizer
    out, start = [], 0
    ids = [(d, t.encode(x or "", add_special_tokens=False).ids + [end]) for d, x in rows]
    raw = [(d, np.array(i, "<u4")) for d, i in ids]
    for d, i in sorted(raw, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((d, start, len(i), zlib.crc32(i.tobytes())))
        start += len(i)
    return out


def test_documents_against_plain_encoding(spark):
    from onsetlake.llm import registry

    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    got = registry.op1_token_files(spark, SF)
    assert sorted(map(tuple, got.collect())) == expected(rows)


@pytest.mark.parametrize("rows", [
    [],
    [(None, None), (3, ""), (1, "a b"), (2, "x " * 90_000), (5, "<|endoftext|>  \n\n end")],
])
def test_odd_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_IDS", 4)
    df = spark.createDataFrame([(d, x, 7, "clash") for d, x in rows], SCHEMA)
    got = tokens.token_files(df, common.tokenizer_path(), 2).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)


def test_repeated_rows_stay(spark):
    df = spark.createDataFrame([(1, "same"), (1, "same"), (1, "other words"), (None, "same")], "doc_id long, text string")
    got = tokens.token_files(df, common.tokenizer_path(), 2).collect()
    assert len(got) == 4
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[0][0] == 0

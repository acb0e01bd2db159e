import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from onsetlake.llm import common, packing, tokens

TEXTS = ["hello <|endoftext|> world<|endoftext|>", "<|endof<|endoftext|>", "plain words here", "", "a<|endoftext|>\n\n  b", "<|endoftext|"]


@pytest.fixture(scope="module")
def plain():
    fresh = Tokenizer.from_file(common.tokenizer_path())
    return lambda text: np.array(fresh.encode(text, add_special_tokens=False).ids, "<u4")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", "endoftext", "|>", " ", "  ", "\n", "word", "é", ".", "1"]), max_size=12))
def test_encoding_is_the_plain_one(plain, parts):
    text = "".join(parts)
    got = common.tokenizer(common.tokenizer_path()).encode(["a b", text, text, "c d"])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain(t).tolist() for t in ("a b", text, text, "c d")]


def test_token_files(spark, plain):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = sorted(tokens.token_files(df, common.tokenizer_path(), 2).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    start, want = 0, []
    for doc, text in enumerate(TEXTS):
        ids = np.append(plain(text), 2).astype("<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert list(map(tuple, got)) == want


def test_packing(spark, plain):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = packing.pack(df, common.tokenizer_path(), 0, 64).collect()
    assert {r.doc_id: (r.length, r.ids_crc32) for r in got} == {
        d: (len(plain(t)) + 1, zlib.crc32(np.append(plain(t), 0).astype("<u4").tobytes())) for d, t in enumerate(TEXTS)}

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from onsetlake.llm import buckets, common

PATH = common.tokenizer_path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=20), st.sampled_from([1, 2, 64, 4096]))
def test_pieces_are_binary_and_cover(sizes, capacity):
    doc, start, length = buckets.binary_pieces(np.array(sizes), capacity)
    for k, n in enumerate(sizes):
        mine = [(int(a), int(x)) for d, a, x in zip(doc, start, length) if d == k]
        whole, rest = divmod(n, capacity)
        want = [capacity] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        assert [x for _, x in mine] == want
        assert [a for a, _ in mine] == [sum(want[:i]) for i in range(len(want))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", "it's", "The", "İ", "é", "é", " ", "  ", "\n", "\t", "　", "12", ".", ",", "\x01", "中",
                                 "don't.", "\x1c", "ΑΣ"]), max_size=12))
def test_encoding_is_the_plain_one(parts):
    plain, text = Tokenizer.from_file(PATH), "".join(parts)
    got = common.tokenizer(PATH).encode(["a b", text, text, "C d."])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in ("a b", text, text, "C d.")]


def rows_of(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    return docs + [(None, "no key here"), (900, None), (901, ""), (902, "word " * 30_000), (5, docs[5][1]), docs[6]]


def test_pack_equals_plain_pieces(spark, tmp_path):
    rows = rows_of(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("start", F.lit("clash"))
    packed = buckets.pack(df, PATH, keep_ids=True)
    got = packed.collect()
    plain = Tokenizer.from_file(PATH)
    want = Counter()
    for key, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        _, start, length = buckets.binary_pieces(np.array([len(ids)]), 4096)
        want.update((key, int(a), int(n), zlib.crc32(ids[a:a + n].tobytes()), len(ids), ids[a:a + n].tobytes()) for a, n in zip(start, length))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in got) == want
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.offset for r in got} == {0}
    lengths = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths)  # a bucket's numbers follow one another
    buckets.write_buckets(packed, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert Counter((r.length, bytes(r.ids)) for r in back.collect()) == Counter((r.length, bytes(r.ids)) for r in got)
    assert back.where("octet_length(ids) <> 4 * length").count() == 0


def test_empty_table_and_bad_capacity(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert buckets.pack(empty, PATH).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        buckets.pack(empty, PATH, capacity=3000)

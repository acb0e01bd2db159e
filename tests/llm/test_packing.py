import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from onsetlake.llm import common, packing, registry

SF = "/root/testdata/sf0.001"


@given(st.lists(st.integers(1, 12), max_size=80))
def test_plan_places_every_piece_once(lengths):
    plan, n = packing.plan_rounds(Counter(lengths), 12)
    placed, filled = defaultdict(list), defaultdict(list)
    for length, rank, count, first, offset in plan:
        for k in range(count):
            placed[length].append(rank + k)
            filled[first + k].append((offset, length))
    assert {length: sorted(r) for length, r in placed.items()} == {length: list(range(c)) for length, c in Counter(lengths).items()}
    assert sorted(filled) == list(range(n))
    for parts in filled.values():
        ends = np.cumsum([length for _, length in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 12
    least = max(-(-sum(lengths) // 12), sum(x > 6 for x in lengths))  # no two of more than half share a sequence
    assert n <= 11 / 9 * least + 1


def encoded(text, end=0):
    t = common.tokenizer(common.tokenizer_path()).tokenizer
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def check(rows, got, capacity):
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for doc, text in rows:
        ids = encoded(text)
        mine = sorted(by_doc.pop(doc), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine))) and len(mine) == -(-len(ids) // capacity)
        assert all(r.length == capacity for r in mine[1:])
        at = 0
        for r in mine:
            assert r.start == at and zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    assert not by_doc
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(seqs)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op2_best_fit_packing(spark, SF).collect()
    n = check(rows, got, 2048)
    assert n <= 1.02 * -(-sum(r.length for r in got) // 2048) + 1


@pytest.mark.parametrize("rows", [[], [(None, None), (3, ""), (1, "a b"), (2, "x y " * 40), (4, "a b"), (5, "a b")]])
def test_odd_rows_and_ids(spark, rows):
    df = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, length int")
    packed = packing.pack(df, common.tokenizer_path(), 0, 16, keep_ids=True)
    check(rows, packed.collect(), 16)
    whole = b"".join(bytes(r.ids) for r in packing.sequences(packed).collect())
    assert Counter(np.frombuffer(whole, "<u4").tolist()) == Counter(x for _, t in rows for x in encoded(t).tolist())


def test_sequences_of_ties_and_of_nothing(spark):
    rows = [(0, 0, bytes([1, 0, 0, 0])), (0, 1, bytes([2, 0, 0, 0])), (0, 1, b""), (1, 0, bytes([3, 0, 0, 0]))]
    df = spark.createDataFrame(rows, "sequence_id long, offset long, ids binary")
    got = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in packing.sequences(df).collect()}
    assert got == {0: [1, 2], 1: [3]}
    assert packing.sequences(df.limit(0)).collect() == []

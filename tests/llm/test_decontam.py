import hashlib
import random
import re

import numpy as np
import pytest

from onsetlake.llm import decontam, registry

SF = "/root/testdata/sf0.001"


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items):
    windows = {}
    for key, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(key)
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])] - {None}
        names = ",".join(sorted(map(str, found)))
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(k, t, 3, "x") for k, t in docs], "doc_id long, text string, n_hit int, span string")
    i = spark.createDataFrame([(k, t, 5) for k, t in items], "item_id long, text string, n int")
    return sorted((tuple(r)[:6] for r in registry.decontamination_digest(d, i).collect()), key=str), d, i


def test_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r)[:6] for r in registry.op7_winnowing_decontamination(spark, SF).collect()), key=str)
    want = brute(docs, items)
    assert got == want and any(r[2] for r in want)


@pytest.mark.parametrize("seed", range(3))
def test_small_alphabet(spark, seed):
    rnd = random.Random(seed)
    make = lambda n: " ".join(rnd.choice(["a", "B", "é2", "a"]) for _ in range(n))
    items = [(k, make(rnd.choice([0, 1, 3, 7, 12, 13, 14, 20]))) for k in range(8)] + [(9, None)]
    docs = [(k, make(rnd.randint(0, 60)) + ", " + (rnd.choice(items)[1] or "")) for k in range(1, 40)]
    got, d, i = run(spark, docs, items)
    assert got == brute(docs, items)
    kept = decontam.decontaminated(d, i)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute(docs, items) if not r[5])


@pytest.mark.parametrize("docs,items", [
    ([], [(1, "a b c")]),
    ([(1, "a b c"), (1, "a b c"), (None, None), (2, ""), (3, " ,. ")], []),
    ([(1, "A-b_c"), (1, "A-b_c"), (None, None), (2, ""), (3, "word " * 40_000)], [(1, "a b"), (None, "c"), (4, "word " * 30)]),
])
def test_odd_rows(spark, docs, items):
    assert run(spark, docs, items)[0] == brute(docs, items)


def test_winnow_keeps_a_gram_of_every_window():
    rnd = np.random.default_rng(3)
    hashes = rnd.integers(0, 5, 500).astype(np.uint64)
    at = np.array([0, 0, 100, 108, 500])
    places, _ = decontam.winnow(hashes, at, 6, 13)
    for a, b in zip(at, at[1:]):
        for i in range(a, b - 12):
            assert ((places >= i) & (places + 6 <= i + 13)).any()

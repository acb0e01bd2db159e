import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from onsetlake.llm import registry, suffixes

SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab"), max_size=25).map(str.encode), min_size=1, max_size=6))
def test_run_index(strings):
    index = suffixes.RunIndex(strings)
    places = [(i, k) for i, s in enumerate(strings) for k in range(len(s) + 1)]
    order = sorted(places, key=lambda p: [c + 1000 for c in strings[p[0]][p[1]:]] + [p[0]])
    flat = {p: index.starts[p[0]] + p[1] for p in places}
    assert suffixes.suffix_order(index.symbols, len(strings)).tolist() == [flat[p] for p in order]
    assert index.lengths.sum() == len(index.symbols) and len(index.heads) == len(index.run_ends)

    def match(p, q):
        a, b = strings[p[0]][p[1]:], strings[q[0]][q[1]:]
        return next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))

    want = {flat[p]: max((match(p, q) for q in places if q != p), default=0) for p in places}
    assert index.matching_statistics().tolist() == [want[i] for i in range(len(index.symbols))]


def brute(rows, length):
    raw = [(key, (text or "").encode()) for key, text in rows]
    seen = Counter(b[i:i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for key, b in raw:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i + 1:i + length + 1] = True
        kept = bytes(c for c, g in zip(b, gone[1:]) if not g)
        out.append((key, len(b), int(gone.sum()), int((gone[1:] > gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op9_run_length_dedup(spark, SF).collect()
    want = brute(rows, 400)
    assert sorted((tuple(r)[:5] for r in got), key=str) == want and any(r[2] for r in want)


@pytest.mark.parametrize("seed,most", [(0, 3), (1, 3), (2, 4096)])
def test_repetitive_texts_and_split_anchors(spark, seed, most):
    rnd = random.Random(seed)
    passage = "".join(rnd.choice("abcdé ") for _ in range(60))
    rows = []
    for k in range(60):
        t = list(passage)
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = rnd.choice("xyz")
        rows.append((k, "".join(rnd.choice("mnop") for _ in range(rnd.randint(0, 30))) + "".join(t)))
    rows += [(100, "a" * 90), (101, "ab" * 40), (102, None), (103, ""), (104, passage), (104, passage), (None, passage[:30])]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, anchor string, start int")
    got = registry.removed_digest(suffixes.deduplicated(df, length=20, seed=4, most=most)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows, 20)


def test_empty_table_and_long_text(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.deduplicated(df).count() == 0
    rnd = random.Random(3)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(300_000))
    rows = [(1, long + long[:5000]), (2, "q" + long[1000:1399]), (3, "r" + long[1000:1400])]
    got = registry.removed_digest(suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    kept = {r.doc_id: (r.n_removed, r.n_spans) for r in got}
    assert kept == {1: (10_000, 2), 2: (0, 0), 3: (400, 1)}


def test_suffix_order_of_alike_strings_equals_plain_sorting():
    strings = [b"ab" * 40, b"ab" * 40, b"b" + b"ab" * 39, b"", b"a" * 30, b"a" * 7, b"a" * 6, bytes(range(250, 256)) * 5]
    m, symbols = len(strings), []
    for k, s in enumerate(strings):
        symbols += [x + m for x in s] + [k]
    found = suffixes.suffix_order(np.array(symbols, np.int32), m)
    assert found.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert suffixes.suffix_order(np.zeros(0, np.int32), 0).tolist() == []


def contexts_of(texts, length, seed):
    """Distinct (anchor, context, place of the anchor) of texts."""
    rows = {}
    for t in texts:
        found = suffixes.anchors(np.frombuffer(t, np.uint8), np.full(len(t), len(t)), length, seed)
        for h, place, first, last in zip(*(x.tolist() for x in found)):
            rows[h, t[first:last + length]] = place - first
    return [(h, t, place) for (h, t), place in rows.items()]


@pytest.mark.parametrize("seed,length,width", [(0, 20, 4), (1, 20, 4), (2, 20, 12), (3, 41, 8), (4, 5, 2), (5, 400, 32)])
def test_parts_of_contexts_have_every_repeated_window(seed, length, width):
    rnd = random.Random(seed)
    passage = [rnd.choice(b"abcd ") for _ in range(5 * length)]
    texts = []
    for _ in range(40):
        t = list(passage[rnd.randrange(len(passage)):]) * rnd.randint(1, 2)
        for _ in range(rnd.randint(0, 4)):
            t[rnd.randrange(len(t))] = rnd.choice(b"xyz")
        texts.append(bytes(t))
    rows = contexts_of([*texts, b"ab" * length, b"a" * 3 * length], length, width)
    want = suffixes.repeated_starts([t for _, t, _ in rows], length)
    assert any(map(len, want))
    parts = suffixes.shared_parts(rows, length)
    got = [[] for _ in rows]
    for (k, a, _), starts in zip(parts, suffixes.repeated_starts([rows[k][1][a:b] for k, a, b in parts], length)):
        got[k] += (starts + a).tolist()
    assert got == [w.tolist() for w in want]


def test_windows_that_are_alone_stay_out_of_the_index():
    rnd = random.Random(9)
    middle = bytes(rnd.choice(b"abcdefgh") for _ in range(60))  # an anchor's bytes and some more, but no window
    sides = [bytes(rnd.choice(b"abcdefgh") for _ in range(600)) for _ in range(4)]
    alone = [(7, side[:300] + middle + side[300:600], 310) for side in sides]
    assert suffixes.shared_parts(alone, 400) == []
    copied = (7, sides[0][:300] + middle + sides[0][300:500] + b"q" * 100, 310)  # windows that begin up to byte 160
    (a, b) = suffixes.shared_parts([*alone, copied], 400)
    assert (a[0], b[0]) == (0, 4) and a[1:] == b[1:] and a[1] == 0 and 560 <= a[2] < 660

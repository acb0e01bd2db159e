import math
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from onsetlake.llm import registry, toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("seed", range(3))
def test_nearest_is_exact(seed):
    rnd = np.random.default_rng(seed)
    rows = []
    for _ in range(700):
        at = sorted(rnd.choice(40, rnd.integers(1, 6), replace=False).tolist())
        w = rnd.random(len(at))
        rows.append((at, w / np.sqrt(w @ w)))
    rows.sort(key=lambda r: r[0])
    row = np.repeat(np.arange(700), [len(at) for at, _ in rows])
    term, weight = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
    index = toxicity.BlockMaxIndex(toxicity.BlockMaxIndex.arrays(row, term, weight, 700, 40))
    dense = np.zeros((700, 40))
    for k, (at, w) in enumerate(rows):
        dense[k, at] = w
    worth = rnd.random(40)
    for k in range(0, 700, 7):
        scores = dense @ dense[k]
        scores[k] = 0
        want = np.sort(scores[scores > 0])[::-1][:10]
        at = np.array(rows[k][0])
        (ids, cosines, shared), = index.nearest(np.zeros(len(at), int), at, rows[k][1], 1, 10, worth[at], np.array([k]))
        assert np.allclose(cosines, want, atol=1e-5) and np.allclose(scores[ids], cosines, atol=1e-5)
        assert np.allclose(shared, dense[ids] @ (worth * dense[k]), atol=1e-5)
    assert index.visited < 100 * 11


def test_blocks_are_not_opened_for_maxima_of_different_vectors():
    """Each block has a vector for every common term, but only two vectors have them all."""
    rows, terms = 40 * toxicity.BLOCK, 10
    dense = np.zeros((rows, terms + 1))
    dense[np.arange(rows), np.arange(rows) % terms] = 1
    dense[[70, 2000], :terms] = 1 / np.sqrt(terms)
    dense[::97, terms] = 0.01  # a rare term
    row, term = np.nonzero(dense)
    index = toxicity.BlockMaxIndex(toxicity.BlockMaxIndex.arrays(row, term, dense[row, term], rows, terms + 1))
    query = np.full(terms + 1, 1 / np.sqrt(terms + 1))
    worth = np.linspace(0, 1, terms + 1)
    (ids, cosines, shared), = index.nearest(np.zeros(terms + 1, int), np.arange(terms + 1), query, 1, 2, worth)
    assert ids.tolist() == [70, 2000] and np.allclose(cosines, (dense @ query)[ids]) and np.allclose(shared, (dense @ (worth * query))[ids])
    assert index.visited <= 8


def test_monotone():
    x, y = np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0])
    knots, values = toxicity.monotone(x, y, np.ones(4))
    assert np.allclose(np.interp(x, knots, values), [0, 0.5, 0.5, 1])


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in registry.op5_nearest_toxicity(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    held = [(labels[d], r.predicted) for d, r in got.items() if r.held_out and d in labels]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    hits = [b for a, b in held if a]
    assert sum(hits) >= 0.9 * len(hits)
    assert all(labels[n.key] == n.label and zlib.crc32(str(n.key).encode()) % 4 != 2 for r in got.values() for n in r.neighbours)


@pytest.mark.parametrize("docs,labels", [
    ([], [(1, 1), (2, 0)]),
    ([(1, "a"), (2, None)], []),
    ([(1, "a"), (2, None)], [(1, 1)]),
    ([(1, "a"), (2, "b c"), (3, None)], [(1, 1), (2, 0), (4, 0)]),
    ([(k, "kind words here" if k % 3 else "nasty thing " * (1 + k % 2)) for k in range(60)] * 2 + [(None, None), (99, ""), (98, "nasty " * 9000)],
     [(k, int(k % 3 == 0)) for k in range(60)] + [(3, 0), (4, None), (None, 1)]),
])
def test_odd_rows(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, "k") for r in docs], "doc_id long, text string, toxic int, term string")
    l = spark.createDataFrame([(k, 1, t, "x") for k, t in labels], "doc_id long, quality int, toxic int, text string")
    got = toxicity.toxicity(d, l).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    if len(docs) > 10:
        assert all((r.score >= 0.3) == (r.doc_id == 98 or r.doc_id < 60 and r.doc_id % 3 == 0) for r in got if r.doc_id not in (None, 99))
        assert len({r.score for r in got if r.doc_id in (None, 99)}) == 1


def plain_terms(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    out = Counter()
    for w in words:
        raw = w.encode()
        out["=", raw] += 1
        if len(raw) > 7:
            out["7", raw[:7]] += 1
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBc\u00e9 -1\u4e2d\n", max_size=60)), min_size=1, max_size=6))
def test_terms_are_the_plain_ones(texts):
    text, term, n = toxicity.text_terms(pa.array(texts, pa.string()), 7)
    names = {}
    for i, t in enumerate(texts):
        want = plain_terms(t)
        got = dict(zip(term[text == i].tolist(), n[text == i].tolist()))
        assert sorted(got.values()) == sorted(want.values())
        for name, count in got.items():  # a name stands for one term everywhere
            names.setdefault(name, set()).update(x for x, m in want.items() if m == count)
    assert len(names) == len(set().union(*map(set, map(plain_terms, texts)), set()))


def plain_scores(docs, labels, k=100, prior=0.01):
    """Scores from a dense matrix of cosines, each example voted on without itself."""
    known = {}
    for d, t in labels:
        if zlib.crc32(str(d).encode()) % 4 != 2:
            known[d] = max(known.get(d, 0), t)
    terms = [plain_terms(t) for _, t in docs]
    own = [i for i, (d, _) in enumerate(docs) if d in known]
    vocab = sorted({t for i in own for t in terms[i]})
    df = Counter(t for c in terms for t in c)
    idf = np.array([math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in vocab])
    m = np.array([[(1 + math.log(c[t])) * f if t in c else 0.0 for t, f in zip(vocab, idf)] for c in terms])
    m /= np.maximum(np.sqrt((m * m).sum(1)), 1e-150)[:, None]
    e, y = m[own], np.array([known[docs[i][0]] for i in own])
    held = e > 0

    def vote(q, without=None):
        among = np.array([j for j in range(len(own)) if j != without])
        a, b = held[among][y[among] == 1].sum(0), held[among][y[among] == 0].sum(0)
        n1, n0 = (y[among] == 1).sum(), (y[among] == 0).sum()
        chi = (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum((a + b) * (n1 - a + n0 - b) * n1 * n0, 1.0)
        cos = e[among] @ q
        near = [j for j in np.argsort(-cos, kind="stable")[:k] if cos[j] > 0]
        w = np.array([(e[among[j]] * q) @ chi / max(1.05 - cos[j], 0.05) for j in near])
        return (w @ y[among[near]] + prior * y.mean()) / (w.sum() + prior) if near else prior * y.mean() / prior

    x = np.array([vote(e[j], j) for j in range(len(own))])
    knots, values = toxicity.monotone(x.round(9), y.astype(float), np.ones(len(y)))
    return [float(np.interp(vote(q), knots, values)) for q in m]


def test_scores_equal_brute_force(spark):
    rnd = np.random.default_rng(4)
    docs = []
    for k in range(90):
        words = rnd.choice(["alpha", "beta", "gammagamma", "delta", "epsilon", "gammagammb", f"own{k}"], 6).tolist()
        docs.append((k, " ".join(words + (["zounds"] * int(rnd.integers(1, 3)) if k % 4 == 0 else []))))
    labels = [(k, int(k % 4 == 0)) for k in range(60)]
    # more neighbours than examples, so that ties do not decide who votes
    got = toxicity.toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = {r.doc_id: r.score for r in got.collect()}
    want = plain_scores(docs, labels)
    assert np.allclose([scores[k] for k, _ in docs], want, atol=1e-3), [(k, scores[k], w) for (k, _), w in zip(docs, want) if abs(scores[k] - w) > 1e-3]


def test_workers_need_no_installed_package(tmp_path):
    """Workers start in another folder, from which the package cannot be imported."""
    code = """
import sys
sys.path.insert(0, sys.argv[1])
from onsetlake.session import build_session
from onsetlake.llm import toxicity
spark = build_session("local[2]", 2)
def importable(batches):
    import importlib.util, pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({"x": [importlib.util.find_spec("onsetlake") is not None]})
assert not any(r.x for r in spark.range(4).mapInArrow(importable, "x boolean").collect())
docs = spark.createDataFrame([(k, "kind words" if k % 2 else "nasty thing") for k in range(40)], "doc_id long, text string")
labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(40)], "doc_id long, toxic int")
got = toxicity.toxicity(docs, labels).collect()
assert all((r.score >= 0.3) == (r.doc_id % 2 == 0) for r in got), got
"""
    import os

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-3000:]


def test_examples_are_bounded_in_bytes(spark):
    docs = [(k, ("nasty " if k % 2 else "kind ") * 400) for k in range(40)]
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k, _ in docs], "doc_id long, toxic int")
    few = toxicity.example_texts(d, l, {0: 20, 1: 20}, toxicity.Settings(example_bytes=7000), "doc_id").collect()
    assert Counter(r.toxic for r in few) == {0: 3, 1: 2}  # 2,000 and 2,400 bytes a text
    least = toxicity.example_texts(d, l, {0: 20, 1: 20}, toxicity.Settings(example_bytes=1), "doc_id").collect()
    assert Counter(r.toxic for r in least) == {0: 1, 1: 1}
    assert len(toxicity.toxicity(d, l, toxicity.Settings(example_bytes=7000)).collect()) == 40

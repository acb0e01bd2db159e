import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from onsetlake.llm import clusters


def brute(rows, k=40, rounds=5):
    kept = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    name = [hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    cents = [kept[j][1] for j in sorted(range(len(kept)), key=name.__getitem__)[:k]]

    def assigned():
        return [min((int(((x - c) ** 2).sum()), j) for j, c in enumerate(cents)) for _, x in kept]

    for _ in range(rounds):
        at = [j for _, j in assigned()]
        for j in set(at):
            mine = [x for (_, x), a in zip(kept, at) if a == j]
            cents[j] = np.array([sum(map(int, col)) // len(mine) for col in zip(*mine)])
    at = assigned()
    inertia = {j: sum(d for d, a in at if a == j) for _, j in at}
    sha = [hashlib.sha256(",".join(map(str, map(int, c))).encode()).hexdigest() for c in cents]
    return sorted((-1 if i is None else i, j, d, inertia[j], sum(inertia.values()), sha[j]) for (i, _), (d, j) in zip(kept, at))


def found(df, **more):
    return sorted((-1 if r.vec_id is None else r.vec_id, *r[1:]) for r in clusters.k_means(df, **more).collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 27), st.integers(1, 27), st.integers(0, 2**32 - 1))
def test_popcounts_give_exact_products(a, b, seed):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(-(1 << a), 1 << a, (7, 64)), rng.integers(-(1 << b), 1 << b, (5, 64))
    x[0] = y[0] = 0
    x[1], y[1] = -(1 << a), (1 << b) - 1
    px, py = clusters.planes_of(x), clusters.planes_of(y)
    assert (clusters.values_of(px) == x).all() and (clusters.dots(px, py) == x @ y.T).all()


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(i % 5, 0.3, 64).tolist()) for i in range(120)]
    rows += [(1000 + i, [0.5] * 64) for i in range(80)]  # one group of copies
    rows += [(i, rows[i][1]) for i in range(7, 10)]  # the same rows again
    rows += [(None, [1.0] * 64), (300, None), (301, [1.0] * 63), (302, [None] + [1.0] * 63), (303, [float("nan")] * 64),
             (304, [float("inf")] + [0.0] * 63), (305, []), (306, [-9000.0] * 64), (307, [0.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5).withColumn("cluster", F.lit("clash"))
    assert found(df) == brute(rows)
    assert found(df, k=3, rounds=2) == brute(rows, 3, 2)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(i, [float(i)] * 64) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(df) == brute(rows)
    assert found(df.where("vec_id > 9")) == []


def test_vectors_too_large_for_exact_distances_raise(spark):
    df = spark.createDataFrame([(1, [1e30] + [0.0] * 63)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="would not fit"):
        clusters.k_means(df).collect()

"""Running sums by range, the moment matrix, similar names, records that do not fit, metrics on write."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from onsetlake.functions import stats
from onsetlake.functions.scan import running_sum
from onsetlake.operators import geo, quality
from onsetlake.sources import files


def test_running_sum_over_ranges_keeps_nulls_in_place(spark):
    rng = np.random.default_rng(2)
    rows = [("a" if k < 400 else None if k < 450 else "b", k, None if rng.random() < 0.2 else int(rng.integers(-5, 9))) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(7)
    got = {r.o: r.v_cumulative for r in running_sum(df, ["v"], ["o"], ["g"]).collect()}
    total: dict = {}
    for g, o, v in rows:
        if v is not None:
            total[g] = total.get(g, 0) + v
        assert got[o] == (None if v is None else total[g])
    whole = {r.o: r.v_cumulative for r in running_sum(df.drop("g"), ["v"], ["o"]).collect()}
    assert whole[499] == (None if rows[499][2] is None else sum(v for _, _, v in rows if v is not None))
    assert running_sum(df.limit(0), ["v"], ["o"], ["g"]).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 30), st.integers(1, 5))
def test_moments_of_parts_add_up(seed, rows, parts):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random((rows, 4)) < 0.3, np.nan, rng.normal(1e6, 2, (rows, 4)))
    cuts = np.sort(rng.integers(0, rows + 1, parts - 1))
    total = None
    for part in np.split(x, cuts):
        m = stats.Moments.of(part, part)
        total = m if total is None else total + m
    for i in range(4):
        for j in range(4):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            assert total.n[i, j] == both.sum()
            if both.any():
                assert np.isclose(total.c[i, j], ((a - a.mean()) * (b - b.mean())).sum(), atol=1e-6)
                assert np.isclose(total.vx[i, j], ((a - a.mean()) ** 2).sum(), atol=1e-6)


def test_correlation_of_many_columns_and_constants(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 20))
    x[:, 3], x[:, 4] = 0.1, x[:, 5] * 2
    rows = [[None if rng.random() < 0.1 and k != 3 else float(v) for k, v in enumerate(row)] for row in x]
    names = [f"c{k}" for k in range(20)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(3)
    got = {(r.x, r.y): (r.r, r.n) for r in stats.correlation_matrix(df, names).collect()}
    assert len(got) == 400
    held = np.array([[np.nan if v is None else v for v in row] for row in rows])
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(held[:, i]) & ~np.isnan(held[:, j])
            r, n = got[a, b]
            assert n == both.sum() and (r is None) == (3 in (i, j))
            if r is not None:
                assert np.isclose(r, np.corrcoef(held[both, i], held[both, j])[0, 1])


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("cutoff", [0.4, 0.6, 0.75, 1.0])
def test_no_similar_pair_is_lost(spark, cutoff):
    rng = np.random.default_rng(9)
    words = sorted({"".join(rng.choice(list("abC "), rng.integers(0, 8))) for _ in range(70)} | {"Cuba", "Cyba", "a", ""})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {(r.name, r.cand) for r in geo.similar_names(df.select(F.col("w").alias("name")), df.select(F.col("w").alias("cand")), cutoff).collect()}
    want = {(a, b) for a in words for b in words if a and b and 1 - edits(a.lower(), b.lower()) / max(len(a), len(b)) >= cutoff}
    assert got == want


def test_records_that_do_not_fit_keep_their_lines(spark, tmp_path):
    good = ['"A","06.07.2020","v",1,0.5,3', "B,07.07.2020,w,2,,4"]
    bad = ['"A","06.07.2020"', '"A,06.07.2020,v,1,0.5,3', "A,99.99.2020,v,1,0.5,3", "A,06.07.2020,v,x,0.5,3", "A,06.07.2020,v,1,0.5,3,9"]
    (tmp_path / "lines.csv").write_text("\n".join(good + bad) + "\n")
    typed, rejects = files.split_records(spark, str(tmp_path / "lines.csv"))
    assert sorted((r.location, r.num_sequences) for r in typed.collect()) == [("A", 1), ("B", 2)]
    assert sorted(r.value for r in rejects.collect()) == sorted(bad) and {r.file for r in rejects.collect()} == {"lines.csv"}


def test_metrics_are_counted_on_write(spark, tmp_path):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x long")
    checks = [quality.non_negative("x"), quality.complete(["x"])]
    got = quality.write_observed(df, checks, lambda d: d.write.parquet(str(tmp_path / "layer")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.run_checks(df, checks).collect()))
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 3

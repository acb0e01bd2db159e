"""Correlation, p-values, cumulative series and the event-window plan."""

import datetime as dt

import numpy as np

from onsetlake.functions.scan import running_sum
from onsetlake.functions import stats
from onsetlake.operators import explore


def t_two_sided(t: float, nu: float) -> float:
    """Independent check: integrate the Student t density numerically."""
    from math import gamma, pi, sqrt

    c = gamma((nu + 1) / 2) / (sqrt(nu * pi) * gamma(nu / 2))
    x = np.linspace(abs(t), abs(t) + 400, 2_000_001)
    y = c * (1 + x * x / nu) ** (-(nu + 1) / 2)
    return float(2 * np.trapezoid(y, x))


def test_pvalue_matches_t_distribution():
    for r, n in ((0.5, 10), (0.1, 50), (-0.8, 6), (0.3, 200)):
        t = r * np.sqrt((n - 2) / (1 - r * r))
        got = stats.pearson_pvalue_np(np.array([r]), np.array([n]))[0]
        assert abs(got - t_two_sided(t, n - 2)) < 1e-5


def test_constant_column_gives_null_r(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "x double, y double")
    m = {(r.x, r.y): r.r for r in stats.correlation_matrix(df, ["x", "y"]).collect()}
    assert m[("x", "y")] is None and abs(m[("y", "y")] - 1.0) < 1e-12


def test_significance_stars_and_diagonal(spark):
    rows = [(float(i), float(i) * 2 + (i % 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double")
    out = {(r.x, r.y): r for r in stats.significance(stats.correlation_matrix(df, ["a", "b"])).collect()}
    assert out[("a", "a")].stars == "***" and out[("a", "b")].stars == "***"


def test_cumulative_keeps_null_position(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1), (dt.date(2020, 1, 2), None), (dt.date(2020, 1, 3), 2)],
                               "date date, num_sequences long")
    out = [r.num_sequences_cumulative
           for r in running_sum(df, ["num_sequences"], ["date"]).orderBy("date").collect()]
    assert out == [1, None, 3]


def test_event_window_is_an_equi_join_and_exact(spark):
    ons = spark.createDataFrame([("A", "v", dt.date(2020, 3, 1))], "location string, variant string, outbreak_date date")
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    ind = spark.createDataFrame([("A", d, 1.0, 1.0, 1.0, 1.0, 1.0) for d in days],
                                "location string, date date, reproduction_rate double, "
                                "new_deaths_smoothed_per_million double, hosp_patients_per_million double, "
                                "positive_rate double, stringency_index double")
    out = explore.event_window(ons, ind, days=28)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    offs = sorted(r.day_offset for r in out.collect())
    assert offs == list(range(-27, 28))


def test_onset_matrix_both_orientations(spark):
    rows = [("E", "a", "v1", 1), ("E", "b", "v1", 2), ("E", "a", "v2", 1)]
    ranks = spark.createDataFrame(rows, "continent string, location string, variant string, outbreak_rank_global long")
    wide = {r.location: (r.v1, r.v2) for r in explore.onset_matrix(ranks, ["v1", "v2"]).collect()}
    assert wide == {"a": (1, 1), "b": (2, None)}
    tall = {r.variant: (r.a, r.b) for r in explore.onset_matrix(ranks, ["a", "b"], rows=("variant",),
                                                                 column="location").collect()}
    assert tall == {"v1": (1, 2), "v2": (1, None)}

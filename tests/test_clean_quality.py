"""Cleaning (D1-D5), data-quality constraints, gates and reconciliation (D6-D9)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from onsetlake.operators import clean, quality


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_good_open_quote_and_short_lines(spark):
    df = lines(spark, '"Angola","06.07.2020","Alpha",0,0.0,3', '"South Africa,06.07.2020,Beta,1,33.3,3',
               '"Angola","06.07.2020"')
    good = {r.location: r for r in clean.clean_variants(df).collect()}
    assert set(good) == {"Angola", "South Africa"}
    assert good["Angola"].date == dt.date(2020, 7, 6) and good["Angola"].perc_sequences == 0.0
    assert good["South Africa"].num_sequences == 1 and good["South Africa"].num_sequences_total == 3
    rej = clean.variant_rejects(df).collect()
    assert [(r.line, r.n_fields) for r in rej] == [('"Angola","06.07.2020"', 2)]


def test_bad_values_become_null_without_error(spark):
    df = lines(spark, '"A","99.99.2020","Alpha",abc,1.0,0', '"A","01.01.2021","Alpha",123.0,1.0,7900000000')
    rows = sorted(clean.clean_variants(df).collect(), key=lambda r: str(r.date))
    bad, big = rows[1], rows[0]
    assert bad.date is None and bad.num_sequences is None and bad.perc_sequences is None
    assert big.num_sequences == 123 and big.num_sequences_total == 7900000000


def test_rule_cast_types_every_column(spark):
    raw = spark.createDataFrame([("Europe", "X", "2021-01-02", "units", "12.0", "3.5", "new")],
                                "continent string, location string, date string, tests_units string, "
                                "population string, reproduction_rate string, brand_new_metric string")
    out = clean.cast_by_rules(raw)
    types = dict(out.dtypes)
    assert types["population"] == "bigint" and types["reproduction_rate"] == "double"
    assert types["date"] == "date" and types["brand_new_metric"] == "double"
    r = out.first()
    assert r.population == 12 and r.brand_new_metric is None


def _variants(spark, rows):
    return spark.createDataFrame(rows, "location string, date string, variant string, num_sequences long, "
                                       "num_sequences_total long")


def test_reconcile_excludes_overlap_and_flags_one_sided(spark):
    df = _variants(spark, [
        ("A", "d1", "x", 2, 3), ("A", "d1", "y", 1, 3), ("A", "d1", "non_who", 2, 3),
        ("B", "d1", "non_who", 4, 4),
    ])
    bad = quality.reconcile(df, exclude=F.col("variant") == "non_who").collect()
    assert [(r.location, r.sum_parts, r.declared_total) for r in bad] == [("B", None, 4)]
    with_overlap = quality.reconcile(df).where("location = 'A'").count()
    assert with_overlap == 1
    with pytest.raises(quality.DataQualityError):
        quality.reconcile_gate(quality.reconcile(df, exclude=F.col("variant") == "non_who"))


def test_run_checks_counts_violations_in_one_pass(spark):
    df = _variants(spark, [("A", "d", "x", 5, 3), ("B", "d", "x", -1, 3), ("C", "d", "x", None, 3)])
    res = {r.constraint: r for r in quality.run_checks(df, [
        quality.is_ge("num_sequences_total", "num_sequences"),
        quality.non_negative("num_sequences"),
        quality.complete(["num_sequences"]),
    ]).collect()}
    assert res["num_sequences_total >= num_sequences"].violations == 1
    assert res["num_sequences >= 0"].violations == 1
    assert res["complete(num_sequences)"].violations == 1
    assert res["complete(num_sequences)"].status == "Failure"


def test_pattern_gate_passes_only_when_all_match(spark):
    ok = spark.createDataFrame([("Cote d'Ivoire",)], "location string")
    quality.pattern_gate(quality.pattern_metrics(ok, {"location": r"^[A-Z][A-Za-z\(\)\'\-\s]+$"}))
    bad = spark.createDataFrame([("Cote d'Ivoire",), ("x1",)], "location string")
    m = quality.pattern_metrics(bad, {"location": r"^[A-Z][A-Za-z\(\)\'\-\s]+$"})
    assert m.first().fraction == 0.5
    with pytest.raises(quality.DataQualityError):
        quality.pattern_gate(m)

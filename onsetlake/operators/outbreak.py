"""Q1 and its variants: one Schulze election per continent, or one global.

``ranks`` is the onset-rank table ``(continent, location, variant,
outbreak_date, outbreak_rank_continent, outbreak_rank_global)``.
``excluded`` is a Column predicate on ``variant`` for the variants the
election drops (by default the overlapping ``non_who`` series).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onsetlake.operators.election import combined_rank

TOP_N = 5
# Fixed value of the presence resolution: every known onset maps to one day.
PRESENCE_DATE = "2020-01-01"


def _drop(ranks: DataFrame, excluded: Column | None) -> DataFrame:
    if excluded is None:
        return ranks
    return ranks.where(~F.coalesce(excluded, F.lit(False)))


def continent_outbreak_rank(ranks: DataFrame, excluded: Column | None = None,
                            rank_col: str = "outbreak_rank_global", blocks: int = 2, slices: int = 1) -> DataFrame:
    """``(continent, location, schulze_onset_rank_continent, earliest_5_in_continent)``.

    Locations with a null continent take no part (they have no continent
    election), but every location with any onset stands in its
    continent's election, even if all its variants are excluded.
    """
    scoped = ranks.where(F.col("continent").isNotNull())
    candidates = scoped.select("continent", "location").distinct()
    votes = _drop(scoped, excluded).select(
        "continent", "location", "variant", F.col(rank_col).alias("r")
    )
    ranked = combined_rank(votes, candidates, ["continent"], blocks, slices)
    return ranked.select(
        "continent",
        "location",
        F.col("rank").alias("schulze_onset_rank_continent"),
        (F.col("rank") <= TOP_N).alias("earliest_5_in_continent"),
    )


def early_hit_ranking(onsets: DataFrame, excluded: Column | None = None, blocks: int = 2, slices: int = 1) -> DataFrame:
    """Per-continent election on onset *dates* (the legacy job function).

    Ranking by date or by the per-continent rank gives the same pairwise
    comparisons inside one continent.
    """
    scoped = onsets.where(F.col("continent").isNotNull())
    candidates = scoped.select("continent", "location").distinct()
    votes = _drop(scoped, excluded).select("continent", "location", "variant", F.col("outbreak_date").alias("r"))
    return combined_rank(votes, candidates, ["continent"], blocks, slices).select(
        "continent", "location", F.col("rank").alias("early_hit_ranking")
    )


def resolve(date_col: Column, resolution: str) -> Column:
    """Flatten onset dates: ``day`` (as is), ``month``, ``year`` or ``presence``."""
    if resolution == "day":
        return date_col
    if resolution == "month":
        return F.trunc(date_col, "month")
    if resolution == "year":
        return F.trunc(date_col, "year")
    if resolution == "presence":
        return F.when(date_col.isNotNull(), F.lit(PRESENCE_DATE).cast("date"))
    raise ValueError(f"unknown resolution {resolution!r}")


def global_early_hit(onsets: DataFrame, excluded: Column | None = None, resolution: str = "day",
                     blocks: int = 2, slices: int = 1) -> DataFrame:
    """One election over all ``(continent, location)`` candidates on onset dates, in ``blocks`` squared tiles."""
    candidates = onsets.select(F.lit("global").alias("election"), "continent", "location").distinct()
    votes = _drop(onsets, excluded).select(
        F.lit("global").alias("election"), "continent", "location", "variant",
        resolve(F.col("outbreak_date"), resolution).alias("r"),
    )
    # A candidate is a (continent, location) pair; fold it into one label so the
    # election machinery sees a single candidate column, then split it again.
    sep = "\u0001"
    label = F.concat_ws(sep, F.coalesce("continent", F.lit("")), "location")
    ranked = combined_rank(
        votes.select("election", label.alias("location"), "variant", "r"),
        candidates.select("election", label.alias("location")),
        ["election"], blocks, slices,
    )
    parts = F.split(F.col("location"), sep)
    return ranked.select(
        F.nullif(F.get(parts, 0), F.lit("")).alias("continent"),
        F.get(parts, 1).alias("location"),
        F.col("rank").alias("early_hit_ranking"),
    )


def ranking_comparison(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """Per-location absolute rank difference of two rankings, sorted ascending."""
    joined = left.select("continent", "location", F.col(left_col).alias("rank_a")).join(
        right.select("continent", "location", F.col(right_col).alias("rank_b")),
        ["continent", "location"], "inner",
    )
    return joined.withColumn("abs_diff", F.abs(F.col("rank_a") - F.col("rank_b"))).orderBy("abs_diff", "location")

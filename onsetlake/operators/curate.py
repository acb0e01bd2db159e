"""Clean -> curated: latest indicators per location joined onto the variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str = "location", date_col: str = "date_indicators") -> DataFrame:
    """Rows carrying the latest date of their key; ties are all kept, null dates drop.

    The maximum per key combines before its shuffle and is joined back, so the
    wide table need not be shuffled by a key that may be hot.
    """
    latest = df.where(F.col(date_col).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.max(date_col).alias("__max"))
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col(date_col) == F.col("__max"))
    return df.join(latest, same).drop("__key", "__max")


def latest_indicators(indicators: DataFrame) -> DataFrame:
    return latest_per_key(indicators.withColumnRenamed("date", "date_indicators"))


def curate(variants: DataFrame, indicators: DataFrame) -> DataFrame:
    """``variants`` left-joined with each location's latest indicator row.

    The right side has one row per location (plus ties).  Spark measures it at
    run time: small, it is broadcast; else a shuffle join, where AQE splits
    skewed partitions of the variants.
    """
    return variants.join(latest_indicators(indicators), on="location", how="left")


def continent_mapping(variants: DataFrame, indicators: DataFrame) -> DataFrame:
    """Variants left-joined with the distinct ``(location, continent)`` pairs.

    A location listed under two continents fans out (kept, not deduplicated).
    """
    mapping = indicators.select("location", "continent").distinct()
    return variants.join(mapping, on="location", how="left")

"""PIPE3: the dashboard's serving view.

Outbreak rank LEFT JOIN predictors LEFT JOIN curated, each on
``(location, continent)``; ranks and flags cast to integers, the joined
tables' keys renamed ``name[table]`` and tagged with a geographic role in
the column metadata.  The second join is many-to-many by design (a location
fans out over its curated rows).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onsetlake.functions.joins import small_left_join_big, small_left_join_bucketed
from onsetlake.session import ensure_checkpoint_dir
from onsetlake.sources.sinks import write_bucketed

PRED = "analysis_location_variant_predictors"
CUR = "curated_country_variant_indicators"

# Geographic role tags of the serving columns.
GEO_TAGS = {
    "location": "COUNTRY",
    "predictor_location": "COUNTRY",
    f"location[{PRED}]": "COUNTRY",
    f"location[{CUR}]": "COUNTY",
    f"continent[{CUR}]": "COUNTRY",
}


SALT, SALTS = "serving_salt", 8


def curated_table(curated: DataFrame, buckets: int | None = None) -> DataFrame:
    """The curated rows as a bucketed table under the checkpoint folder: computed and shuffled once, then joined where they lie.

    A salt of date and variant spreads a hot location over ``SALTS`` buckets.
    """
    spark, name = curated.sparkSession, f"serving_curated_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = curated.withColumn(SALT, F.pmod(F.xxhash64("date", "variant"), F.lit(SALTS)).cast("int"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    keys = ["location", "continent", SALT]
    return write_bucketed(salted.repartition(buckets, *keys), name, path, keys, buckets)


def serving_dashboard(outbreak_rank: DataFrame, predictors: DataFrame, curated: DataFrame) -> DataFrame:
    """The view over a bucketed ``curated_table``, or over any curated rows, which are then joined by their sizes."""
    o = outbreak_rank.select(
        "continent", "location",
        F.col("schulze_onset_rank_continent").cast("int").alias("schulze_onset_rank_continent"),
        F.col("earliest_5_in_continent").cast("int").alias("earliest_5_in_continent"),
    )
    p = predictors.select(
        F.col("location").alias(f"location[{PRED}]"), F.col("continent").alias(f"continent[{PRED}]"),
        "predictor_location", "predictor_continent",
        F.col("predictor_rank").cast("int").alias("predictor_rank"),
        F.col("on_same_continent").cast("int").alias("on_same_continent"),
        F.col("is_in_same_continent_top_5_predictors").cast("int").alias("is_in_same_continent_top_5_predictors"),
        F.col("is_in_off_continent_top_5_predictors").cast("int").alias("is_in_off_continent_top_5_predictors"),
    )
    c = curated.withColumnsRenamed({"location": f"location[{CUR}]", "continent": f"continent[{CUR}]"})
    j1 = o.join(p, (o["location"] == p[f"`location[{PRED}]`"]) & (o["continent"] == p[f"`continent[{PRED}]`"]),
                "left")
    # j1 is small (locations and their predictors); curated is the big, possibly
    # skewed side: join it skew-safely instead of as the right side of a left join.
    keys = [["location", "continent"], [f"location[{CUR}]", f"continent[{CUR}]"]]
    j2 = small_left_join_bucketed(j1, c, *keys, SALT, SALTS) if SALT in curated.columns else small_left_join_big(j1, c, *keys)
    for name, role in GEO_TAGS.items():
        j2 = j2.withMetadata(name, {"geographic_role": role})
    return j2


def register_serving_view(df: DataFrame, name: str = "serving_dashboard", path: str | None = None) -> DataFrame:
    """SNK6: publish the view for BI reads; with ``path`` from a table written there, which BI queries then read."""
    if path:
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df

"""Typed readers for delimited files (the exploratory CSV reads)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onsetlake.session import ensure_checkpoint_dir

# The typed schema of the clean variant table.
VARIANT_SCHEMA = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("variant", T.StringType()),
    T.StructField("num_sequences", T.LongType()),
    T.StructField("perc_sequences", T.DoubleType()),
    T.StructField("num_sequences_total", T.LongType()),
])


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType = VARIANT_SCHEMA,
                   date_format: str = "dd.MM.yyyy") -> DataFrame:
    """SRC6: header CSV with a declared schema and date format; malformed
    cells become null (PERMISSIVE) instead of failing the read."""
    return (spark.read.option("header", True).option("dateFormat", date_format)
            .option("mode", "PERMISSIVE").schema(schema).csv(path))


def split_records(spark: SparkSession, path: str, schema: T.StructType = VARIANT_SCHEMA, date_format: str = "dd.MM.yyyy",
                  header: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC6 + DQ12: the typed rows of delimited files, and the raw lines that do not fit the schema as ``(file, value)``."""
    whole = T.StructType([*schema.fields, T.StructField("_line", T.StringType())])
    rows = spark.read.option("header", header).option("dateFormat", date_format).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "_line").schema(whole).csv(path) \
        .select("*", F.col("_metadata.file_name").alias("file"))
    parsed = f"{ensure_checkpoint_dir(spark).rstrip('/')}/parsed-{uuid.uuid4().hex}"
    rows.write.parquet(parsed)  # lines are parsed once, with all columns, which is what tells a line that does not fit
    rows = spark.read.parquet(parsed)
    return rows.where("_line is null").select(*schema.fieldNames()), rows.where("_line is not null").select("file", F.col("_line").alias("value"))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: header CSV with inferred column types (one extra pass over the
    data for inference; prefer :func:`read_csv_typed` for large inputs)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)

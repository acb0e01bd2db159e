"""Landing zone: pick incoming files by name, stamp an ingest date, land them
under ``raw/<dataset>/ingest_date=YYYYMMDD/`` and read one partition back.

The reference did this object by object in a function host; here the file
listing is itself a DataFrame (``binaryFile`` with the content column
pruned), routing is a column expression, and the copy is a partitioned
Spark write, so it scales with the number of files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File-name prefixes and extensions routed to each dataset.
ROUTES = (
    ("Data1", ".csv", "data1_country_variants"),
    ("Data2", ".xlsx", "data2_country_indicators"),
)


def file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """SRC13: ``(file_name, size_mb)`` of every file under ``path``.

    Only ``path`` and ``length`` are selected, so the file contents are
    never read.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        (F.col("length") / F.pow(F.lit(1024.0), 2)).alias("size_mb"),
    )


def route(file_name: Column) -> Column:
    """SRC10: dataset name for a landing file, null when it is not ours."""
    out = None
    for prefix, ext, dataset in ROUTES:
        cond = file_name.startswith(prefix) & file_name.endswith(ext)
        out = F.when(cond, F.lit(dataset)) if out is None else out.when(cond, F.lit(dataset))
    return out


def ingest_stamp(ingest_date: str | None = None) -> Column:
    """SRC11: the given ``YYYYMMDD`` or today's date in that format."""
    return F.coalesce(F.lit(ingest_date), F.date_format(F.current_date(), "yyyyMMdd"))


def read_with_provenance(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """SRC10 + SRC14: every line under ``path`` with the landing file and dataset it belongs to, in one read.

    A landing file may be a folder of parts that is named like it, after ``prefix``; ``file_size`` is the part's.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path) \
        .select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
    parts = F.transform(F.split("file_path", "/"), lambda x: F.regexp_replace(F.url_decode(x), f"^{prefix}", ""))
    names = F.filter(parts, lambda x: route(x).isNotNull())
    return lines.withColumn("file_name", F.get(names, F.lit(0))).withColumn("dataset", route(F.col("file_name"))) \
        .where(F.col("dataset").isNotNull())


def landing_plan(spark: SparkSession, landing_path: str, ingest_date: str | None = None) -> DataFrame:
    """``(path, file_name, dataset, ingest_date)`` for every routable landing file."""
    files = spark.read.format("binaryFile").load(landing_path).select("path")
    named = files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    return named.withColumn("dataset", route(F.col("file_name"))).where(F.col("dataset").isNotNull()) \
        .withColumn("ingest_date", ingest_stamp(ingest_date))


def land_text(lines: DataFrame, base: str, dataset: str, ingest_date: str) -> None:
    """SRC12 for text datasets: write lines under ``base/raw/<dataset>/ingest_date=<d>/``.

    Replaces that date of that dataset only; other dates and datasets stay.
    """
    (lines.select("value").withColumn("ingest_date", F.lit(ingest_date))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").text(f"{base}/raw/{dataset}"))


def land_files(spark: SparkSession, landing_path: str, base: str, ingest_date: str | None = None) -> DataFrame:
    """SRC10-12/SRC14: lands every file of the name list under its dataset and ingest date; returns what was landed.

    Delimited files are landed as lines, which :func:`read_partition` reads;
    workbooks as whole files (``base/raw_files``).  Only files of the list are
    read, and only the landed dates of the landed datasets are replaced.
    """
    plan = landing_plan(spark, landing_path, ingest_date)
    stamp = spark.range(1).select(ingest_stamp(ingest_date)).first()[0]
    landed = {r.dataset for r in plan.select("dataset").distinct().collect()}
    for prefix, ext, dataset in ROUTES:
        if dataset not in landed:
            continue
        glob = f"{prefix}*{ext}"
        if ext == ".csv":
            land_text(spark.read.option("pathGlobFilter", glob).text(landing_path), base, dataset, stamp)
        else:
            files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(landing_path)
            files.select("path", "content").withColumn("dataset", F.lit(dataset)).withColumn("ingest_date", F.lit(stamp)) \
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("dataset", "ingest_date").parquet(f"{base}/raw_files")
    return plan


def read_partition(spark: SparkSession, base: str, dataset: str, ingest_date: str) -> DataFrame:
    """SRC4: read one ingest-date partition; the filter prunes the other folders."""
    df = spark.read.text(f"{base}/raw/{dataset}")
    return df.where(F.col("ingest_date") == F.lit(int(ingest_date))).select("value")


def read_landed_files(spark: SparkSession, base: str, dataset: str, ingest_date: str) -> DataFrame:
    """``(path, content)`` of the whole files landed under one dataset and date."""
    df = spark.read.parquet(f"{base}/raw_files")
    return df.where((F.col("dataset") == dataset) & (F.col("ingest_date") == int(ingest_date))).select("path", "content")


def new_landing_root(shared_dir: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    return f"{shared_dir.rstrip('/')}/landing-{uuid.uuid4().hex}"

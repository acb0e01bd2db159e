"""Spark session helpers.

The library itself never creates a session; callers pass one in.  These
helpers exist for tests, the benchmark and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "onsetlake") -> SparkSession:
    master = master or os.environ.get("ONSETLAKE_MASTER", "local[8]")
    cpus = shuffle_partitions or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ONSETLAKE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is
    respected as is; a machine-local folder is only used when nothing is
    configured (local tests).
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="onsetlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def size_shuffle_partitions(spark: SparkSession, paths: list[str], bytes_per_partition: int = 128 << 20,
                            minimum: int | None = None) -> int:
    """Sets ``spark.sql.shuffle.partitions`` from the size of the inputs.

    The input bytes come from a file listing (``binaryFile`` with only the
    ``length`` column selected, so no file is read).  The count is at least the
    cluster's parallelism; AQE later coalesces the partitions that turn out
    small, so erring high costs little while erring low makes tasks spill.
    """
    from pyspark.sql import functions as F

    total = 0
    for p in paths:
        row = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p) \
            .agg(F.sum("length")).first()
        total += int(row[0] or 0)
    floor = minimum if minimum is not None else spark.sparkContext.defaultParallelism
    n = max(floor, -(-total // bytes_per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n

"""Sinks: whole-table overwrites of layer tables, optionally partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), table: str | None = None) -> None:
    """SNK1/SNK2: overwrite a Parquet layer table (idempotent per run).

    With ``table`` the data is also registered in the catalog as an
    external table at ``path``.  A null partition value lands in Hive's
    default partition and reads back as null.
    """
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """SNK3: a catalog table at ``path``, bucketed and sorted by ``keys``, read back; joins on them need no exchange of its rows."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """SNK4: CSV with every field quoted and a header."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)

"""Running sums over ranges: no window spans more than one range of the rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from onsetlake.session import ensure_checkpoint_dir


def running_sum(df: DataFrame, values: Sequence[str], order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``<value>_cumulative`` for each of ``values``: its sum over the rows of ``keys`` up to this one in ``order``.

    Rows are sorted by range and written with the number of their range.  Each range is summed
    up on its own; what earlier ranges of the same keys add is carried over by a join
    with one row for each key and range.  A null stays null at its place, and
    the sum goes on after it.  ``order`` should tell the rows of a key apart; ties share a range and take any order.
    """
    spark, keys, order = df.sparkSession, list(keys), list(order)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranges-{uuid.uuid4().hex}"
    df.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    sums = rows.groupBy(*keys, "_range").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    carried = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
                          *[F.sum(f"_{v}").over(earlier).alias(f"_{v}") for v in values])
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    def total(v: str):
        # until the first value that is not null there is no sum, whichever side it comes from
        here, before = F.sum(v).over(inside), F.col(f"_{v}")
        return F.when(F.col(v).isNotNull(), F.coalesce(here + before, here))

    return rows.join(carried, same).select(*df.columns, *[total(v).alias(f"{v}_cumulative") for v in values])

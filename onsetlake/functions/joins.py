"""Join shapes that stay safe when one side has hot keys; Spark picks the strategy from run-time sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small_left_join_bucketed(small: DataFrame, big: DataFrame, small_keys: Sequence[str], big_keys: Sequence[str],
                             salt: str, salts: int) -> DataFrame:
    """``small LEFT JOIN big`` for a ``big`` that is bucketed by ``big_keys`` and ``salt`` (0 to ``salts`` - 1).

    Small rows go once to every salt, so a hot key of the big side stays spread over
    its buckets, and the big rows are joined where they lie: by merging, since a big
    side of few bytes would else be broadcast and all its rows put out by the small side's few tasks.
    """
    pairs = list(zip(small_keys, big_keys))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    cond = copies["_salt"] == big[f"`{salt}`"]
    for sk, bk in pairs:
        cond = cond & (copies[sk] == big[f"`{bk}`"])
    matched = big.join(copies, cond, "inner")
    held = big.select(*[F.col(f"`{bk}`").alias(sk) for sk, bk in pairs]).distinct()
    unmatched = small.join(held, list(small_keys), "left_anti")
    cols = [F.col(f"`{c}`") for c in (*small.columns, *[c for c in big.columns if c != salt])]
    return matched.select(*cols).unionByName(unmatched, allowMissingColumns=True).select(*cols)


def small_left_join_big(small: DataFrame, big: DataFrame, small_keys: Sequence[str], big_keys: Sequence[str]) -> DataFrame:
    """``small LEFT JOIN big`` that stays skew-safe when ``big`` has hot keys.

    A left outer join can only build (broadcast) its right side, and AQE can
    only split skew on its left side, so a hot key of a big right side ends
    up in one task.  Instead the two inner-join, and small rows without a
    partner are added back through an anti-join against those of the small
    side's keys that the big side has (two of its columns, filtered before
    they are made distinct).
    """
    pairs = list(zip(small_keys, big_keys))
    cond = F.lit(True)
    for sk, bk in pairs:
        cond = cond & (small[sk] == big[bk])
    matched = big.join(small, cond, "inner")
    asked = small.select(*small_keys).distinct()
    held = big.select(*[F.col(f"`{bk}`").alias(sk) for sk, bk in pairs]).join(asked, list(small_keys), "left_semi").distinct()
    unmatched = small.join(held, list(small_keys), "left_anti")
    cols = [F.col(f"`{c}`") for c in (*small.columns, *big.columns)]
    return matched.select(*cols).unionByName(unmatched, allowMissingColumns=True).select(*cols)

"""Maps the shared TPC-H-like test tables onto the outbreak domain.

The product reads two data sets: dated counts of competing variants per
location, and a wide table of location indicators.  The test tables stand
in for them as follows (every mapping reads the whole table):

* continent     ``region.r_name``
* location      ``nation.n_name`` of the supplier (``level="nation"``) or the
                supplier itself (``level="supplier"``, for scale runs)
* variant       ``p_brand || '|' || p_type``
* date          ``l_shipdate`` as a date
* num_sequences ``greatest(l_quantity - 45, 0)``
* indicators    orders of the location's customers, by order date

Only ``region`` and ``nation`` are broadcast explicitly: both are fixed-size
dimensions (5 and 25 rows at every scale factor).  ``part`` and
``supplier`` grow with the scale factor, so their join strategy is left to
Spark's size statistics and AQE; each is joined on its own so that its
file size, not a join estimate, drives that choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping: variants whose brand is Brand#1 play the role
# of the overlapping "non_who" series, Brand#2 plays "others".
NON_WHO_PREFIX = "Brand#1|"
OTHERS_PREFIX = "Brand#2|"
QUANTITY_OFFSET = 45


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def variant_col(brand: Column, ptype: Column) -> Column:
    return F.concat(brand, F.lit("|"), ptype)


def excluded_variant(variant: Column, exclude: tuple[str, ...] = ("non_who",)) -> Column:
    """True for variants the analysis drops (the mapped ``non_who``/``others``)."""
    prefixes = {"non_who": NON_WHO_PREFIX, "others": OTHERS_PREFIX}
    cond = F.lit(False)
    for name in exclude:
        cond = cond | variant.startswith(prefixes[name])
    return cond


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(nationkey, continent, n_name)``: fixed-size, broadcast explicitly."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return F.broadcast(
        nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left").select(
            F.col("n_nationkey").alias("nationkey"), F.col("r_name").alias("continent"), "n_name")
    )


def attach_location(df: DataFrame, spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """Adds ``continent`` and ``location`` to rows carrying ``suppkey``.

    ``supplier`` is joined on its own, so Spark sizes it from the file and
    broadcasts it while it is small (and shuffles at scale); the fixed-size
    nation/region dimension is then attached by an explicit broadcast.
    Joining supplier to the dimension first would hide its size behind a
    join estimate (the product of both sides) and force a sort-merge join.
    """
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_nationkey").alias("nationkey"), "s_name")
    loc = F.col("n_name") if level == "nation" else F.col("s_name")
    return (
        df.join(supplier, "suppkey")
        .join(_geo(spark, sf_dir), "nationkey", "left")
        .withColumn("location", loc)
        .drop("nationkey", "n_name", "s_name")
    )


def locations(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """``(suppkey, continent, location)`` for every supplier."""
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("suppkey"))
    return attach_location(supplier, spark, sf_dir, level).select("suppkey", "continent", "location")


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("partkey"),
        variant_col(F.col("p_brand"), F.col("p_type")).alias("variant"),
    )


def _sequences(spark: SparkSession, sf_dir: str, positive_only: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    if positive_only:
        li = li.where(F.col("l_quantity") > QUANTITY_OFFSET)
    return li.select(
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.to_date("l_shipdate").alias("date"),
        F.greatest(F.col("l_quantity") - QUANTITY_OFFSET, F.lit(0.0)).cast("long").alias("num_sequences"),
    )


def variant_evolution(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """Data1 stand-in: ``(continent, location, date, variant, num_sequences)``.

    Joins first and aggregates once: ``(suppkey, partkey, date)`` is almost
    unique in lineitem, so pre-aggregating on it would add a shuffle of the
    whole table and remove nearly nothing.  The final aggregate is partial
    (map-side) before its exchange.
    """
    seq = _sequences(spark, sf_dir, positive_only=False)
    return (
        attach_location(seq.join(variants(spark, sf_dir), "partkey"), spark, sf_dir, level)
        .groupBy("continent", "location", "date", "variant")
        .agg(F.sum("num_sequences").alias("num_sequences"))
    )


def first_positive(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """``(continent, location, variant, date)`` rows with a positive count.

    ``num_sequences > 0`` becomes ``l_quantity > 45`` and is pushed into the
    parquet scan.  Lineitem is pre-aggregated to the earliest date per
    ``(suppkey, partkey)`` before joining the dimensions: onset only needs
    the minimum, so this partial aggregate is exact.  A part has few
    suppliers and each pair recurs (about 7.5 lines per pair in TPC-H), so
    when ``part``/``supplier`` are too big to broadcast the two join
    shuffles move about 7.5x fewer rows, for the price of one shuffle of
    the filtered lines.
    """
    seq = (
        _sequences(spark, sf_dir, positive_only=True)
        .groupBy("suppkey", "partkey")
        .agg(F.min("date").alias("date"))
    )
    return attach_location(seq.join(variants(spark, sf_dir), "partkey"), spark, sf_dir, level).select(
        "continent", "location", "variant", "date")


# --- raw inputs for the cleaning stage -------------------------------------
#
# Fixed values of the corruption rule: lines dated on day 13 lose the
# closing quote of the location (the repairable kind), lines dated on day 31
# are cut after the date field (the rejected kind).
OPEN_QUOTE_DAY = 13
SHORT_LINE_DAY = 31


def raw_variant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data1 as it arrives: one quoted CSV line per ``(location, date, variant)``.

    The declared total is the per-``(location, date)`` sum without the
    ``non_who`` stand-in, so reconciliation holds except where a line was
    rejected.
    """
    from pyspark.sql import Window

    evo = variant_evolution(spark, sf_dir)
    w = Window.partitionBy("location", "date")
    part = F.when(~excluded_variant(F.col("variant")), F.col("num_sequences")).otherwise(F.lit(0))
    evo = evo.withColumn("total", F.sum(part).over(w))
    n, total = F.col("num_sequences"), F.col("total")
    perc = F.when(total == 0, F.lit("0.00")).otherwise(
        F.round(F.lit(100.0) * n / total, 2).cast("decimal(10,2)").cast("string"))
    d = F.date_format("date", "dd.MM.yyyy")
    q = F.lit('"')
    tail = F.concat_ws(",", n.cast("string"), perc, total.cast("string"))
    day = F.dayofmonth("date")
    line = (
        F.when(day == SHORT_LINE_DAY, F.concat(q, F.col("location"), q, F.lit(","), q, d, q))
        .when(day == OPEN_QUOTE_DAY, F.concat(q, F.concat_ws(",", F.col("location"), d, F.col("variant"), tail)))
        .otherwise(F.concat(q, F.col("location"), q, F.lit(","), q, d, q, F.lit(","), q, F.col("variant"), q,
                            F.lit(","), tail))
    )
    return evo.select(line.alias("value"))


def _fixed4(units: Column) -> Column:
    """Text of a non-negative integer count of ten-thousandths, e.g. 45086 -> '4.5086'.

    Built from exact integers so every engine writes the same digits.
    """
    return F.concat((units / 10000).cast("long").cast("string"), F.lit("."),
                    F.lpad((units % 10000).cast("string"), 4, "0"))


def _idiv(a: Column, b: Column) -> Column:
    return F.floor(F.try_divide(a.cast("decimal(38,0)"), b.cast("decimal(38,0)"))).cast("long")


def raw_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data2 as it arrives: every value a string, one row per ``(location, date)``.

    Daily values come from the orders of the location's customers; static
    values from the location's customers.  A ``World`` row per date (null
    continent) aggregates all orders, as the real indicator file carries
    aggregate locations.  Fractional values are exact integer ratios written
    with four decimals.
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice",
                                                   "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")).select(
        "n_nationkey", F.col("r_name").alias("continent"), F.col("n_name").alias("location"))
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey).withColumn(
        "acct_cents", F.round((F.col("c_acctbal") + 1000) * 100).cast("long"))
    o = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "continent", "location", F.to_date("o_orderdate").alias("date"), "o_orderstatus", "o_orderpriority",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))

    def daily(df: DataFrame, keys: list) -> DataFrame:
        n = F.count(F.lit(1))
        return df.groupBy(*keys).agg(
            n.alias("total_tests"),
            F.count_if(F.col("o_orderstatus") == "F").alias("new_tests"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("hosp_patients"),
            _fixed4(_idiv(F.sum("cents"), n * 1000)).alias("reproduction_rate"),
            _fixed4(_idiv(F.count_if(F.col("o_orderstatus") == "F") * 10000, n)).alias("positive_rate"),
            _fixed4(_idiv(F.sum(F.substring("o_orderpriority", 1, 1).cast("long")) * 200000, n)).alias("stringency_index"),
            _fixed4(_idiv(F.sum("cents"), F.lit(10000))).alias("new_deaths_smoothed_per_million"),
            _fixed4(_idiv(F.max("cents"), F.lit(100))).alias("hosp_patients_per_million"),
        )

    def static(df: DataFrame, keys: list) -> DataFrame:
        n = F.count(F.lit(1))
        return df.groupBy(*keys).agg(
            n.alias("population"),
            _fixed4(_idiv(F.sum("acct_cents") * 100, n)).alias("population_density"),
            _fixed4(_idiv(F.count_if(F.col("c_mktsegment") == "BUILDING") * 1000000, n)).alias("median_age"),
            _fixed4(F.max("acct_cents") * 100).alias("gdp_per_capita"),
        )

    per_loc = daily(o, ["continent", "location", "date"]).join(static(cust, ["location"]), "location")
    # The World row's static values are one global aggregate each, attached
    # as one scalar subquery rather than by a join on a
    # constant key, which the optimizer would turn into a cartesian product.
    world_static = static(cust, [])
    world = daily(o, ["date"]).select(
        F.lit(None).cast("string").alias("continent"), F.lit("World").alias("location"), "*",
        world_static.select(F.struct(*world_static.columns).alias("s")).scalar().alias("s")).select("*", "s.*").drop("s")
    both = per_loc.unionByName(world)
    return both.select(
        "continent", "location", F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.lit("tests performed").alias("tests_units"),
        *[F.col(c).cast("string").alias(c) for c in ("total_tests", "new_tests", "hosp_patients", "population")],
        "reproduction_rate", "positive_rate", "stringency_index", "new_deaths_smoothed_per_million",
        "hosp_patients_per_million", "population_density", "median_age", "gdp_per_capita",
    )


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed Data2 stand-in (raw strings through the rule-driven cast)."""
    from onsetlake.operators.clean import cast_by_rules

    return cast_by_rules(raw_indicators(spark, sf_dir))


def wide_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the validated schema: the i-th one that the stand-in lacks is ``stringency_index * (i % 7 + 1) - 20``."""
    from onsetlake.operators.quality import INDICATOR_RANGES

    ind = indicators(spark, sf_dir)
    lacking = [c for c in INDICATOR_RANGES if c not in ind.columns]
    return ind.withColumns({c: F.col("stringency_index") * (i % 7 + 1) - 20 for i, c in enumerate(lacking)})


def country_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference country table stand-in: ``(name, common_name, code)`` per nation."""
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_name").alias("name"),
        F.regexp_replace("n_name", "_", " ").alias("common_name"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("code"),
    )

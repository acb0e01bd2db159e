"""Raw -> clean: malformed delimited variant lines and rule-typed indicators.

Under Spark 4 ANSI mode a bad cast, date or division raises, while the
original jobs (Spark 3.3) produced null.  Every conversion here uses the
``try_`` family so one bad cell never fails a 100 TB job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onsetlake.operators.quality import Constraint

# Field order of the variant file and its date format.
VARIANT_FIELDS = ("location", "date", "variant", "num_sequences", "perc_sequences", "num_sequences_total")
VARIANT_DATE_FORMAT = "dd.MM.yyyy"
INDICATOR_DATE_FORMAT = "yyyy-MM-dd"

# Indicator columns typed as integer counters; string columns.
INDICATOR_COUNTERS = (
    "hosp_patients", "total_tests", "new_tests", "new_tests_smoothed", "total_vaccinations",
    "people_vaccinated", "people_fully_vaccinated", "total_boosters", "new_vaccinations",
    "new_vaccinations_smoothed", "new_vaccinations_smoothed_per_million",
    "new_people_vaccinated_smoothed", "population",
)
INDICATOR_STRINGS = ("location", "continent", "tests_units")


def read_variant_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: whole lines of the variant CSV, header lines dropped.

    Read as text rather than CSV: rows with an unclosed opening quote then
    cannot swallow the next line, and no parser quirk decides the fields.
    The header is recognised by content, so it is dropped from every file
    of a multi-file folder.
    """
    return without_headers(spark.read.text(path))


def without_headers(lines: DataFrame) -> DataFrame:
    """Lines that are neither empty nor the header, wherever it stands."""
    first = F.regexp_replace(F.get(F.split("value", ","), 0), '"', "")
    return lines.where(~F.coalesce(F.trim(first) == "location", F.lit(False)) & (F.length("value") > 0))


def split_fields(lines: DataFrame, col: str = "value") -> DataFrame:
    """PRJ2/PRJ4: split on commas and strip every double quote."""
    parts = F.transform(F.split(F.col(col), ","), lambda x: F.regexp_replace(x, '"', ""))
    return lines.select(F.col(col).alias("line"), parts.alias("fields"))


def _to_long(c: Column) -> Column:
    """Integer text to bigint; accepts ``'123.0'`` and values above 2^31 (D4)."""
    direct = c.try_cast("bigint")
    via_double = c.try_cast("double").try_cast("bigint")
    return F.coalesce(direct, via_double)


def clean_variants(lines: DataFrame, col: str = "value") -> DataFrame:
    """Typed Data1 rows from raw lines with exactly six fields.

    ``perc_sequences`` is recomputed as ``100 * n / total`` (null when the
    total is zero or missing); the source value is discarded.
    """
    f = split_fields(lines, col).where(F.size("fields") == len(VARIANT_FIELDS))
    get = {name: F.get(F.col("fields"), i) for i, name in enumerate(VARIANT_FIELDS)}
    n = _to_long(get["num_sequences"])
    total = _to_long(get["num_sequences_total"])
    return f.select(
        get["location"].alias("location"),
        F.try_to_date(get["date"], VARIANT_DATE_FORMAT).alias("date"),
        get["variant"].alias("variant"),
        n.alias("num_sequences"),
        F.try_divide(F.lit(100.0) * n, total).alias("perc_sequences"),
        total.alias("num_sequences_total"),
    )


def variant_rejects(lines: DataFrame, col: str = "value") -> DataFrame:
    """DQ12: lines that do not split into six fields, with their field count."""
    f = split_fields(lines, col)
    return f.where(F.size("fields") != len(VARIANT_FIELDS)).select(
        "line", F.size("fields").cast("long").alias("n_fields")
    )


def six_fields(col: str = "value") -> Constraint:
    """DQ12/DQ13: the constraint that a raw line splits into the expected fields, so that rejects count as violations."""
    return Constraint("Review Check", f"{len(VARIANT_FIELDS)} fields", F.size(F.split(F.col(col), ",")) != len(VARIANT_FIELDS))


def cast_by_rules(raw: DataFrame, counters: Iterable[str] = INDICATOR_COUNTERS,
                  strings: Iterable[str] = INDICATOR_STRINGS, date_col: str = "date",
                  date_format: str = INDICATOR_DATE_FORMAT) -> DataFrame:
    """PRJ6: type every column by name rule in one projection.

    ``date`` -> date; counters -> bigint; listed strings stay; any other
    column -> double.  New numeric columns therefore flow through typed.
    """
    counters, strings = set(counters), set(strings)
    cols = []
    for name in raw.columns:
        c = F.col(f"`{name}`")
        if name == date_col:
            cols.append(F.try_to_date(c.cast("string"), date_format).alias(name))
        elif name in counters:
            cols.append(_to_long(c.cast("string")).alias(name))
        elif name in strings:
            cols.append(c.cast("string").alias(name))
        else:
            cols.append(c.cast("string").try_cast("double").alias(name))
    return raw.select(*cols)

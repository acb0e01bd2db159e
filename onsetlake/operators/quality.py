"""Declarative data-quality constraints, gates and profiles.

A constraint is a named *violation* predicate.  :func:`run_checks` turns a
whole catalogue into **one** aggregate pass (``count_if`` per constraint),
so checking 50 constraints costs one scan, not 50.  Nulls pass value
checks unless the constraint is a completeness check.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onsetlake.session import ensure_checkpoint_dir


class DataQualityError(Exception):
    """Raised by a gate when violations are found."""


@dataclass(frozen=True)
class Constraint:
    check: str
    constraint: str
    violation: Column
    level: str = "Warning"


def _bad(cond: Column) -> Column:
    """A violation predicate that is false (not null) when ``cond`` is unknown."""
    return F.coalesce(cond, F.lit(False))


def is_ge(a: str, b: str, check: str = "Review Check") -> Constraint:
    return Constraint(check, f"{a} >= {b}", _bad(F.col(a) < F.col(b)))


def non_negative(c: str, check: str = "Review Check") -> Constraint:
    return Constraint(check, f"{c} >= 0", _bad(F.col(c) < 0))


def complete(cols: Sequence[str], check: str = "Review Check") -> Constraint:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return Constraint(check, "complete(" + ", ".join(cols) + ")", cond)


def in_range(c: str, lo: float | None = None, hi: float | None = None, lo_strict: bool = False,
             hi_strict: bool = False, nullable: bool = True, check: str = "Schema") -> Constraint:
    x = F.col(c)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | _bad(x <= lo if lo_strict else x < lo)
    if hi is not None:
        bad = bad | _bad(x >= hi if hi_strict else x > hi)
    if not nullable:
        bad = bad | x.isNull()
    lo_s = "" if lo is None else (f"{lo} <" if lo_strict else f"{lo} <=")
    hi_s = "" if hi is None else (f"< {hi}" if hi_strict else f"<= {hi}")
    return Constraint(check, f"{lo_s} {c} {hi_s}".strip(), bad)


def matches(c: str, pattern: str, nullable: bool = True, check: str = "Schema") -> Constraint:
    x = F.col(c)
    bad = _bad(~x.rlike(pattern))
    if not nullable:
        bad = bad | x.isNull()
    return Constraint(check, f"{c} ~ {pattern}", bad)


def tolerance(c: str, expected: Column, tol: float, check: str = "Review Check") -> Constraint:
    """``abs(c - expected) < tol``; null on either side passes."""
    return Constraint(check, f"abs({c} - expected) < {tol}", _bad(F.abs(F.col(c) - expected) >= tol))


def run_checks(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """``(check, level, constraint, status, violations, fraction)`` in one pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(c.violation).alias(f"__c{i}") for i, c in enumerate(constraints)
    ]
    totals = df.agg(*aggs)
    entries = F.array(*[
        F.struct(
            F.lit(c.check).alias("check"), F.lit(c.level).alias("level"),
            F.lit(c.constraint).alias("constraint"), F.col(f"__c{i}").alias("violations"),
        )
        for i, c in enumerate(constraints)
    ])
    rows = totals.select(F.col("__rows"), F.explode(entries).alias("e"))
    return rows.select(
        "e.check", "e.level", "e.constraint",
        F.when(F.col("e.violations") == 0, "Success").otherwise("Failure").alias("status"),
        F.col("e.violations").cast("long").alias("violations"),
        F.try_divide(F.col("e.violations").cast("double"), F.col("__rows")).alias("fraction"),
    )


def write_observed(df: DataFrame, constraints: Sequence[Constraint], write: Callable[[DataFrame], None]) -> DataFrame:
    """DQ4: writes ``df`` and returns the results of ``constraints`` as ``run_checks`` does, counted while its rows pass by.

    The layer is read once; there is no second scan for its checks.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c.violation).alias(f"c{i}") for i, c in enumerate(constraints)]))
    got = seen.get
    rows = [(c.check, c.level, c.constraint, "Failure" if got[f"c{i}"] else "Success", got[f"c{i}"],
             got[f"c{i}"] / got["rows"] if got["rows"] else None) for i, c in enumerate(constraints)]
    return df.sparkSession.createDataFrame(
        rows, "check string, level string, constraint string, status string, violations long, fraction double")


def gate(results: DataFrame, message: str = "data quality gate failed") -> None:
    """Raise :class:`DataQualityError` if any constraint has violations."""
    failed = results.where(F.col("violations") > 0).select("constraint", "violations").collect()
    if failed:
        raise DataQualityError(message + ": " + ", ".join(f"{r[0]} ({r[1]})" for r in failed))


def pattern_metrics(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """DQ5: ``(column, pattern, rows, matches, violations, fraction)``.

    ``fraction`` is the share of rows whose value fully matches (a null
    counts as a non-match), the metric the original checks computed.
    """
    items = list(patterns.items())
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(F.coalesce(F.col(c).rlike(p), F.lit(False))).alias(f"__m{i}") for i, (c, p) in enumerate(items)
    ]
    totals = df.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(p).alias("pattern"), F.col(f"__m{i}").alias("matches"))
        for i, (c, p) in enumerate(items)
    ])
    return totals.select(F.col("__rows").alias("rows"), F.explode(entries).alias("e")).select(
        "e.column", "e.pattern", F.col("rows").cast("long").alias("rows"),
        F.col("e.matches").cast("long").alias("matches"),
        (F.col("rows") - F.col("e.matches")).cast("long").alias("violations"),
        F.try_divide(F.col("e.matches").cast("double"), F.col("rows")).alias("fraction"),
    )


def pattern_gate(metrics: DataFrame) -> None:
    """DQ6: passes iff every value of every column matches its pattern."""
    gate(metrics.withColumn("constraint", F.concat_ws(" ~ ", "column", "pattern")),
         "values that do not match the pattern of their column")


def reconcile(df: DataFrame, keys: Sequence[str] = ("location", "date"), part: str = "num_sequences",
              total: str = "num_sequences_total", exclude: Column | None = None) -> DataFrame:
    """DQ7: groups whose part sum differs from the declared total.

    One partial aggregate per key: the parts' sum without the excluded rows,
    the declared total (its maximum) and whether it is the same on all rows.
    A null key is a group like any other; a group of excluded rows only has a
    null sum, which differs from any total.
    """
    kept = F.lit(True) if exclude is None else ~F.coalesce(exclude, F.lit(False))
    return df.groupBy(*keys).agg(
        F.sum(F.when(kept, F.col(part))).alias("sum_parts"),
        F.max(total).alias("declared_total"),
        F.min(total).eqNullSafe(F.max(total)).alias("total_is_constant"),
    ).where(~F.col("sum_parts").eqNullSafe(F.col("declared_total")))


def reconcile_gate(mismatches: DataFrame) -> None:
    if mismatches.limit(1).count() > 0:
        raise DataQualityError("There is a mismatch between part sums and declared totals")


def null_profile(df: DataFrame) -> DataFrame:
    """AGG14: ``(column, null_pct)`` for every column, one pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(df.columns)
    ]
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("nulls"))
                        for i, c in enumerate(df.columns)])
    return df.agg(*aggs).select("__rows", F.explode(entries).alias("e")).select(
        "e.column", F.try_divide(F.lit(100.0) * F.col("e.nulls"), F.col("__rows")).alias("null_pct")
    )


def _unpivoted(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """``(column, value, n)``: non-null values of the columns with their counts, combined before the shuffle."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(kind).alias("value")) for c in cols])
    return df.select(F.explode(entries).alias("e")).where(F.col("e.value").isNotNull()) \
        .groupBy(F.col("e.column").alias("column"), F.col("e.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _listed(cols: Sequence[str], found: DataFrame) -> DataFrame:
    """One row for each of ``cols``, whether or not it has values."""
    names = found.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(found, "column", "left")


def distinct_profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """AGG7: exact distinct count per column (nulls not counted).

    Values are unpivoted and pre-aggregated, so a column's values meet in many
    tasks and no row is copied through a shuffle once per column.
    """
    cols = list(cols or df.columns)
    found = _unpivoted(df, cols, "string").groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    return _listed(cols, found).select("column", F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"))


def numeric_summary(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """AGG15: count, mean, std, min, exact quartiles and max per numeric column.

    Counts by value are range-sorted by column and value; each value's place
    follows from the counts before it, in its task and (one number a task and
    column) in earlier tasks.  Quartiles interpolate linearly between the two
    values at their places, as pandas does by default.
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    cols = list(cols)
    counted = _unpivoted(df, cols, "double")
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written with the number of their range, as two branches read them and must see the same ranges
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    counted.repartitionByRange(n_parts, "column", "value").withColumn("task", F.spark_partition_id()).write.parquet(path)
    ordered = df.sparkSession.read.parquet(path)
    before = Window.partitionBy("column").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = ordered.groupBy("column", "task").agg(F.sum("n").alias("here")) \
        .withColumn("earlier", F.coalesce(F.sum("here").over(before), F.lit(0))).drop("here")
    within = Window.partitionBy("column", "task").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ordered.withColumn("upto", F.sum("n").over(within)).join(tasks, ["column", "task"]) \
        .withColumn("upto", F.col("upto") + F.col("earlier"))  # places (upto - n, upto] hold the value
    x = F.col("value")
    stats = _moments(df, cols)
    wanted = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), ((F.col("count") - 1) * q).alias("at")) for q in (0.25, 0.5, 0.75)]))
    asked = stats.select("column", wanted.alias("w")).select("column", "w.q", "w.at")
    low, high = F.floor("at") + 1, F.ceil("at") + 1
    holds = lambda place: (F.col("upto") - F.col("n") < place) & (place <= F.col("upto"))
    found = placed.join(asked, "column").where(holds(low) | holds(high)).groupBy("column", "q", "at").agg(
        F.max(F.when(holds(low), x)).alias("lo"), F.max(F.when(holds(high), x)).alias("hi"))
    quartile = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    wide = found.groupBy("column").agg(*[F.max(F.when(F.col("q") == q, quartile)).alias(name)
                                         for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return stats.join(wide, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum and maximum of every column in one pass."""
    stats, entries = [], []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        stats += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                  F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        entries.append(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("long").alias("count"),
                                *[F.col(f"{s}{i}").alias(s) for s in ("mean", "std", "min", "max")]))
    return df.agg(*stats).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# The validated indicator schema's value ranges, as
# column: (lower, upper, lower_strict, upper_strict); None = unbounded.
INDICATOR_RANGES = {
    "total_deaths_per_million": (0, None, False, False),
    "new_deaths_per_million": (0, None, False, False),
    "new_deaths_smoothed_per_million": (0, None, False, False),
    "reproduction_rate": (-0.1, 20, True, True),
    "hosp_patients": (0, None, False, False),
    "hosp_patients_per_million": (0, None, False, False),
    "total_tests": (0, None, False, False),
    "new_tests": (0, None, False, False),
    "total_tests_per_thousand": (0, None, False, False),
    "new_tests_per_thousand": (0, None, False, False),
    "new_tests_smoothed": (0, None, False, False),
    "new_tests_smoothed_per_thousand": (0, None, False, False),
    "positive_rate": (0, 1, False, False),
    "tests_per_case": (0, None, False, False),
    "total_vaccinations": (0, None, False, False),
    "people_vaccinated": (0, None, False, False),
    "people_fully_vaccinated": (0, None, False, False),
    "total_boosters": (0, None, False, False),
    "new_vaccinations": (0, None, False, False),
    "new_vaccinations_smoothed": (0, None, False, False),
    "total_vaccinations_per_hundred": (0, None, False, False),
    "people_vaccinated_per_hundred": (0, None, False, False),
    "people_fully_vaccinated_per_hundred": (0, None, False, False),
    "new_vaccinations_smoothed_per_million": (0, None, False, False),
    "new_people_vaccinated_smoothed": (0, None, False, False),
    "new_people_vaccinated_smoothed_per_hundred": (0, None, False, False),
    "stringency_index": (0, 100, False, False),
    "population_density": (0, 21000, False, False),
    "median_age": (0, 120, False, False),
    "aged_65_older": (0, 100, False, False),
    "aged_70_older": (0, 100, False, False),
    "gdp_per_capita": (0, None, False, False),
    "extreme_poverty": (0, 100, False, False),
    "cardiovasc_death_rate": (0, 100000, False, False),
    "diabetes_prevalence": (0, 100, False, False),
    "female_smokers": (0, 100, False, False),
    "male_smokers": (0, 100, False, False),
    "handwashing_facilities": (0, 100, False, False),
    "hospital_beds_per_thousand": (0, 1000, False, False),
    "life_expectancy": (0, 150, False, False),
    "human_development_index": (0, 1, False, False),
    "population": (0, 10 ** 10, False, False),
}
# Name patterns of the validated schema (continent nullable, location not).
SCHEMA_PATTERNS = {
    "continent": (r"^[A-Za-z, ]+$", True),
    "location": (r"^[A-Za-z,\-\(\) ']+$", False),
}


def indicator_schema_constraints(columns: Iterable[str]) -> list[Constraint]:
    """DQ8/DQ9: range and pattern constraints of the indicator columns; every row violates those of an absent column."""
    present = set(columns)
    out = [matches(c, p, nullable=n) if c in present else absent(c) for c, (p, n) in SCHEMA_PATTERNS.items()]
    return out + [in_range(c, lo, hi, ls, hs) if c in present else absent(c)
                  for c, (lo, hi, ls, hs) in INDICATOR_RANGES.items()]


def absent(column: str, check: str = "Schema") -> Constraint:
    """The constraint of a column that is missing: it fails on every row."""
    return Constraint(check, f"present({column})", F.lit(True))


def failing_rows(df: DataFrame, constraint: Constraint) -> DataFrame:
    """FLT7/FLT9/FLT10: the rows that violate a constraint, whole."""
    return df.where(constraint.violation)


def schema_differences(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str]]:
    """DQ9 (types): ``(column, expected, actual)`` for missing or differently typed columns.

    Reads only the DataFrame's schema, never its rows.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(f.name, f.dataType.simpleString(), actual.get(f.name, "missing"))
            for f in expected.fields if actual.get(f.name) != f.dataType.simpleString()]


def type_results(df: DataFrame, expected: T.StructType, check: str = "Schema") -> DataFrame:
    """DQ9: the expected type of every column as a row of a check result; a missing or differently typed column is one violation."""
    wrong = {c for c, _, _ in schema_differences(df, expected)}
    rows = [(check, "Error", f"type({f.name}) = {f.dataType.simpleString()}", "Failure" if f.name in wrong else "Success",
             int(f.name in wrong), float(f.name in wrong)) for f in expected.fields]
    return df.sparkSession.createDataFrame(
        rows, "check string, level string, constraint string, status string, violations long, fraction double")

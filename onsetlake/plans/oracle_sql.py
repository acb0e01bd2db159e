"""Plain-SQL twins of the queries, for the DuckDB correctness oracle.

Each builder returns ANSI-ish SQL over the test tables (``lineitem``,
``part``, ...), written independently of the Spark code so the two can be
compared.  The Schulze chain is spelled out relationally: preferences by a
self-join, strongest paths by a recursive walk (``UNION`` keeps it finite:
the bottleneck of a walk is always one of the edge weights), wins by the
reversed pair.
"""

from __future__ import annotations

from onsetlake.plans.patterns import CONTINENT_PATTERN, DATE_PATTERN, LOCATION_PATTERN, VARIANT_PATTERN

SEP = "chr(1)"


def _excluded(col: str, names=("non_who",)) -> str:
    prefixes = {"non_who": "Brand#1|", "others": "Brand#2|"}
    return "(" + " OR ".join(f"starts_with({col}, '{prefixes[n]}')" for n in names) + ")"


def onsets_cte(level: str = "nation") -> str:
    loc = "n.n_name" if level == "nation" else "s.s_name"
    return f"""onsets AS (
  SELECT r.r_name AS continent, {loc} AS location, p.p_brand || '|' || p.p_type AS variant,
         min(CAST(l.l_shipdate AS DATE)) AS outbreak_date
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_quantity > 45
  GROUP BY 1, 2, 3),
ranks AS (
  SELECT continent, location, variant, outbreak_date,
         rank() OVER (PARTITION BY continent, variant ORDER BY outbreak_date) AS outbreak_rank_continent,
         rank() OVER (PARTITION BY variant ORDER BY outbreak_date) AS outbreak_rank_global
  FROM onsets)"""


def schulze_ctes(p: str, votes: str, cands: str) -> str:
    """CTEs ending in ``{p}_rank(e, loc, wins, rnk)`` for votes ``(e, loc, variant, r)``."""
    return f"""{p}_nv AS (SELECT e, loc, count(*) AS n FROM {votes} GROUP BY e, loc),
{p}_both AS (
  SELECT x.e, x.loc AS a, y.loc AS b, count(*) FILTER (WHERE x.r < y.r) AS lt, count(*) AS nb
  FROM {votes} x JOIN {votes} y ON x.e = y.e AND x.variant = y.variant AND x.loc <> y.loc
  GROUP BY 1, 2, 3),
{p}_pref AS (
  SELECT ca.e, ca.loc AS a, cb.loc AS b, coalesce(bo.lt, 0) + coalesce(nv.n, 0) - coalesce(bo.nb, 0) AS p
  FROM (SELECT DISTINCT e, loc FROM {cands}) ca
  JOIN (SELECT DISTINCT e, loc FROM {cands}) cb ON ca.e = cb.e AND ca.loc <> cb.loc
  LEFT JOIN {p}_both bo ON bo.e = ca.e AND bo.a = ca.loc AND bo.b = cb.loc
  LEFT JOIN {p}_nv nv ON nv.e = ca.e AND nv.loc = ca.loc),
{p}_edge AS (
  SELECT x.e, x.a, x.b, x.p AS s FROM {p}_pref x
  JOIN {p}_pref y ON x.e = y.e AND x.a = y.b AND x.b = y.a WHERE x.p > y.p),
{p}_walk(e, a, b, s) AS (
  SELECT e, a, b, s FROM {p}_edge
  UNION
  SELECT w.e, w.a, x.b, least(w.s, x.s) FROM {p}_walk w
  JOIN {p}_edge x ON w.e = x.e AND w.b = x.a AND w.a <> x.b),
{p}_str AS (SELECT e, a, b, max(s) AS s FROM {p}_walk GROUP BY 1, 2, 3),
{p}_wins AS (
  SELECT x.e, x.a AS loc, count(*) AS wins FROM {p}_str x
  LEFT JOIN {p}_str y ON x.e = y.e AND x.a = y.b AND x.b = y.a
  WHERE x.s > coalesce(y.s, 0) GROUP BY 1, 2),
{p}_rank AS (
  SELECT c.e, c.loc, coalesce(w.wins, 0) AS wins,
         CAST(rank() OVER (PARTITION BY c.e ORDER BY coalesce(w.wins, 0) DESC) AS DOUBLE) AS rnk
  FROM (SELECT DISTINCT e, loc FROM {cands}) c LEFT JOIN {p}_wins w ON w.e = c.e AND w.loc = c.loc)"""


def onset_ranks() -> str:
    return f"WITH {onsets_cte()}\nSELECT * FROM ranks"


def _q1_ctes(exclude=("non_who",), r_col: str = "outbreak_rank_global", p: str = "q1") -> str:
    return f"""v_{p} AS (SELECT continent AS e, location AS loc, variant, {r_col} AS r FROM ranks
  WHERE continent IS NOT NULL AND NOT {_excluded('variant', exclude)}),
c_{p} AS (SELECT DISTINCT continent AS e, location AS loc FROM ranks WHERE continent IS NOT NULL),
{schulze_ctes(p, f'v_{p}', f'c_{p}')}"""


def continent_outbreak_rank() -> str:
    return f"""WITH RECURSIVE {onsets_cte()},
{_q1_ctes()}
SELECT e AS continent, loc AS location, rnk AS schulze_onset_rank_continent,
       rnk <= 5 AS earliest_5_in_continent
FROM q1_rank"""


def early_hit_ranking() -> str:
    return f"""WITH RECURSIVE {onsets_cte()},
{_q1_ctes(exclude=('others', 'non_who'), r_col='outbreak_date', p='eh')}
SELECT e AS continent, loc AS location, rnk AS early_hit_ranking FROM eh_rank"""


def _global_ctes(resolution: str, p: str) -> str:
    r = {
        "day": "outbreak_date",
        "month": "date_trunc('month', outbreak_date)",
        "presence": "CASE WHEN outbreak_date IS NOT NULL THEN DATE '2020-01-01' END",
    }[resolution]
    return f"""v_{p} AS (SELECT 'global' AS e, coalesce(continent, '') || {SEP} || location AS loc, variant, {r} AS r
  FROM ranks WHERE NOT {_excluded('variant', ('others', 'non_who'))}),
c_{p} AS (SELECT DISTINCT 'global' AS e, coalesce(continent, '') || {SEP} || location AS loc FROM ranks),
{schulze_ctes(p, f'v_{p}', f'c_{p}')}"""


def ranking_comparison() -> str:
    return f"""WITH RECURSIVE {onsets_cte()},
{_global_ctes('day', 'gd')},
{_global_ctes('month', 'gm')}
SELECT nullif(split_part(d.loc, {SEP}, 1), '') AS continent, split_part(d.loc, {SEP}, 2) AS location,
       d.rnk AS rank_a, m.rnk AS rank_b, abs(d.rnk - m.rnk) AS abs_diff
FROM gd_rank d JOIN gm_rank m ON d.loc = m.loc"""


def pairwise_preferences() -> str:
    return f"""WITH RECURSIVE {onsets_cte()},
{_q1_ctes()}
SELECT e AS continent, a, b, p FROM q1_pref"""


def path_strengths() -> str:
    return f"""WITH RECURSIVE {onsets_cte()},
{_q1_ctes()}
SELECT e AS continent, a, b, s FROM q1_str"""


def global_early_hit(resolution: str = "day") -> str:
    r = {
        "day": "outbreak_date",
        "month": "date_trunc('month', outbreak_date)",
        "presence": "CASE WHEN outbreak_date IS NOT NULL THEN DATE '2020-01-01' END",
    }[resolution]
    return f"""WITH RECURSIVE {onsets_cte()},
vg AS (SELECT 'global' AS e, coalesce(continent, '') || {SEP} || location AS loc, variant, {r} AS r
  FROM ranks WHERE NOT {_excluded('variant', ('others', 'non_who'))}),
cg AS (SELECT DISTINCT 'global' AS e, coalesce(continent, '') || {SEP} || location AS loc FROM ranks),
{schulze_ctes('g', 'vg', 'cg')}
SELECT nullif(split_part(loc, {SEP}, 1), '') AS continent, split_part(loc, {SEP}, 2) AS location,
       rnk AS early_hit_ranking
FROM g_rank"""


def _pred_ctes(strict: bool = False) -> str:
    keep = "tv.r_t IS NOT NULL AND v.r < tv.r_t" if strict else "tv.r_t IS NULL OR v.r <= tv.r_t"
    standing = "v2" if strict else "el"
    return f"""tg AS (SELECT e AS t_cont, loc AS t_loc FROM q1_rank WHERE rnk <= 5),
cand AS (SELECT DISTINCT continent AS c_cont, location AS c_loc FROM ranks),
vv AS (SELECT continent AS c_cont, location AS c_loc, variant, outbreak_rank_global AS r FROM ranks
  WHERE NOT {_excluded('variant')}),
el AS (
  SELECT t.t_cont, t.t_loc, 'on' AS scope, c.c_cont, c.c_loc FROM tg t
  JOIN cand c ON c.c_cont = t.t_cont AND c.c_loc <> t.t_loc
  UNION ALL
  SELECT t.t_cont, t.t_loc, 'off' AS scope, c.c_cont, c.c_loc FROM tg t
  JOIN cand c ON c.c_cont IS DISTINCT FROM t.t_cont),
tv AS (SELECT t.t_cont, t.t_loc, v.variant, v.r AS r_t FROM tg t
  JOIN vv v ON v.c_cont = t.t_cont AND v.c_loc = t.t_loc),
v2 AS (
  SELECT el.t_cont || {SEP} || el.t_loc || {SEP} || el.scope AS e,
         coalesce(el.c_cont, '') || {SEP} || el.c_loc AS loc, v.variant, v.r
  FROM el JOIN vv v ON v.c_cont IS NOT DISTINCT FROM el.c_cont AND v.c_loc = el.c_loc
  LEFT JOIN tv ON tv.t_cont = el.t_cont AND tv.t_loc = el.t_loc AND tv.variant = v.variant
  WHERE {keep}),
c2 AS (SELECT DISTINCT e, loc FROM (
  SELECT el.t_cont || {SEP} || el.t_loc || {SEP} || el.scope AS e,
         coalesce(el.c_cont, '') || {SEP} || el.c_loc AS loc FROM el) x
  WHERE '{standing}' = 'el' OR (e, loc) IN (SELECT e, loc FROM v2)),
{schulze_ctes('q2', 'v2', 'c2')},
pred AS (
SELECT split_part(loc, {SEP}, 2) AS predictor_location,
       rnk AS predictor_rank,
       CASE WHEN split_part(e, {SEP}, 3) = 'on' THEN split_part(e, {SEP}, 1)
            ELSE nullif(split_part(loc, {SEP}, 1), '') END AS predictor_continent,
       split_part(e, {SEP}, 3) = 'on' AS on_same_continent,
       split_part(e, {SEP}, 3) = 'on' AND rnk <= 5 AS is_in_same_continent_top_5_predictors,
       split_part(e, {SEP}, 3) = 'off' AND rnk <= 5 AS is_in_off_continent_top_5_predictors,
       split_part(e, {SEP}, 1) AS continent,
       split_part(e, {SEP}, 2) AS location
FROM q2_rank WHERE rnk <= 5)"""


def predictor_locations() -> str:
    return f"""WITH RECURSIVE {onsets_cte()},
{_q1_ctes()},
{_pred_ctes()}
SELECT * FROM pred"""


# --- raw inputs, cleaning and data quality ----------------------------------

def evolution_cte() -> str:
    return """evo AS (
  SELECT r.r_name AS continent, n.n_name AS location, CAST(l.l_shipdate AS DATE) AS date,
         p.p_brand || '|' || p.p_type AS variant,
         sum(CAST(greatest(l.l_quantity - 45, 0) AS BIGINT)) AS num_sequences
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2, 3, 4)"""


def lines_cte() -> str:
    return f"""{evolution_cte()},
evt AS (
  SELECT *, sum(CASE WHEN NOT starts_with(variant, 'Brand#1|') THEN num_sequences ELSE 0 END)
            OVER (PARTITION BY location, date) AS total
  FROM evo),
evp AS (
  SELECT *, strftime(date, '%d.%m.%Y') AS dtxt,
         CASE WHEN total = 0 THEN '0.00'
              ELSE CAST(CAST(round(100.0 * num_sequences / total, 2) AS DECIMAL(10, 2)) AS VARCHAR) END AS perc
  FROM evt),
lines AS (
  SELECT CASE
    WHEN day(date) = 31 THEN '"' || location || '","' || dtxt || '"'
    WHEN day(date) = 13 THEN '"' || location || ',' || dtxt || ',' || variant || ',' ||
                             CAST(num_sequences AS VARCHAR) || ',' || perc || ',' || CAST(total AS VARCHAR)
    ELSE '"' || location || '","' || dtxt || '","' || variant || '",' ||
         CAST(num_sequences AS VARCHAR) || ',' || perc || ',' || CAST(total AS VARCHAR)
  END AS value FROM evp),
fl AS (SELECT value AS line, list_transform(string_split(value, ','), lambda x: replace(x, '"', '')) AS fields FROM lines),
clean AS (
  SELECT fields[1] AS location, CAST(try_strptime(fields[2], '%d.%m.%Y') AS DATE) AS date, fields[3] AS variant,
         coalesce(TRY_CAST(fields[4] AS BIGINT), TRY_CAST(TRY_CAST(fields[4] AS DOUBLE) AS BIGINT)) AS num_sequences,
         100.0 * coalesce(TRY_CAST(fields[4] AS BIGINT), TRY_CAST(TRY_CAST(fields[4] AS DOUBLE) AS BIGINT))
           / nullif(coalesce(TRY_CAST(fields[6] AS BIGINT), TRY_CAST(TRY_CAST(fields[6] AS DOUBLE) AS BIGINT)), 0)
           AS perc_sequences,
         coalesce(TRY_CAST(fields[6] AS BIGINT), TRY_CAST(TRY_CAST(fields[6] AS DOUBLE) AS BIGINT)) AS num_sequences_total
  FROM fl WHERE len(fields) = 6)"""


def clean_variants_csv() -> str:
    return f"WITH {lines_cte()}\nSELECT * FROM clean"


def rejects_rows() -> str:
    return f"WITH {lines_cte()}\nSELECT line, CAST(len(fields) AS BIGINT) AS n_fields FROM fl WHERE len(fields) <> 6"


def _check_rows(source: str, checks: list[tuple[str, str, str]]) -> str:
    """``checks``: (check, constraint label, SQL violation predicate)."""
    parts = []
    for check, label, bad in checks:
        lab = label.replace("'", "''")
        parts.append(
            f"""SELECT '{check}' AS "check", 'Warning' AS level, '{lab}' AS "constraint",
  CASE WHEN v = 0 THEN 'Success' ELSE 'Failure' END AS status, CAST(v AS BIGINT) AS violations,
  CAST(v AS DOUBLE) / nullif(n, 0) AS fraction
FROM (SELECT count(*) FILTER (WHERE coalesce({bad}, false)) AS v, count(*) AS n FROM {source})""")
    return "\nUNION ALL\n".join(parts)


def dq_constraints() -> str:
    rc = "Review Check"
    checks = [
        (rc, "num_sequences_total >= num_sequences", "num_sequences_total < num_sequences"),
        (rc, "num_sequences_total >= 0", "num_sequences_total < 0"),
        (rc, "num_sequences >= 0", "num_sequences < 0"),
        (rc, "perc_sequences >= 0", "perc_sequences < 0"),
        (rc, "complete(num_sequences_total, num_sequences, perc_sequences)",
         "num_sequences_total IS NULL OR num_sequences IS NULL OR perc_sequences IS NULL"),
        ("Schema", "0 <= perc_sequences <= 100", "perc_sequences < 0 OR perc_sequences > 100 OR perc_sequences IS NULL"),
    ]
    return f"WITH {lines_cte()}\n" + _check_rows("clean", checks)


def dq_pattern_metrics() -> str:
    rows = []
    for col, pat, expr, source in (("location", LOCATION_PATTERN, "fields[1]", "fl"), ("date_text", DATE_PATTERN, "fields[2]", "fl"),
                                   ("variant", VARIANT_PATTERN, "fields[3]", "fl"), ("continent", CONTINENT_PATTERN, "continent", "ind")):
        p = pat.replace("'", "''")
        rows.append(f"""SELECT '{col}' AS "column", '{p}' AS pattern, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (WHERE coalesce(regexp_matches({expr}, '{p}'), false)) AS BIGINT) AS matches,
  CAST(count(*) - count(*) FILTER (WHERE coalesce(regexp_matches({expr}, '{p}'), false)) AS BIGINT) AS violations,
  CAST(count(*) FILTER (WHERE coalesce(regexp_matches({expr}, '{p}'), false)) AS DOUBLE) / nullif(count(*), 0) AS fraction
FROM {source}""")
    return f"WITH {lines_cte()}, {indicators_cte()}\n" + "\nUNION ALL\n".join(rows)


def dq_reconcile() -> str:
    return f"""WITH {lines_cte()}
SELECT location, date,
  CAST(sum(num_sequences) FILTER (WHERE NOT coalesce(starts_with(variant, 'Brand#1|'), false)) AS BIGINT) AS sum_parts,
  max(num_sequences_total) AS declared_total,
  min(num_sequences_total) IS NOT DISTINCT FROM max(num_sequences_total) AS total_is_constant
FROM clean GROUP BY 1, 2 HAVING sum_parts IS DISTINCT FROM declared_total"""


def _f4(x: str) -> str:
    return f"(CAST(({x}) // 10000 AS VARCHAR) || '.' || lpad(CAST(({x}) % 10000 AS VARCHAR), 4, '0'))"


_DAILY = f"""count(*) AS total_tests,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS new_tests,
    count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS hosp_patients,
    {_f4("sum(cents) // (count(*) * 1000)")} AS reproduction_rate,
    {_f4("count(*) FILTER (WHERE o_orderstatus = 'F') * 10000 // count(*)")} AS positive_rate,
    {_f4("sum(CAST(substr(o_orderpriority, 1, 1) AS BIGINT)) * 200000 // count(*)")} AS stringency_index,
    {_f4("sum(cents) // 10000")} AS new_deaths_smoothed_per_million,
    {_f4("max(cents) // 100")} AS hosp_patients_per_million"""

_STATIC = f"""count(*) AS population,
    {_f4("sum(acct_cents) * 100 // count(*)")} AS population_density,
    {_f4("count(*) FILTER (WHERE c_mktsegment = 'BUILDING') * 1000000 // count(*)")} AS median_age,
    {_f4("max(acct_cents) * 100")} AS gdp_per_capita"""

COUNTERS = ("total_tests", "new_tests", "hosp_patients", "population")
DOUBLES = ("reproduction_rate", "positive_rate", "stringency_index", "new_deaths_smoothed_per_million",
           "hosp_patients_per_million", "population_density", "median_age", "gdp_per_capita")


def indicators_cte() -> str:
    raw_cols = ",\n    ".join(
        [f"CAST(d.{c} AS VARCHAR) AS {c}" for c in COUNTERS if c != "population"]
        + ["CAST(s.population AS VARCHAR) AS population"]
        + [f"{'d' if c in DOUBLES[:5] else 's'}.{c}" for c in DOUBLES]
    )
    typed = ",\n    ".join(
        [f"coalesce(TRY_CAST({c} AS BIGINT), TRY_CAST(TRY_CAST({c} AS DOUBLE) AS BIGINT)) AS {c}" for c in COUNTERS]
        + [f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in DOUBLES]
    )
    return f"""geo AS (SELECT n.n_nationkey, r.r_name AS continent, n.n_name AS location
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
cust AS (SELECT c.*, g.continent, g.location, CAST(round((c.c_acctbal + 1000) * 100) AS BIGINT) AS acct_cents
  FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey),
ord AS (SELECT cu.continent, cu.location, CAST(o.o_orderdate AS DATE) AS date, o.o_orderstatus,
               CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents, o.o_orderpriority
  FROM orders o JOIN cust cu ON o.o_custkey = cu.c_custkey),
daily AS (
  SELECT continent, location, date, {_DAILY} FROM ord GROUP BY 1, 2, 3
  UNION ALL
  SELECT CAST(NULL AS VARCHAR) AS continent, 'World' AS location, date, {_DAILY} FROM ord GROUP BY date),
stat AS (
  SELECT location, {_STATIC} FROM cust GROUP BY location
  UNION ALL
  SELECT 'World' AS location, {_STATIC} FROM cust),
raw_ind AS (
  SELECT d.continent, d.location, strftime(d.date, '%Y-%m-%d') AS date, 'tests performed' AS tests_units,
    {raw_cols}
  FROM daily d JOIN stat s ON d.location = s.location),
ind AS (
  SELECT continent, location, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date, tests_units,
    {typed}
  FROM raw_ind)"""


def clean_indicators_cast() -> str:
    return f"WITH {indicators_cte()}\nSELECT * FROM ind"


def latest_indicators() -> str:
    return f"""WITH {indicators_cte()},
li AS (SELECT * EXCLUDE (date), date AS date_indicators FROM ind)
SELECT * FROM li WHERE date_indicators = (SELECT max(x.date_indicators) FROM li x WHERE x.location = li.location)"""


def curated_join() -> str:
    return f"""WITH {lines_cte()}, {indicators_cte()},
li AS (SELECT * EXCLUDE (date), date AS date_indicators FROM ind),
latest AS (SELECT * FROM li WHERE date_indicators = (SELECT max(x.date_indicators) FROM li x WHERE x.location = li.location))
SELECT c.*, l.* EXCLUDE (location) FROM clean c LEFT JOIN latest l ON c.location = l.location"""


def continent_mapping_join() -> str:
    return f"""WITH {lines_cte()}, {indicators_cte()},
m AS (SELECT DISTINCT location, continent FROM ind)
SELECT c.*, m.continent FROM clean c LEFT JOIN m ON c.location = m.location"""


def null_profile() -> str:
    cols = ["continent", "location", "date", "tests_units", *COUNTERS, *DOUBLES]
    parts = [f"""SELECT '{c}' AS "column", 100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) AS null_pct FROM ind"""
             for c in cols]
    return f"WITH {indicators_cte()}\n" + "\nUNION ALL\n".join(parts)


def distinct_profile() -> str:
    cols = ["continent", "location", "date", "tests_units", *COUNTERS, *DOUBLES]
    parts = [f"""SELECT '{c}' AS "column", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM ind""" for c in cols]
    return f"WITH {indicators_cte()}\n" + "\nUNION ALL\n".join(parts)


def numeric_summary() -> str:
    parts = [f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, min(CAST({c} AS DOUBLE)) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, max(CAST({c} AS DOUBLE)) AS max FROM ind"""
             for c in (*COUNTERS, *DOUBLES)]
    return f"WITH {indicators_cte()}\n" + "\nUNION ALL\n".join(parts)


# --- exploration, time series, statistics ------------------------------------

STATIC = ("population", "population_density", "median_age", "gdp_per_capita")
EVENT = ("reproduction_rate", "new_deaths_smoothed_per_million", "hosp_patients_per_million",
         "positive_rate", "stringency_index")


def sampling_gap_histogram() -> str:
    return f"""WITH {lines_cte()},
g AS (SELECT location, variant, CAST(datediff('day', lag(date) OVER (PARTITION BY location, variant ORDER BY date), date) AS INTEGER) AS gap_days
  FROM clean),
d AS (SELECT DISTINCT location, variant, gap_days FROM g WHERE gap_days IS NOT NULL)
SELECT gap_days, count(*) AS n_series FROM d GROUP BY gap_days"""


def prevalence_by_date() -> str:
    return f"WITH {lines_cte()}\nSELECT date, CAST(sum(num_sequences) AS BIGINT) AS num_sequences FROM clean GROUP BY date"


def prevalence_by_variant() -> str:
    return f"WITH {lines_cte()}\nSELECT variant, date, CAST(sum(num_sequences) AS BIGINT) AS num_sequences FROM clean GROUP BY 1, 2"


def prevalence_by_location() -> str:
    return f"""WITH {lines_cte()},
seen AS (SELECT location, variant FROM clean GROUP BY 1, 2 HAVING max(num_sequences) > 0)
SELECT c.location, c.variant, c.date, CAST(sum(c.num_sequences) AS BIGINT) AS num_sequences
FROM clean c WHERE (c.location, c.variant) IN (SELECT location, variant FROM seen)
GROUP BY 1, 2, 3"""


def cumulative_by_date() -> str:
    return f"""WITH {lines_cte()},
p AS (SELECT date, CAST(sum(num_sequences) AS BIGINT) AS num_sequences FROM clean GROUP BY date)
SELECT date, num_sequences,
  CASE WHEN num_sequences IS NOT NULL THEN CAST(sum(num_sequences) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END
  AS num_sequences_cumulative
FROM p"""


def cumulative_by_variant() -> str:
    return f"""WITH {lines_cte()},
p AS (SELECT variant, date, CAST(sum(num_sequences) AS BIGINT) AS num_sequences FROM clean GROUP BY 1, 2)
SELECT variant, date, num_sequences,
  CASE WHEN num_sequences IS NOT NULL THEN CAST(sum(num_sequences) OVER (PARTITION BY variant ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END AS num_sequences_cumulative
FROM p"""


def reference_series() -> str:
    return f"""WITH {lines_cte()}, {indicators_cte()},
p AS (SELECT date, CAST(sum(num_sequences) AS BIGINT) AS num_sequences FROM clean GROUP BY date),
cum AS (SELECT date, num_sequences,
  CASE WHEN num_sequences IS NOT NULL THEN CAST(sum(num_sequences) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END
  AS num_sequences_cumulative FROM p),
ref AS (SELECT date, new_deaths_smoothed_per_million, reproduction_rate FROM ind WHERE location = 'World')
SELECT cum.*, ref.new_deaths_smoothed_per_million, ref.reproduction_rate FROM cum LEFT JOIN ref ON cum.date = ref.date"""


def event_window_28d() -> str:
    cols = ", ".join(f"i.{c}" for c in EVENT)
    return f"""WITH {onsets_cte()}, {indicators_cte()}
SELECT o.location, o.variant, o.outbreak_date, i.date, CAST(datediff('day', o.outbreak_date, i.date) AS INTEGER) AS day_offset,
       {cols}
FROM ranks o JOIN ind i ON i.location = o.location
WHERE abs(datediff('day', o.outbreak_date, i.date)) < 28"""


def _event_means_cte() -> str:
    cols = ",\n  ".join(f"CAST(sum(CAST(i.{c} AS DECIMAL(38, 4))) AS DOUBLE) / nullif(count(i.{c}), 0) AS {c}"
                          for c in (*COUNTERS, *DOUBLES))
    return f"""ewm AS (
  SELECT o.variant, o.continent, o.location, avg(o.outbreak_rank_global) AS outbreak_rank_global,
  {cols}
  FROM ranks o JOIN ind i ON i.continent = o.continent AND i.location = o.location
  WHERE abs(datediff('day', o.outbreak_date, i.date)) < 14
  GROUP BY 1, 2, 3)"""


def event_window_means() -> str:
    return f"WITH {onsets_cte()}, {indicators_cte()}, {_event_means_cte()}\nSELECT * FROM ewm"


def _static_cte() -> str:
    cols = ",\n  ".join(f"arg_min({c}, date) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("continent", *STATIC))
    return f"""st AS (SELECT location,
  {cols}
  FROM ind GROUP BY location)"""


def static_indicators() -> str:
    return f"WITH {indicators_cte()}, {_static_cte()}\nSELECT * FROM st"


def location_constant_columns() -> str:
    cols = ["continent", "date", "tests_units", *COUNTERS, *DOUBLES]
    per = ",\n  ".join(f"count(DISTINCT {c}) AS d_{c}" for c in cols)
    rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(max(d_{c}) AS BIGINT) AS max_distinct, max(d_{c}) <= 1 AS is_constant FROM pk"
        for c in cols)
    return f"""WITH {indicators_cte()},
pk AS (SELECT location,
  {per}
  FROM ind GROUP BY location)
{rows}"""


def onset_matrix() -> str:
    brands = [f"Brand#{i}" for i in range(1, 26)]
    types = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    cols = ",\n  ".join(
        f"max(CASE WHEN variant = '{b}|{t}' THEN outbreak_rank_global END) AS \"{b}|{t}\"" for b in brands for t in types)
    return f"""WITH {onsets_cte()}
SELECT continent, location,
  {cols}
FROM ranks GROUP BY continent, location"""


def _corr_rows(source: str, cols: tuple[str, ...], digits: int | None = 6) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            xa, xb = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END", f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
            value = f"covar_pop({xa}, {xb}) / nullif(stddev_pop({xa}) * stddev_pop({xb}), 0)"
            expr = ((f"round({value}, {digits})" if digits else value) + " AS r, "
                    f"CAST(count(*) FILTER (WHERE {both}) AS BIGINT) AS n")
            for x, y in {(a, b), (b, a)}:
                parts.append(f"SELECT '{x}' AS x, '{y}' AS y, {expr} FROM {source}")
    return "\nUNION ALL\n".join(parts)


def _significance(rows: str, columns: str, divisor: float) -> str:
    """Adds p, stars and the display cell to rows with x, y, r (unrounded) and n.

    With whole degrees of freedom the t distribution is a finite sum in powers of
    ``1 - r^2``; its coefficients are ratios of gamma functions.
    """
    m = "(n - 2) // 2"
    c2 = "ln(1 - r * r)"
    even = f"abs(r) * list_sum(list_transform(range(0, {m}), lambda k: exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1) + k * {c2})))"
    odd = (f"2 / pi() * (asin(abs(r)) + abs(r) * sqrt(1 - r * r) * coalesce(list_sum(list_transform(range(0, {m}), "
           f"lambda k: exp(lgamma(k + 1) + lgamma(1.5) - lgamma(k + 1.5) + k * {c2}))), 0))")
    p = (f"CASE WHEN x = y THEN 0.0 WHEN r IS NULL OR n <= 2 THEN NULL WHEN abs(r) >= 1 THEN 0.0 "
         f"WHEN n % 2 = 0 THEN 1 - {even} ELSE 1 - {odd} END")
    stars = " || ".join(f"CASE WHEN p <= {t} / {divisor} THEN '*' ELSE '' END" for t in (0.05, 0.01, 0.001))
    return f"""raw_r AS ({rows}),
with_p AS (SELECT *, {p} AS p FROM raw_r),
starred AS (SELECT *, coalesce({stars}, '') AS stars FROM with_p)
SELECT {columns}x, y, round(r, 6) AS r, n, round(p, 6) + 0.0 AS p, stars, CAST(round(r, 2) + 0.0 AS VARCHAR) || stars AS cell FROM starred"""


RANK_CORR = (*STATIC, "schulze_onset_rank_continent", "earliest_5_in_continent")


def _static_ranks_ctes() -> str:
    return f"""{onsets_cte()}, {indicators_cte()}, {_static_cte()},
{_q1_ctes()},
sr AS (SELECT st.*, q.rnk AS schulze_onset_rank_continent,
  CASE WHEN q.rnk IS NULL THEN NULL WHEN q.rnk <= 5 THEN 1.0 ELSE 0.0 END AS earliest_5_in_continent
  FROM st LEFT JOIN q1_rank q ON q.loc = st.location)"""


def correlation_matrix() -> str:
    return f"WITH RECURSIVE {_static_ranks_ctes()}\n" + _corr_rows("sr", RANK_CORR)


def correlation_per_variant() -> str:
    parts = []
    for c in STATIC:
        both = f"r.outbreak_rank_global IS NOT NULL AND s.{c} IS NOT NULL"
        xa = f"CASE WHEN {both} THEN CAST(r.outbreak_rank_global AS DOUBLE) END"
        xb = f"CASE WHEN {both} THEN CAST(s.{c} AS DOUBLE) END"
        parts.append(f"""SELECT r.variant, 'outbreak_rank_global' AS x, '{c}' AS y,
  round(covar_pop({xa}, {xb}) / nullif(stddev_pop({xa}) * stddev_pop({xb}), 0), 6) AS r,
  CAST(count(*) FILTER (WHERE {both}) AS BIGINT) AS n
FROM ranks r JOIN st s ON s.location = r.location GROUP BY r.variant""")
    return f"WITH {onsets_cte()}, {indicators_cte()}, {_static_cte()}\n" + "\nUNION ALL\n".join(parts)


EVENT_CORR = ("outbreak_rank_global", "new_deaths_smoothed_per_million", "reproduction_rate",
              "positive_rate", "stringency_index", *STATIC)


def correlation_significance() -> str:
    k = len(RANK_CORR)
    return f"WITH RECURSIVE {_static_ranks_ctes()},\n" + _significance(_corr_rows("sr", RANK_CORR, None), "", float(k * k - k))


def event_window_significance() -> str:
    k = len(EVENT_CORR)
    return f"WITH {onsets_cte()}, {indicators_cte()}, {_event_means_cte()},\n" + _significance(
        _corr_rows("ewm", EVENT_CORR, None), "", float(k * k - k))


def variant_significance() -> str:
    rows = correlation_per_variant().split(_static_cte() + "\n", 1)[1].replace("round(covar_pop", "(covar_pop").replace(", 0), 6) AS r", ", 0)) AS r")
    return f"WITH {onsets_cte()}, {indicators_cte()}, {_static_cte()},\n" + _significance(rows, "variant, ", 1.0)


def event_window_correlation() -> str:
    return f"WITH {onsets_cte()}, {indicators_cte()}, {_event_means_cte()}\n" + _corr_rows("ewm", EVENT_CORR)


def serving_dashboard() -> str:
    pred, cur = "analysis_location_variant_predictors", "curated_country_variant_indicators"
    return f"""WITH RECURSIVE {onsets_cte()},
{_q1_ctes()},
{_pred_ctes()},
{lines_cte()}, {indicators_cte()},
li AS (SELECT * EXCLUDE (date), date AS date_indicators FROM ind),
latest AS (SELECT * FROM li WHERE date_indicators = (SELECT max(x.date_indicators) FROM li x WHERE x.location = li.location)),
cur AS (SELECT c.*, l.* EXCLUDE (location) FROM clean c LEFT JOIN latest l ON c.location = l.location),
o AS (SELECT e AS continent, loc AS location, CAST(rnk AS INTEGER) AS schulze_onset_rank_continent,
             CAST(rnk <= 5 AS INTEGER) AS earliest_5_in_continent FROM q1_rank),
p AS (SELECT location AS "location[{pred}]", continent AS "continent[{pred}]", predictor_location, predictor_continent,
             CAST(predictor_rank AS INTEGER) AS predictor_rank, CAST(on_same_continent AS INTEGER) AS on_same_continent,
             CAST(is_in_same_continent_top_5_predictors AS INTEGER) AS is_in_same_continent_top_5_predictors,
             CAST(is_in_off_continent_top_5_predictors AS INTEGER) AS is_in_off_continent_top_5_predictors FROM pred),
c AS (SELECT * EXCLUDE (location, continent), location AS "location[{cur}]", continent AS "continent[{cur}]" FROM cur)
SELECT o.*, p.*, c.* FROM o
LEFT JOIN p ON o.location = p."location[{pred}]" AND o.continent = p."continent[{pred}]"
LEFT JOIN c ON o.location = c."location[{cur}]" AND o.continent = c."continent[{cur}]"
"""


def country_code_lookup() -> str:
    fixes = {
        "Bonaire Sint Eustatius and Saba": "Bonaire, Sint Eustatius and Saba",
        "Cape Verde": "Cabo Verde",
        "Democratic Republic of Congo": "Congo, The Democratic Republic of",
        "Faeroe Islands": "Faroe Islands",
        "Iran": "Iran, Islamic Republic of",
        "Laos": "Lao People's Democratic Republic",
        "Micronesia (country)": "Micronesia, Federated States of",
        "United States Virgin Islands": "Virgin Islands, U.S.",
    }
    case = " ".join("WHEN '{}' THEN '{}'".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in fixes.items())
    grams = "unnest(list_transform(range(1, greatest(length({s}) - 2, 1) + 1), lambda i: substr(lower({s}), i, 3)))"
    return f"""WITH {indicators_cte()},
locs AS (SELECT DISTINCT location FROM ind WHERE location IS NOT NULL),
l2 AS (SELECT location, CASE location {case} ELSE location END AS lookup FROM locs),
ref AS (SELECT n_name AS name, replace(n_name, '_', ' ') AS common_name,
               'N' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code FROM nation),
ex AS (SELECT l2.*, r.code AS exact_code FROM l2 LEFT JOIN ref r ON r.name = l2.lookup),
cm AS (SELECT ex.*, r.code AS common_code FROM ex LEFT JOIN ref r ON r.common_name = ex.lookup),
todo AS (SELECT location, lookup FROM cm WHERE exact_code IS NULL AND common_code IS NULL),
lg AS (SELECT DISTINCT location, lookup, {grams.format(s='lookup')} AS g FROM todo),
rg AS (SELECT DISTINCT name AS cand, code AS cand_code, {grams.format(s='name')} AS g FROM ref),
pairs AS (SELECT DISTINCT location, lookup, cand, cand_code FROM lg JOIN rg ON lg.g = rg.g),
sc AS (SELECT *, 1.0 - levenshtein(lower(lookup), lower(cand)) / greatest(length(lookup), length(cand)) AS sim FROM pairs),
best AS (SELECT location, cand_code AS fuzzy_code FROM (
  SELECT *, row_number() OVER (PARTITION BY location ORDER BY sim DESC, cand) AS rn FROM sc WHERE sim >= 0.6) WHERE rn = 1)
SELECT cm.location, coalesce(exact_code, common_code, fuzzy_code) AS code,
  CASE WHEN exact_code IS NOT NULL THEN 'exact' WHEN common_code IS NOT NULL THEN 'common'
       WHEN fuzzy_code IS NOT NULL THEN 'fuzzy' END AS match_kind
FROM cm LEFT JOIN best ON cm.location = best.location"""


def land_and_read_partition() -> str:
    return clean_variants_csv()


def predictor_locations_supplier() -> str:
    return f"""WITH RECURSIVE {onsets_cte('supplier')},
{_q1_ctes()},
{_pred_ctes()}
SELECT * FROM pred"""


def land_two_dates() -> str:
    return f"""WITH {lines_cte()}
SELECT '20240101' AS ingest_date, count(*) AS n_lines FROM lines WHERE length(value) % 2 = 0
UNION ALL
SELECT '20240102' AS ingest_date, count(*) AS n_lines FROM lines WHERE length(value) % 2 = 1"""


def dq_indicator_ranges() -> str:
    from onsetlake.operators.quality import INDICATOR_RANGES

    have = (*COUNTERS, *DOUBLES)
    lacking = [c for c in INDICATOR_RANGES if c not in have]
    wide = ", ".join(f"stringency_index * {i % 7 + 1} - 20 AS {c}" for i, c in enumerate(lacking))
    checks = [
        ("Schema", "continent ~ ^[A-Za-z, ]+$", "NOT regexp_matches(continent, '^[A-Za-z, ]+$')"),
        ("Schema", "location ~ ^[A-Za-z,\\-\\(\\) ']+$",
         "NOT regexp_matches(location, '^[A-Za-z,\\-\\(\\) '']+$') OR location IS NULL"),
    ]
    for c, (lo, hi, lo_strict, hi_strict) in INDICATOR_RANGES.items():
        left, right = ("<" if lo_strict else "<="), ("<" if hi_strict else "<=")
        bad = [f"{c} {'<=' if lo_strict else '<'} {lo}"] + [f"{c} {'>=' if hi_strict else '>'} {hi}"] * (hi is not None)
        checks.append(("Schema", f"{lo} {left} {c}" + (f" {right} {hi}" if hi is not None else ""), " OR ".join(bad)))
    return f"WITH {indicators_cte()},\nwide AS (SELECT *, {wide} FROM ind)\n" + _check_rows("wide", checks)


def dq_failing_rows() -> str:
    checks = (("complete(continent)", "continent IS NULL"),
              ("0 <= stringency_index <= 60", "stringency_index < 0 OR stringency_index > 60"),
              ("0 <= reproduction_rate <= 1.6", "reproduction_rate < 0 OR reproduction_rate > 1.6"))
    return f"WITH {indicators_cte()}\n" + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"constraint\", location, date, stringency_index, reproduction_rate FROM ind WHERE {bad}"
        for name, bad in checks)


def _rankings_cte() -> str:
    return f"""{_global_ctes('day', 'rd')},
{_global_ctes('month', 'rm')},
{_global_ctes('presence', 'rp')},
grk AS (
  SELECT nullif(split_part(coalesce(d.loc, m.loc, p.loc), {SEP}, 1), '') AS continent,
         split_part(coalesce(d.loc, m.loc, p.loc), {SEP}, 2) AS location,
         d.rnk AS rank_day, m.rnk AS rank_month, p.rnk AS rank_presence
  FROM rd_rank d FULL JOIN rm_rank m ON d.loc = m.loc FULL JOIN rp_rank p ON coalesce(d.loc, m.loc) = p.loc)"""


def ranking_agreement() -> str:
    return f"WITH RECURSIVE {onsets_cte()},\n{_rankings_cte()}\n" + _corr_rows(
        "grk", ("rank_day", "rank_month", "rank_presence"))


def ranking_significance() -> str:
    return f"WITH RECURSIVE {onsets_cte()},\n{_rankings_cte()},\n" + _significance(
        _corr_rows("grk", ("rank_day", "rank_month", "rank_presence"), None), "", 1.0)


def event_window_rank_correlation() -> str:
    return f"""WITH RECURSIVE {onsets_cte()}, {indicators_cte()}, {_event_means_cte()},
{_global_ctes('month', 'em')},
emr AS (SELECT nullif(split_part(loc, {SEP}, 1), '') AS continent, split_part(loc, {SEP}, 2) AS location,
               rnk AS monthly_early_hit_ranking FROM em_rank),
ewr AS (SELECT w.*, r.monthly_early_hit_ranking FROM ewm w
        LEFT JOIN emr r ON r.continent = w.continent AND r.location = w.location)
""" + _corr_rows("ewr", (*EVENT_CORR, "monthly_early_hit_ranking"))


def dq_perc_tolerance() -> str:
    checks = [
        ("Schema", "0 <= perc_source <= 100", "perc_source < 0 OR perc_source > 100 OR perc_source IS NULL"),
        ("Review Check", "abs(perc_source - expected) < 0.01", "abs(perc_source - perc_sequences) >= 0.01"),
    ]
    return f"""WITH {lines_cte()},
pt AS (SELECT TRY_CAST(fields[5] AS DOUBLE) AS perc_source,
              100.0 * TRY_CAST(fields[4] AS DOUBLE) / nullif(TRY_CAST(fields[6] AS DOUBLE), 0) AS perc_sequences
       FROM fl)
""" + _check_rows("pt", checks)


def predictor_locations_strict() -> str:
    return f"""WITH RECURSIVE {onsets_cte()},
{_q1_ctes()},
{_pred_ctes(strict=True)}
SELECT * FROM pred"""


def wide_correlation() -> str:
    from onsetlake.operators.quality import INDICATOR_RANGES

    have = (*COUNTERS, *DOUBLES)
    lacking = [c for c in INDICATOR_RANGES if c not in have]
    wide = ", ".join(f"stringency_index * {i % 7 + 1} - 20 AS {c}" for i, c in enumerate(lacking))
    cols = list(INDICATOR_RANGES)
    aggs, rows = [], []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            b = cols[j]
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            x, y = (f"CASE WHEN {both} THEN CAST({c} AS DOUBLE) END" for c in (a, b))
            aggs += [f"round(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 6) AS r{i}_{j}",
                     f"count(*) FILTER ({both}) AS n{i}_{j}"]
            rows += [f"{{'x': '{p}', 'y': '{q}', 'r': r{i}_{j}, 'n': n{i}_{j}}}" for p, q in sorted({(a, b), (b, a)})]
    return f"WITH {indicators_cte()},\nwide AS (SELECT *, {wide} FROM ind),\nm AS (SELECT {', '.join(aggs)} FROM wide),\n" \
           f"u AS (SELECT unnest([{', '.join(rows)}]) AS e FROM m)\nSELECT e.x AS x, e.y AS y, e.r AS r, CAST(e.n AS BIGINT) AS n FROM u"


def landed_lines_by_file() -> str:
    names = ("continent", "location", "date", "tests_units", "total_tests", "new_tests", "hosp_patients", "population", "reproduction_rate",
             "positive_rate", "stringency_index", "new_deaths_smoothed_per_million", "hosp_patients_per_million", "population_density",
             "median_age", "gdp_per_capita")
    line = " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in names)
    return f"""WITH {lines_cte()}, {indicators_cte()},
f AS (SELECT 'data1_country_variants' AS dataset, 'Data1_' || regexp_extract(value, '[0-9]{{2}}\\.[0-9]{{2}}\\.([0-9]{{4}})', 1) || '.csv' AS file_name, value FROM lines
  UNION ALL SELECT 'data2_country_indicators', 'Data2_' || substr(CAST(date AS VARCHAR), 1, 4) || '.xlsx', {line} FROM raw_ind)
SELECT dataset, file_name, count(*) AS n_lines, CAST(sum(length(value)) AS BIGINT) AS n_chars, true AS has_bytes FROM f GROUP BY ALL"""


def typed_read_rejects() -> str:
    return f"""WITH {lines_cte()},
l AS (SELECT value, regexp_extract(value, '([0-9]{{2}})\\.[0-9]{{2}}\\.[0-9]{{4}}', 1) AS day FROM lines)
SELECT 'typed' AS kind, count(*) AS n_rows, CAST(sum(CAST(split_part(value, ',', 4) AS BIGINT)) AS BIGINT) AS num_sequences,
  count(*) AS n_dates, CAST(NULL AS BIGINT) AS n_chars FROM l WHERE day NOT IN ('13', '31')
UNION ALL SELECT 'rejected', count(*), NULL, NULL, CAST(sum(length(value)) AS BIGINT) FROM l WHERE day IN ('13', '31')"""


def indicator_running_sum() -> str:
    def total(c: str) -> str:
        return f"CASE WHEN {c} IS NOT NULL THEN sum({c}) OVER (PARTITION BY location ORDER BY date ROWS UNBOUNDED PRECEDING) END"

    return f"""WITH {indicators_cte()}
SELECT location, date, new_deaths_smoothed_per_million, total_tests,
  round({total('new_deaths_smoothed_per_million')}, 4) AS new_deaths_smoothed_per_million_cumulative,
  CAST({total('total_tests')} AS BIGINT) AS total_tests_cumulative FROM ind"""


def country_code_similar() -> str:
    return """WITH ref AS (SELECT n_name AS name, replace(n_name, '_', ' ') AS common, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code FROM nation),
l AS (SELECT DISTINCT unnest([name, common, 'X' || substr(name, 2), lower(name), reverse(name), substr(name, 1, 4)]) AS location FROM ref),
p AS (SELECT l.location, name, code, 1 - levenshtein(lower(l.location), lower(name)) / greatest(length(l.location), length(name)) AS sim FROM l, ref),
b AS (SELECT * FROM p WHERE sim >= 0.6 QUALIFY row_number() OVER (PARTITION BY location ORDER BY sim DESC, name) = 1)
SELECT l.location, coalesce(e.code, c.code, b.code) AS code,
  CASE WHEN e.code IS NOT NULL THEN 'exact' WHEN c.code IS NOT NULL THEN 'common' WHEN b.code IS NOT NULL THEN 'fuzzy' END AS match_kind
FROM l LEFT JOIN ref e ON e.name = l.location LEFT JOIN ref c ON c.common = l.location LEFT JOIN b ON b.location = l.location"""


def static_table() -> str:
    return f"WITH {indicators_cte()}\nSELECT location, any_value(continent) AS continent, any_value(tests_units) AS tests_units, " \
           + ", ".join(f"any_value({c}) AS {c}" for c in STATIC) + " FROM ind GROUP BY location"


def dq_pattern_failing_rows() -> str:
    checks = (("location", LOCATION_PATTERN, False), ("date_text", DATE_PATTERN, False), ("variant", VARIANT_PATTERN, True))

    def quoted(x: str) -> str:
        return x.replace("'", "''")

    return f"WITH {lines_cte()},\nf AS (SELECT fields[1] AS location, fields[2] AS date_text, fields[3] AS variant FROM fl)\n" + "\nUNION ALL\n".join(
        f"SELECT '{quoted(c + ' ~ ' + p)}' AS \"constraint\", location, date_text, variant FROM f "
        f"WHERE NOT regexp_matches({c}, '{quoted(p)}')" + (f" OR {c} IS NULL" if nulls else "") for c, p, nulls in checks)


def pipeline_predictors() -> str:
    return f"""WITH RECURSIVE {lines_cte()}, {indicators_cte()},
place AS (SELECT DISTINCT location, continent FROM ind),
onsets AS (SELECT p.continent, c.location, c.variant, min(c.date) AS outbreak_date
  FROM clean c LEFT JOIN place p ON p.location = c.location WHERE c.num_sequences > 0 GROUP BY 1, 2, 3),
ranks AS (SELECT *, rank() OVER (PARTITION BY variant ORDER BY outbreak_date) AS outbreak_rank_global FROM onsets),
{_q1_ctes()},
{_pred_ctes()}
SELECT * FROM pred"""


def pipeline_checks() -> str:
    types = (("location", "string"), ("date", "date"), ("variant", "string"), ("num_sequences", "bigint"),
             ("perc_sequences", "double"), ("num_sequences_total", "bigint"))
    rc = "Review Check"
    values = [(rc, "num_sequences_total >= num_sequences", "num_sequences_total < num_sequences"),
              (rc, "num_sequences_total >= 0", "num_sequences_total < 0"), (rc, "num_sequences >= 0", "num_sequences < 0"),
              (rc, "perc_sequences >= 0", "perc_sequences < 0"),
              (rc, "complete(num_sequences_total, num_sequences, perc_sequences)",
               "num_sequences_total IS NULL OR num_sequences IS NULL OR perc_sequences IS NULL")]
    typed = "\nUNION ALL\n".join(f"SELECT 'Schema', 'Error', 'type({c}) = {t}', 'Success', CAST(0 AS BIGINT), CAST(0 AS DOUBLE)" for c, t in types)
    return f"WITH {lines_cte()}\n" + "\nUNION ALL\n".join(
        [_check_rows("fl", [(rc, "6 fields", "len(fields) <> 6")]), _check_rows("clean", values), typed])

"""Independent SQL statements of every registered query, for DuckDB.

Each statement starts from the same raw-table mapping the Spark side uses and
re-states the cleaning, aggregation, OEE, dimension, view, quality and load
rules in plain SQL.  Dialect pairs used (Spark ↔ DuckDB):

* ``try_to_date(c,'yyyy-MM-dd')`` ↔ strict pattern check + ``try_cast(c AS date)``
* ``try_divide(a,b)`` ↔ ``a / nullif(b,0)``
* ``date_format(d,'MMMM'/'EEEE')`` ↔ ``monthname`` / ``dayname``
* ``dayofweek`` (1 = Sunday) ↔ ``dayofweek + 1``
* ``grouping_id(a,b,c)`` ↔ ``grouping(a,b,c)``
* decimal round trips (``round2``, exact sums and averages) written identically.
"""

from __future__ import annotations

# ── shared expression snippets ───────────────────────────────────────────────


def round2(x: str) -> str:
    return f"cast(round(try_cast({x} AS decimal(38,10)), 2) AS double)"


def sum_exact(x: str) -> str:
    return f"cast(sum(try_cast({x} AS decimal(28,10))) AS double)"


def avg_exact(x: str) -> str:
    """Mean of a DECIMAL(p,2) column, half-up to 6 places, in integer arithmetic.

    mean × 10^6 = S / N with S = sum in hundredths × 10^4; half-up of a
    non-negative S / N is (2S + N) // (2N).  (avg() and decimal division both
    return DOUBLE here, which misplaces exact ties.)
    """
    s = f"cast(sum({x}) * 100 AS hugeint)"
    n = f"count({x})"
    q = f"sign({s}) * ((2 * abs({s}) * 10000 + {n}) // (2 * {n}))"
    return f"CASE WHEN {n} = 0 THEN NULL ELSE cast({q} AS double) / 1000000.0 END"


def parse_date(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast({c} AS date) END"


def nan_null(c: str) -> str:
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"


def clamp0(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN 0 ELSE {c} END"


# ── raw tables (mapping of the shared test tables) ───────────────────────────

RAW_PRODUCTION = """
SELECT
  concat('P', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS production_id,
  concat('PLT', cast(l_suppkey // 40 AS string)) AS plant_id,
  concat('L', cast(l_suppkey // 8 AS string)) AS line_id,
  concat('M', cast(l_suppkey AS string)) AS machine_id,
  concat('S', cast(l_linenumber % 4 AS string)) AS shift_id,
  concat('PRD', cast(l_partkey AS string)) AS product_id,
  CASE WHEN l_orderkey % 97 = 0 THEN 'bad-date'
       ELSE cast(cast(l_shipdate AS date) AS string) END AS production_date,
  CASE WHEN l_partkey % 53 = 0 THEN 0 ELSE cast(l_quantity AS int) * 10 END AS planned_qty,
  CASE WHEN l_partkey % 59 = 0 THEN -5
       ELSE cast(l_quantity AS int) * 10 + 3 - cast(round(l_discount * 100) AS int) END AS actual_qty,
  CASE WHEN l_partkey % 61 = 0 THEN NULL
       ELSE cast(l_quantity AS int) * 10 + 1 - cast(round(l_discount * 100) AS int) - cast(round(l_tax * 100) AS int) END AS good_qty,
  CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE cast(480 AS double) END AS planned_runtime_min,
  cast(480 - l_linenumber AS double) AS actual_runtime_min
FROM lineitem
"""

RAW_DOWNTIME = """
SELECT
  concat('D', cast(event_id AS string)) AS downtime_id,
  concat('M', cast(user_id AS string)) AS machine_id,
  cast(cast(ts AS date) - cast(event_id % 2500 + 8100 AS int) AS string) AS production_date,
  CASE WHEN extract(hour FROM ts) >= 6 AND extract(hour FROM ts) < 14 THEN 'S1'
       WHEN extract(hour FROM ts) >= 14 AND extract(hour FROM ts) < 22 THEN 'S2'
       ELSE 'S3' END AS shift_id,
  event_type AS downtime_reason,
  value - 2 AS downtime_minutes,
  CASE event_type WHEN 'view' THEN 'Y' WHEN 'click' THEN 'y' WHEN 'error' THEN 'N' ELSE NULL END AS is_planned
FROM events
"""

RAW_QUALITY = """
SELECT
  concat('Q', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS inspection_id,
  concat('M', cast(l_suppkey AS string)) AS machine_id,
  concat('PRD', cast(l_partkey AS string)) AS product_id,
  CASE WHEN l_orderkey % 97 = 0 THEN 'bad-date'
       ELSE cast(cast(l_shipdate AS date) AS string) END AS production_date,
  concat('S', cast(l_linenumber % 4 AS string)) AS shift_id,
  CASE WHEN l_partkey % 71 = 0 THEN 0 ELSE cast(l_quantity AS int) END AS inspected_qty,
  CASE WHEN l_partkey % 73 = 0 THEN NULL ELSE cast(round(l_tax * 100) AS int) * 3 END AS defect_qty,
  l_linestatus AS defect_category
FROM lineitem
"""

PRODUCTION_COLS = [
    "production_id", "plant_id", "line_id", "machine_id", "shift_id", "product_id", "production_date",
    "planned_qty", "actual_qty", "good_qty", "planned_runtime_min", "actual_runtime_min",
]
DOWNTIME_COLS = [
    "downtime_id", "machine_id", "production_date", "shift_id", "downtime_reason", "downtime_minutes", "is_planned",
]
QUALITY_COLS = [
    "inspection_id", "machine_id", "product_id", "production_date", "shift_id",
    "inspected_qty", "defect_qty", "defect_category",
]


def _dedup(source: str, key: str, cols: list[str], doubles: set[str], key_filter: str) -> str:
    proj = ", ".join(f"{nan_null(c)} AS {c}" if c in doubles else c for c in cols)
    order = ", ".join(f"{c} ASC NULLS LAST" for c in cols if c != key)
    return f"""
SELECT {', '.join(cols)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn__
  FROM (SELECT {proj} FROM ({source}) src WHERE {key_filter}) f
) r WHERE rn__ = 1
"""


DEDUP_PRODUCTION = _dedup(
    RAW_PRODUCTION, "production_id", PRODUCTION_COLS, {"planned_runtime_min", "actual_runtime_min"},
    "machine_id IS NOT NULL AND production_date IS NOT NULL",
)
DEDUP_DOWNTIME = _dedup(RAW_DOWNTIME, "downtime_id", DOWNTIME_COLS, {"downtime_minutes"}, "machine_id IS NOT NULL")
DEDUP_QUALITY = _dedup(RAW_QUALITY, "inspection_id", QUALITY_COLS, set(), "machine_id IS NOT NULL")

CLEAN_PRODUCTION = f"""
SELECT production_id, plant_id, line_id, machine_id, shift_id, product_id,
  {parse_date('production_date')} AS production_date,
  {clamp0('planned_qty')} AS planned_qty,
  {clamp0('actual_qty')} AS actual_qty,
  {clamp0('good_qty')} AS good_qty,
  planned_runtime_min, actual_runtime_min
FROM ({DEDUP_PRODUCTION}) d
"""

CLEAN_DOWNTIME = f"""
SELECT downtime_id, machine_id, {parse_date('production_date')} AS production_date, shift_id, downtime_reason,
  cast({clamp0('downtime_minutes')} AS double) AS downtime_minutes, is_planned,
  coalesce(upper(is_planned) = 'Y', false) AS is_planned_flag
FROM ({DEDUP_DOWNTIME}) d
"""

CLEAN_QUALITY = f"""
SELECT inspection_id, machine_id, product_id, {parse_date('production_date')} AS production_date, shift_id,
  inspected_qty, least(defect_qty, inspected_qty) AS defect_qty, defect_category
FROM ({DEDUP_QUALITY}) d
"""

AGG_DOWNTIME = f"""
SELECT machine_id, production_date, shift_id,
  {sum_exact('downtime_minutes')} AS total_downtime_min,
  {sum_exact('CASE WHEN is_planned_flag THEN downtime_minutes ELSE 0.0 END')} AS planned_downtime_min,
  {sum_exact('CASE WHEN NOT is_planned_flag THEN downtime_minutes ELSE 0.0 END')} AS unplanned_downtime_min,
  count(downtime_id) AS downtime_events
FROM ({CLEAN_DOWNTIME}) c
GROUP BY machine_id, production_date, shift_id
"""

AGG_QUALITY = f"""
SELECT machine_id, product_id, production_date, shift_id, total_inspected_qty, total_defect_qty,
  {round2('(total_inspected_qty - total_defect_qty) / nullif(total_inspected_qty, 0) * 100')} AS first_pass_yield
FROM (
  SELECT machine_id, product_id, production_date, shift_id,
    cast(sum(inspected_qty) AS bigint) AS total_inspected_qty,
    cast(sum(defect_qty) AS bigint) AS total_defect_qty
  FROM ({CLEAN_QUALITY}) c
  GROUP BY machine_id, product_id, production_date, shift_id
) g
"""

FACT_JOIN = f"""
SELECT p.*,
  coalesce(d.total_downtime_min, 0.0) AS total_downtime_min,
  coalesce(d.planned_downtime_min, 0.0) AS planned_downtime_min,
  coalesce(d.unplanned_downtime_min, 0.0) AS unplanned_downtime_min,
  d.downtime_events,
  coalesce(q.total_inspected_qty, 0) AS total_inspected_qty,
  coalesce(q.total_defect_qty, 0) AS total_defect_qty,
  q.first_pass_yield
FROM ({CLEAN_PRODUCTION}) p
LEFT JOIN ({AGG_DOWNTIME}) d
  ON p.machine_id = d.machine_id AND p.production_date = d.production_date AND p.shift_id = d.shift_id
LEFT JOIN ({AGG_QUALITY}) q
  ON p.machine_id = q.machine_id AND p.product_id = q.product_id
 AND p.production_date = q.production_date AND p.shift_id = q.shift_id
"""


def _ratio(guard: str, num: str, den: str) -> str:
    return f"CASE WHEN {guard} > 0 THEN cast({num} AS double) / nullif(cast({den} AS double), 0) ELSE 0.0 END"


def _pct(r: str) -> str:
    return round2(f"least(greatest({r}, 0.0), 1.0) * 100")


FACT_PRODUCTION = f"""
SELECT production_id, plant_id, line_id, machine_id, shift_id, product_id, production_date,
  cast(year(production_date) AS int) AS year, cast(month(production_date) AS int) AS month,
  planned_qty, actual_qty, good_qty, planned_runtime_min, actual_runtime_min,
  total_downtime_min, planned_downtime_min, unplanned_downtime_min, downtime_events,
  total_inspected_qty, total_defect_qty, first_pass_yield,
  {_pct('a')} AS availability, {_pct('p')} AS performance, {_pct('q')} AS quality_rate,
  least(greatest({round2('a * p * q * 100')}, 0.0), 100.0) AS oee_pct
FROM (
  SELECT *,
    {_ratio('planned_runtime_min', 'planned_runtime_min - unplanned_downtime_min', 'planned_runtime_min')} AS a,
    {_ratio('planned_qty', 'actual_qty', 'planned_qty')} AS p,
    {_ratio('actual_qty', 'good_qty', 'actual_qty')} AS q
  FROM ({FACT_JOIN}) j
) r
"""

OEE = f"""
SELECT production_id, availability, performance, quality_rate, oee_pct FROM ({FACT_PRODUCTION}) f
"""


# ── lake dimensions ──────────────────────────────────────────────────────────

DIM_MACHINE = f"""
SELECT machine_id, line_id, plant_id,
  'Machine-' || machine_id AS machine_name, 'Line-' || line_id AS line_name,
  'Plant 001' AS plant_name, 'CNC' AS machine_type, true AS is_active
FROM (
  SELECT machine_id, line_id, plant_id,
    row_number() OVER (PARTITION BY machine_id ORDER BY line_id ASC NULLS LAST, plant_id ASC NULLS LAST) AS rn__
  FROM ({CLEAN_PRODUCTION}) c
) r WHERE rn__ = 1
"""

DIM_SHIFT = f"""
SELECT shift_id,
  CASE WHEN shift_id = 'S1' THEN 'Morning (06:00–14:00)'
       WHEN shift_id = 'S2' THEN 'Afternoon (14:00–22:00)'
       WHEN shift_id = 'S3' THEN 'Night (22:00–06:00)'
       ELSE 'Unknown' END AS shift_name,
  CASE WHEN shift_id = 'S1' THEN '06:00' WHEN shift_id = 'S2' THEN '14:00' ELSE '22:00' END AS shift_start,
  8 AS shift_hours
FROM (SELECT DISTINCT shift_id FROM ({CLEAN_PRODUCTION}) c) d
"""

DIM_PRODUCT = f"""
SELECT product_id, 'Product-' || product_id AS product_name, 'General' AS product_family, 'PCS' AS unit_of_measure
FROM (SELECT DISTINCT product_id FROM ({CLEAN_PRODUCTION}) c) d
"""

DIM_DATE = f"""
SELECT date_key,
  cast(year(date_key) AS int) AS year, cast(quarter(date_key) AS int) AS quarter,
  cast(month(date_key) AS int) AS month, monthname(date_key) AS month_name,
  cast(weekofyear(date_key) AS int) AS week, cast(dayofweek(date_key) + 1 AS int) AS day_of_week,
  dayname(date_key) AS day_name, coalesce(dayofweek(date_key) IN (0, 6), false) AS is_weekend
FROM (SELECT DISTINCT production_date AS date_key FROM ({CLEAN_PRODUCTION}) c) d
"""

# ── warehouse (fresh load) ───────────────────────────────────────────────────

WH_DIM_MACHINE = f"""
SELECT cast(row_number() OVER (ORDER BY machine_id) AS int) AS machine_key, machine_id, machine_name, machine_type,
  is_active, line_id, line_name, plant_id, plant_name, cast(NULL AS varchar) AS plant_location
FROM ({DIM_MACHINE}) m
"""

WH_DIM_SHIFT = """
SELECT cast(shift_key AS int) AS shift_key, shift_id, shift_name, shift_start, cast(shift_hours AS smallint) AS shift_hours
FROM (VALUES
  (1, 'S1', 'Morning (06:00–14:00)', '06:00', 8),
  (2, 'S2', 'Afternoon (14:00–22:00)', '14:00', 8),
  (3, 'S3', 'Night (22:00–06:00)', '22:00', 8)
) AS t(shift_key, shift_id, shift_name, shift_start, shift_hours)
"""

WH_DIM_PRODUCT = f"""
SELECT cast(row_number() OVER (ORDER BY product_id) AS int) AS product_key, product_id, product_name,
  product_family, unit_of_measure
FROM ({DIM_PRODUCT}) p WHERE product_id IS NOT NULL
"""

WH_DIM_DATE = f"""
SELECT date_key, cast(year AS smallint) AS year, cast(quarter AS smallint) AS quarter,
  cast(month AS smallint) AS month, month_name, cast(week AS smallint) AS week,
  cast(day_of_week AS smallint) AS day_of_week, day_name, is_weekend
FROM ({DIM_DATE}) d WHERE date_key IS NOT NULL
"""

_MINUTES = ["planned_runtime_min", "actual_runtime_min", "total_downtime_min", "planned_downtime_min",
            "unplanned_downtime_min"]
_PERCENT = ["first_pass_yield", "availability", "performance", "quality_rate", "oee_pct"]
_INTS = ["planned_qty", "actual_qty", "good_qty", "total_inspected_qty", "total_defect_qty"]


def _conformed(c: str) -> str:
    if c in _MINUTES:
        return f"try_cast({round2(c)} AS decimal(10,2))"
    if c in _PERCENT:
        return f"try_cast({round2(c)} AS decimal(6,2))"
    if c == "downtime_events":
        return f"try_cast({c} AS smallint)"
    return f"try_cast({c} AS int)"


_MEASURES = _INTS[:3] + _MINUTES + ["downtime_events"] + _INTS[3:] + _PERCENT
_OVERFLOW = " OR ".join(f"({c} IS NOT NULL AND {_conformed(c)} IS NULL)" for c in _MEASURES)

RESOLVED_FACT = f"""
SELECT production_id, machine_id, shift_id, product_id, production_date, date_key,
  machine_key, shift_key, product_key,
  {', '.join(f'{_conformed(c)} AS {c}' for c in _MEASURES)},
  CASE WHEN production_id IS NULL THEN 'null production_id'
       WHEN date_key IS NULL THEN 'null or invalid production_date'
       WHEN machine_key IS NULL THEN 'unknown machine_id'
       WHEN shift_key IS NULL THEN 'unknown shift_id'
       WHEN product_key IS NULL THEN 'unknown product_id'
       WHEN {_OVERFLOW} THEN 'measure out of warehouse range' END AS reject_reason
FROM (
  SELECT f.*, f.production_date AS date_key, m.machine_key, s.shift_key, p.product_key
  FROM ({FACT_PRODUCTION}) f
  LEFT JOIN ({WH_DIM_MACHINE}) m ON f.machine_id = m.machine_id
  LEFT JOIN ({WH_DIM_SHIFT}) s ON f.shift_id = s.shift_id
  LEFT JOIN ({WH_DIM_PRODUCT}) p ON f.product_id = p.product_id
) j
"""

LOAD_FACT_FK_LOOKUP = f"""
SELECT production_id, date_key, machine_key, shift_key, product_key FROM ({RESOLVED_FACT}) r
WHERE reject_reason IS NULL
"""

LOAD_FACT_REJECTS = f"""
SELECT production_id, machine_id, shift_id, product_id, production_date, reject_reason FROM ({RESOLVED_FACT}) r
WHERE reject_reason IS NOT NULL
"""

LOAD_FACT_CONFORM = f"""
SELECT production_id, {', '.join(_MINUTES)}, downtime_events, {', '.join(_PERCENT)} FROM ({RESOLVED_FACT}) r
WHERE reject_reason IS NULL
"""

WH_FACT = f"""
SELECT cast(row_number() OVER (ORDER BY production_id) AS bigint) AS production_sk, production_id, date_key,
  machine_key, shift_key, product_key, planned_qty, actual_qty, good_qty,
  {', '.join(_MINUTES)}, downtime_events, total_inspected_qty, total_defect_qty, {', '.join(_PERCENT)}
FROM ({RESOLVED_FACT}) r WHERE reject_reason IS NULL
"""

LOAD_SURROGATE_KEYS = f"SELECT production_sk, production_id FROM ({WH_FACT}) f"

LOAD_VERIFICATION = f"""
SELECT table_name, row_count FROM (
  SELECT 'fact_production' AS table_name, count(*) AS row_count FROM ({WH_FACT}) a
  UNION ALL SELECT 'dim_machine', count(*) FROM ({WH_DIM_MACHINE}) b
  UNION ALL SELECT 'dim_date', count(*) FROM ({WH_DIM_DATE}) c
  UNION ALL SELECT 'dim_shift', count(*) FROM ({WH_DIM_SHIFT}) d
  UNION ALL SELECT 'dim_product', count(*) FROM ({WH_DIM_PRODUCT}) e
) u ORDER BY table_name
"""


def _dsum(c: str) -> str:
    return f"cast(sum({c}) AS double)"


def _isum(c: str) -> str:
    return f"cast(sum({c}) AS bigint)"


VW_DAILY_OEE = f"""
SELECT f.date_key, d.year, d.month, d.month_name, d.week, d.day_name, d.is_weekend,
  m.plant_name, m.line_name, m.machine_id, m.machine_name, m.machine_type, s.shift_name,
  {avg_exact('f.availability')} AS avg_availability_pct,
  {avg_exact('f.performance')} AS avg_performance_pct,
  {avg_exact('f.quality_rate')} AS avg_quality_rate_pct,
  {avg_exact('f.oee_pct')} AS avg_oee_pct,
  {_dsum('f.planned_runtime_min')} AS total_planned_runtime_min,
  {_dsum('f.actual_runtime_min')} AS total_actual_runtime_min,
  {_dsum('f.total_downtime_min')} AS total_downtime_min,
  {_dsum('f.unplanned_downtime_min')} AS total_unplanned_downtime_min,
  {_dsum('f.planned_downtime_min')} AS total_planned_downtime_min,
  {_isum('f.downtime_events')} AS total_downtime_events,
  {_isum('f.planned_qty')} AS total_planned_qty,
  {_isum('f.actual_qty')} AS total_actual_qty,
  {_isum('f.good_qty')} AS total_good_qty,
  {_isum('f.total_inspected_qty')} AS total_inspected_qty,
  {_isum('f.total_defect_qty')} AS total_defects,
  {avg_exact('f.first_pass_yield')} AS avg_first_pass_yield_pct
FROM ({WH_FACT}) f
JOIN ({WH_DIM_DATE}) d ON f.date_key = d.date_key
JOIN ({WH_DIM_MACHINE}) m ON f.machine_key = m.machine_key
JOIN ({WH_DIM_SHIFT}) s ON f.shift_key = s.shift_key
GROUP BY f.date_key, d.year, d.month, d.month_name, d.week, d.day_name, d.is_weekend,
  m.plant_name, m.line_name, m.machine_id, m.machine_name, m.machine_type, s.shift_name
"""

VW_MONTHLY_SUMMARY = f"""
SELECT *, {round2('cast(total_actual_qty AS double) * 100.0 / nullif(cast(total_planned_qty AS double), 0)')} AS attainment_pct
FROM (
  SELECT d.year, d.month, d.month_name, m.line_name, m.machine_name, p.product_name, p.product_family,
    {_isum('f.planned_qty')} AS total_planned_qty,
    {_isum('f.actual_qty')} AS total_actual_qty,
    {_isum('f.good_qty')} AS total_good_qty,
    {_isum('f.total_defect_qty')} AS total_defects,
    {avg_exact('f.first_pass_yield')} AS avg_first_pass_yield_pct,
    {avg_exact('f.oee_pct')} AS avg_oee_pct,
    {_dsum('f.unplanned_downtime_min')} AS total_unplanned_downtime_min
  FROM ({WH_FACT}) f
  JOIN ({WH_DIM_DATE}) d ON f.date_key = d.date_key
  JOIN ({WH_DIM_MACHINE}) m ON f.machine_key = m.machine_key
  JOIN ({WH_DIM_PRODUCT}) p ON f.product_key = p.product_key
  GROUP BY d.year, d.month, d.month_name, m.line_name, m.machine_name, p.product_name, p.product_family
) g
"""

VW_DOWNTIME_PARETO = f"""
WITH pm AS (
  SELECT m.machine_name, m.line_name, sum(f.unplanned_downtime_min) AS minutes,
    {_isum('f.downtime_events')} AS total_events
  FROM ({WH_FACT}) f JOIN ({WH_DIM_MACHINE}) m ON f.machine_key = m.machine_key
  GROUP BY m.machine_name, m.line_name
), c AS (
  SELECT *,
    sum(minutes) OVER (ORDER BY minutes DESC, machine_name ASC NULLS LAST, line_name ASC NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
    sum(minutes) OVER () AS total
  FROM pm
)
SELECT machine_name, line_name, cast(minutes AS double) AS total_unplanned_min, total_events,
  {round2('cast(minutes AS double) * 100.0 / nullif(cast(total AS double), 0.0)')} AS pct_of_total,
  {round2('cast(cum AS double) * 100.0 / nullif(cast(total AS double), 0.0)')} AS cumulative_pct
FROM c ORDER BY minutes DESC, machine_name ASC NULLS LAST, line_name ASC NULLS LAST
"""

VW_SHIFT_PERFORMANCE = f"""
SELECT s.shift_name, m.line_name, m.machine_name,
  count(*) AS shift_count,
  {avg_exact('f.oee_pct')} AS avg_oee_pct,
  {avg_exact('f.availability')} AS avg_availability_pct,
  {avg_exact('f.performance')} AS avg_performance_pct,
  {avg_exact('f.quality_rate')} AS avg_quality_rate_pct,
  {_isum('f.actual_qty')} AS total_actual_qty,
  {_isum('f.total_defect_qty')} AS total_defects,
  {_dsum('f.unplanned_downtime_min')} AS total_unplanned_downtime_min
FROM ({WH_FACT}) f
JOIN ({WH_DIM_SHIFT}) s ON f.shift_key = s.shift_key
JOIN ({WH_DIM_MACHINE}) m ON f.machine_key = m.machine_key
GROUP BY s.shift_name, m.line_name, m.machine_name
"""

DRILLDOWN = f"""
SELECT m.plant_id, m.line_id, m.machine_id,
  cast(grouping(m.plant_id, m.line_id, m.machine_id) AS int) AS grouping_level,
  CASE grouping(m.plant_id, m.line_id, m.machine_id) WHEN 0 THEN 'machine' WHEN 1 THEN 'line'
       WHEN 3 THEN 'plant' ELSE 'all' END AS drill_level,
  count(*) AS run_count,
  {avg_exact('f.oee_pct')} AS avg_oee_pct,
  {avg_exact('f.availability')} AS avg_availability_pct,
  {avg_exact('f.performance')} AS avg_performance_pct,
  {avg_exact('f.quality_rate')} AS avg_quality_rate_pct,
  {_isum('f.actual_qty')} AS total_actual_qty,
  {_isum('f.good_qty')} AS total_good_qty,
  {_isum('f.total_defect_qty')} AS total_defects,
  {_dsum('f.unplanned_downtime_min')} AS total_unplanned_downtime_min
FROM ({WH_FACT}) f JOIN ({WH_DIM_MACHINE}) m ON f.machine_key = m.machine_key
GROUP BY ROLLUP (m.plant_id, m.line_id, m.machine_id)
"""


# ── data-quality suites ──────────────────────────────────────────────────────


def _check(seq: int, table: str, src: str, name: str, col: str | None, sev: str, failed: str,
           kind: str = "count", threshold: float | None = None, msg: str = "") -> str:
    col_sql = f"'{col}'" if col is not None else "cast(NULL AS varchar)"
    thr = f"cast({threshold!r} AS double)" if threshold is not None else "cast(NULL AS double)"
    if kind == "not_empty":
        failed = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"
    passed = f"ratio <= {thr}" if kind == "ratio" else "failed_count = 0"
    return f"""
SELECT {seq} AS check_seq, '{table}' AS table_name, '{name}' AS check_name, {col_sql} AS column_name,
  '{sev}' AS severity, failed_count, total_count, ratio, {thr} AS threshold, passed,
  CASE WHEN NOT passed THEN {msg} END AS message
FROM (
  SELECT *, {passed} AS passed FROM (
    SELECT *, CASE WHEN total_count > 0 THEN cast(failed_count AS double) / cast(total_count AS double)
                   ELSE 0.0 END AS ratio
    FROM (SELECT cast({failed} AS bigint) AS failed_count, cast(count(*) AS bigint) AS total_count FROM ({src}) s) a
  ) b
) c
"""


def _n(x: str = "failed_count") -> str:
    return f"format('{{:,}}', {x})"


def _p(x: str = "ratio") -> str:
    return f"format('{{:.1f}}', {x} * 100.0) || '%'"


def _txt(*parts: str) -> str:
    return " || ".join(parts)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def c_not_empty(seq, table, src):
    return _check(seq, table, src, "not_empty", None, "critical", "0", "not_empty",
                  msg=_q(f"[{table}] DataFrame is empty."))


def c_null_key(seq, table, src, col):
    return _check(seq, table, src, "null_keys", col, "critical", f"count(*) FILTER (WHERE {col} IS NULL)",
                  msg=_txt(_q(f"[{table}] Column '{col}' has "), _n(), _q(" NULL values (key column).")))


def _distinct(src, keys):
    return f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM ({src}) d) dd)"


def c_duplicates(seq, table, src, keys):
    keys_txt = "[" + ", ".join(f"'{k}'" for k in keys) + "]"
    return _check(seq, table, src, "duplicates", ",".join(keys), "critical",
                  f"count(*) - {_distinct(src, keys)}",
                  msg=_txt(_q(f"[{table}] "), _n(), _q(f" duplicate rows on keys {keys_txt}.")))


def c_duplicate_ratio(seq, table, src, keys, threshold):
    keys_txt = "[" + ", ".join(f"'{k}'" for k in keys) + "]"
    return _check(seq, table, src, "duplicate_ratio", ",".join(keys), "warning",
                  f"count(*) - {_distinct(src, keys)}", "ratio", threshold,
                  msg=_txt(_q(f"[{table}] duplicate ratio "), _p(),
                           _q(f" on keys {keys_txt} exceeds threshold {threshold * 100:.1f}%.")))


def c_date_format(seq, table, src, col):
    bad = f"{parse_date(f'cast({col} AS varchar)')} IS NULL AND {col} IS NOT NULL"
    return _check(seq, table, src, "date_format", col, "critical", f"count(*) FILTER (WHERE {bad})",
                  msg=_txt(_q(f"[{table}] Column '{col}' has "), _n(),
                           _q(" rows with invalid date format (expected yyyy-MM-dd).")))


def c_value_range(seq, table, src, col, lo=0, hi=None):
    cond = f"{col} < {lo}" + (f" OR {col} > {hi}" if hi is not None else "")
    desc = f">= {lo}" + (f" and <= {hi}" if hi else "")
    return _check(seq, table, src, "value_range", col, "warning", f"count(*) FILTER (WHERE {cond})",
                  msg=_txt(_q(f"[{table}] Column '{col}' has "), _n(),
                           _q(f" rows outside expected range ({desc}).")))


def c_null_ratio(seq, table, src, col, threshold):
    return _check(seq, table, src, "null_ratio", col, "warning", f"count(*) FILTER (WHERE {col} IS NULL)",
                  "ratio", threshold,
                  msg=_txt(_q(f"[{table}] Column '{col}' NULL ratio "), _p(),
                           _q(f" exceeds threshold {threshold * 100:.1f}%.")))


def c_oee(seq, table, src, col):
    return _check(seq, table, src, "oee_bounds", col, "warning",
                  f"count(*) FILTER (WHERE {col} < 0 OR {col} > 100)",
                  msg=_txt(_q(f"[{table}] OEE metric '{col}' has "), _n(), _q(" rows outside [0, 100].")))


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def suite_production(src=RAW_PRODUCTION, t="production"):
    return _union([
        c_not_empty(1, t, src),
        c_null_key(2, t, src, "production_id"), c_null_key(3, t, src, "machine_id"),
        c_null_key(4, t, src, "production_date"),
        c_duplicates(5, t, src, ["production_id"]),
        c_date_format(6, t, src, "production_date"),
        c_value_range(7, t, src, "planned_qty"), c_value_range(8, t, src, "actual_qty"),
        c_value_range(9, t, src, "good_qty"),
        c_null_ratio(10, t, src, "shift_id", 0.01),
    ])


def suite_downtime(src=RAW_DOWNTIME, t="downtime"):
    return _union([
        c_not_empty(1, t, src),
        c_null_key(2, t, src, "downtime_id"), c_null_key(3, t, src, "machine_id"),
        c_duplicates(4, t, src, ["downtime_id"]),
        c_date_format(5, t, src, "production_date"),
        c_value_range(6, t, src, "downtime_minutes", 0, 1440),
        c_null_ratio(7, t, src, "downtime_reason", 0.1),
    ])


def suite_quality(src=RAW_QUALITY, t="quality"):
    return _union([
        c_not_empty(1, t, src),
        c_null_key(2, t, src, "inspection_id"), c_null_key(3, t, src, "machine_id"),
        c_duplicates(4, t, src, ["inspection_id"]),
        c_date_format(5, t, src, "production_date"),
        c_value_range(6, t, src, "defect_qty"), c_value_range(7, t, src, "inspected_qty"),
    ])


def suite_fact(src=FACT_PRODUCTION, t="fact_production"):
    return _union([
        c_not_empty(1, t, src),
        c_null_key(2, t, src, "production_id"), c_null_key(3, t, src, "machine_id"),
        c_null_key(4, t, src, "production_date"),
        c_duplicates(5, t, src, ["production_id"]),
        c_oee(6, t, src, "availability"), c_oee(7, t, src, "performance"),
        c_oee(8, t, src, "quality_rate"), c_oee(9, t, src, "oee_pct"),
        c_value_range(10, t, src, "oee_pct", 0, 100),
    ])


DQ_SUMMARY = f"""
SELECT table_name, check_seq, check_name, column_name, severity, failed_count, message,
  CASE WHEN severity = 'critical' THEN 'raise' ELSE 'log' END AS action
FROM (
  {suite_production()}
  UNION ALL {suite_downtime()}
  UNION ALL {suite_quality()}
  UNION ALL {suite_fact()}
) r WHERE NOT passed
"""


# ── two loads, one after the other ───────────────────────────────────────────

BATCHES = (
    "(plant_id = 'PLT0' OR (plant_id <> 'PLT1' AND production_date < date '1999-01-01'))",
    "(plant_id <> 'PLT0' AND (plant_id = 'PLT1' OR production_date >= date '1998-07-01' OR production_date IS NULL))",
)
_T1, _T2 = "timestamp '2024-01-01 00:00:00'", "timestamp '2024-02-01 00:00:00'"


def _of_batch(dim: str, n: int) -> str:
    return dim.replace(CLEAN_PRODUCTION, f"SELECT * FROM ({CLEAN_PRODUCTION}) z WHERE {BATCHES[n]}")


_MACHINE_COLS = "machine_id, machine_name, machine_type, is_active, line_id, line_name, plant_id, plant_name"

TWO_DIM_MACHINE = f"""
WITH d1 AS (SELECT row_number() OVER (ORDER BY machine_id) AS machine_key, * FROM ({_of_batch(DIM_MACHINE, 0)}) a),
d2 AS ({_of_batch(DIM_MACHINE, 1)}),
nw AS (
  SELECT (SELECT count(*) FROM d1) + row_number() OVER (ORDER BY machine_id) AS machine_key, *
  FROM d2 WHERE machine_id NOT IN (SELECT machine_id FROM d1)),
allm AS (
  SELECT machine_key, {_MACHINE_COLS}, {_T1} AS created_at, {_T1} AS updated_at
  FROM d1 WHERE machine_id NOT IN (SELECT machine_id FROM d2)
  UNION ALL
  SELECT k.machine_key, {', '.join('d2.' + c for c in _MACHINE_COLS.split(', '))}, {_T1}, {_T2}
  FROM d2 JOIN (SELECT machine_id, machine_key FROM d1) k ON d2.machine_id = k.machine_id
  UNION ALL
  SELECT machine_key, {_MACHINE_COLS}, {_T2}, {_T2} FROM nw)
SELECT cast(machine_key AS int) AS machine_key, {_MACHINE_COLS}, cast(NULL AS varchar) AS plant_location,
  created_at, updated_at
FROM allm
"""

TWO_DIM_PRODUCT = f"""
WITH d1 AS (SELECT * FROM ({_of_batch(DIM_PRODUCT, 0)}) a WHERE product_id IS NOT NULL),
d2 AS (SELECT * FROM ({_of_batch(DIM_PRODUCT, 1)}) a WHERE product_id NOT IN (SELECT product_id FROM d1))
SELECT cast(row_number() OVER (ORDER BY product_id) AS int) AS product_key, * FROM d1
UNION ALL
SELECT cast((SELECT count(*) FROM d1) + row_number() OVER (ORDER BY product_id) AS int), * FROM d2
"""


def _resolved_batch(n: int, machine: str, product: str) -> str:
    return (RESOLVED_FACT.replace(WH_DIM_MACHINE, machine).replace(WH_DIM_PRODUCT, product)
            .replace(FACT_PRODUCTION, f"SELECT * FROM fact z WHERE {BATCHES[n]}"))


_FACT_REST = f"""production_id, date_key, machine_key, shift_key, product_key, planned_qty, actual_qty, good_qty,
  {', '.join(_MINUTES)}, downtime_events, total_inspected_qty, total_defect_qty, {', '.join(_PERCENT)}"""

TWO_FACT = f"""
WITH fact AS MATERIALIZED ({FACT_PRODUCTION}),
m1 AS MATERIALIZED ({_of_batch(WH_DIM_MACHINE, 0)}), p1 AS MATERIALIZED ({_of_batch(WH_DIM_PRODUCT, 0)}),
m2 AS MATERIALIZED ({TWO_DIM_MACHINE}), p2 AS MATERIALIZED ({TWO_DIM_PRODUCT}),
f1 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY production_id) AS production_sk, {_FACT_REST}
  FROM ({_resolved_batch(0, 'SELECT * FROM m1', 'SELECT * FROM p1')}) r WHERE reject_reason IS NULL),
f2 AS (
  SELECT (SELECT count(*) FROM f1) + row_number() OVER (ORDER BY production_id) AS production_sk, {_FACT_REST}
  FROM ({_resolved_batch(1, 'SELECT * FROM m2', 'SELECT * FROM p2')}) r WHERE reject_reason IS NULL)
SELECT *, {_T1} AS loaded_at FROM f1
WHERE production_id NOT IN (SELECT production_id FROM fact WHERE {BATCHES[1]} AND production_id IS NOT NULL)
UNION ALL SELECT *, {_T2} FROM f2
"""

TWO_VERIFICATION = f"""
SELECT 'fact_production' AS table_name, count(*) AS row_count, max(loaded_at) AS last_loaded FROM ({TWO_FACT}) a
UNION ALL SELECT 'dim_machine', count(*), max(updated_at) FROM ({TWO_DIM_MACHINE}) b
UNION ALL SELECT 'dim_date', count(*), NULL FROM ({WH_DIM_DATE}) c
UNION ALL SELECT 'dim_shift', count(*), NULL FROM ({WH_DIM_SHIFT}) d
UNION ALL SELECT 'dim_product', count(*), NULL FROM ({TWO_DIM_PRODUCT}) e
"""

DRIFTED_RUNS = f"""
SELECT * REPLACE (CASE WHEN shift_id IN ('S1', 'S3') THEN NULL ELSE actual_runtime_min END AS actual_runtime_min)
FROM ({RAW_PRODUCTION}) r
"""


def _written_dim(name: str, sql: str, columns: str) -> str:
    text = ", ".join(f"coalesce(cast({c} AS varchar), '-')" for c in columns.split())
    return f"SELECT '{name}' AS table_name, concat_ws('|', {text}) AS member FROM ({sql}) d"


WRITTEN_DIMS = _union([
    _written_dim("dim_machine", DIM_MACHINE,
                 "is_active line_id line_name machine_id machine_name machine_type plant_id plant_name"),
    _written_dim("dim_shift", DIM_SHIFT, "shift_hours shift_id shift_name shift_start"),
    _written_dim("dim_product", DIM_PRODUCT, "product_family product_id product_name unit_of_measure"),
    _written_dim("dim_date", DIM_DATE, "date_key day_name day_of_week is_weekend month month_name quarter week year"),
])


# ── scans, sinks, catalog, layout, streaming (identity of their source) ──────

_WH_FACT_NO_CLOCK = WH_FACT


def statements() -> dict[str, str]:
    """DuckDB statement per registered query."""
    return {
        "dedup_production": DEDUP_PRODUCTION,
        "dedup_downtime": DEDUP_DOWNTIME,
        "dedup_quality": DEDUP_QUALITY,
        "clean_production": CLEAN_PRODUCTION,
        "clean_downtime": CLEAN_DOWNTIME,
        "clean_quality": CLEAN_QUALITY,
        "agg_downtime": AGG_DOWNTIME,
        "agg_quality": AGG_QUALITY,
        "fact_join": FACT_JOIN,
        "oee": OEE,
        "fact_production": FACT_PRODUCTION,
        "dim_machine": DIM_MACHINE,
        "dim_shift": DIM_SHIFT,
        "dim_product": DIM_PRODUCT,
        "dim_date": DIM_DATE,
        "load_upsert_dim_machine": WH_DIM_MACHINE,
        "load_dim_product": WH_DIM_PRODUCT,
        "load_dim_date": WH_DIM_DATE,
        "load_fact_fk_lookup": LOAD_FACT_FK_LOOKUP,
        "load_fact_rejects": LOAD_FACT_REJECTS,
        "load_fact_conform": LOAD_FACT_CONFORM,
        "load_upsert_fact": WH_FACT,
        "load_surrogate_keys": LOAD_SURROGATE_KEYS,
        "load_verification": LOAD_VERIFICATION,
        "load_two_dim_machine": TWO_DIM_MACHINE,
        "load_two_dim_product": TWO_DIM_PRODUCT,
        "load_two_dim_date": WH_DIM_DATE,
        "load_two_fact": TWO_FACT,
        # Two batches with late, corrected and repeated records give what one run over all of them gives.
        "lake_update_fact": FACT_PRODUCTION,
        "catalog_vw_daily_oee": VW_DAILY_OEE,
        "catalog_vw_monthly_summary": VW_MONTHLY_SUMMARY,
        "catalog_vw_downtime_pareto": VW_DOWNTIME_PARETO,
        "catalog_vw_shift_performance": VW_SHIFT_PERFORMANCE,
        "lake_update_dims": WRITTEN_DIMS,
        "lake_update_load": f"SELECT count(*) FILTER (reject_reason IS NULL) AS loaded, "
                            f"count(*) FILTER (reject_reason IS NOT NULL) AS rejected FROM ({RESOLVED_FACT}) r",
        "load_changed_fact": f"""
SELECT production_id, date_key, planned_qty, actual_qty, good_qty, {', '.join(_MINUTES)}, downtime_events,
  total_inspected_qty, total_defect_qty, {', '.join(_PERCENT)} FROM ({WH_FACT}) f
""",
        "rollup_daily_oee": VW_DAILY_OEE,
        "rollup_monthly_summary": VW_MONTHLY_SUMMARY,
        "rollup_downtime_pareto": VW_DOWNTIME_PARETO,
        "rollup_shift_performance": VW_SHIFT_PERFORMANCE,
        "rollup_drilldown": DRILLDOWN,
        "load_two_verification": TWO_VERIFICATION,
        "catalog_schema_drift": DRIFTED_RUNS,
        "vw_daily_oee": VW_DAILY_OEE,
        "vw_monthly_summary": VW_MONTHLY_SUMMARY,
        "vw_downtime_pareto": VW_DOWNTIME_PARETO,
        "vw_shift_performance": VW_SHIFT_PERFORMANCE,
        "drilldown_plant_line_machine": DRILLDOWN,
        "dq_suite_production": suite_production(),
        "dq_suite_downtime": suite_downtime(),
        "dq_suite_quality": suite_quality(),
        "dq_suite_fact": suite_fact(),
        "dq_not_empty": c_not_empty(1, "fact_production", FACT_PRODUCTION),
        "dq_null_keys": _union([c_null_key(i + 1, "fact_production", FACT_PRODUCTION, c)
                                for i, c in enumerate(["production_id", "machine_id", "production_date"])]),
        "dq_duplicates": c_duplicates(1, "production", RAW_PRODUCTION, ["production_id"]),
        "dq_date_format": c_date_format(1, "production", RAW_PRODUCTION, "production_date"),
        "dq_value_range": c_value_range(1, "downtime", RAW_DOWNTIME, "downtime_minutes", 0, 1440),
        "dq_null_ratio": c_null_ratio(1, "downtime", RAW_DOWNTIME, "downtime_reason", 0.1),
        "dq_oee_bounds": _union([c_oee(i + 1, "fact_production", FACT_PRODUCTION, c)
                                 for i, c in enumerate(["availability", "performance", "quality_rate", "oee_pct"])]),
        "dq_duplicate_ratio": c_duplicate_ratio(1, "production", RAW_PRODUCTION, ["production_id"], 0.01),
        "dq_summary": DQ_SUMMARY,
        "scan_csv_production": RAW_PRODUCTION,
        "scan_csv_downtime": RAW_DOWNTIME,
        "scan_csv_quality": RAW_QUALITY,
        "scan_json_production": RAW_PRODUCTION,
        "scan_csv_quarantine": f"""
SELECT production_id, CASE WHEN damaged THEN 'damaged' ELSE 'kept' END AS state, CASE WHEN NOT damaged THEN planned_qty END AS planned_qty,
  CASE WHEN damaged THEN concat(production_id, ',', plant_id, ',', line_id, ',', machine_id, ',', shift_id, ',', product_id, ',',
    production_date, ',', planned_qty, 'x,', actual_qty, ',', good_qty, ',', planned_runtime_min, ',', actual_runtime_min) END AS line
FROM (SELECT *, cast(substr(machine_id, 2) AS bigint) % 89 = 1 AS damaged FROM ({RAW_PRODUCTION}) r) d
""",
        "scan_json_quarantine": f"""
SELECT production_id, CASE WHEN damaged THEN 'damaged' ELSE 'kept' END AS state, CASE WHEN NOT damaged THEN planned_qty END AS planned_qty
FROM (SELECT *, cast(substr(machine_id, 2) AS bigint) % 89 = 1 AS damaged FROM ({RAW_PRODUCTION}) r) d
""",
        "sink_parquet": RAW_PRODUCTION,
        "sink_fact_partitioned": FACT_PRODUCTION,
        "fact_rowcount": f"SELECT count(*) AS fact_rows FROM ({FACT_PRODUCTION}) f",
        "sink_dims": WRITTEN_DIMS,
        "load_copy_parquet": f"""
SELECT machine_id, machine_name, machine_type, is_active, line_id, line_name, plant_id, plant_name,
  cast(NULL AS varchar) AS plant_location
FROM ({DIM_MACHINE}) m
""",
        "catalog_register_raw": RAW_PRODUCTION,
        "catalog_register_fact": FACT_PRODUCTION,
        "catalog_star_schema": WH_DIM_DATE,
        "catalog_column_defaults": WH_DIM_PRODUCT,
        "layout_fact_sorted": _WH_FACT_NO_CLOCK,
        "maint_compact": _WH_FACT_NO_CLOCK,
        "maint_compact_months": f"""
SELECT cast(year(date_key) * 100 + month(date_key) AS int) AS month_key, count(*) AS fact_rows,
  cast(sum(actual_qty) AS bigint) AS actual_qty, true AS is_packed
FROM ({WH_FACT}) f GROUP BY year(date_key) * 100 + month(date_key)
""",
        "maint_column_statistics": _union([f"""
SELECT '{c}' AS column_name, cast(min({c}) AS varchar) AS min_value, cast(max({c}) AS varchar) AS max_value,
  count(*) - count({c}) AS null_count FROM ({WH_FACT}) f
""" for c in ["date_key", "planned_qty", "actual_qty", "first_pass_yield", "oee_pct"]]),
        "maint_analyze": f"SELECT 'fact_production' AS table_name, count(*) AS row_count FROM ({WH_FACT}) f",
        "stream_raw_to_parquet": RAW_PRODUCTION,
    }

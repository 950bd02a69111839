"""Data-quality suites evaluated in one pass per table.

A suite is a list of :class:`Check`.  :func:`run_suite` turns every check
into an aggregate expression and evaluates them all in a single ``agg`` over
the table (one job), then unpivots the one-row result into a results
DataFrame — one row per check:

    check_seq, table_name, check_name, column_name, severity,
    failed_count, total_count, ratio, threshold, passed, message

The duplicate check is ``count(*) - count(DISTINCT struct(keys))`` (NULL keys
compare equal, as in a dedup).  Its distinct aggregation is partially
aggregated per map task, so a hot key does not concentrate in one task.

:func:`enforce` is the only driver-side step: it collects the results (one row
per check) and raises :class:`DataQualityError` for failed critical checks.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.dates import DATE_FORMAT

log = logging.getLogger("shopfloor.quality")

CRITICAL = "critical"
WARNING = "warning"

# Result message texts.
MSG_EMPTY = "[{table}] DataFrame is empty."
MSG_NULL_KEYS = "[{table}] Column '{col}' has {n} NULL values (key column)."
MSG_DUPLICATES = "[{table}] {n} duplicate rows on keys {keys}."
MSG_DATE = "[{table}] Column '{col}' has {n} rows with invalid date format (expected {fmt})."
MSG_RANGE = "[{table}] Column '{col}' has {n} rows outside expected range ({desc})."
MSG_NULL_RATIO = "[{table}] Column '{col}' NULL ratio {ratio} exceeds threshold {threshold}."
MSG_OEE = "[{table}] OEE metric '{col}' has {n} rows outside [0, 100]."
MSG_DUP_RATIO = "[{table}] duplicate ratio {ratio} on keys {keys} exceeds threshold {threshold}."

OEE_METRICS = ["availability", "performance", "quality_rate", "oee_pct"]


class DataQualityError(Exception):
    """Raised when a critical data-quality check fails."""


@dataclass(frozen=True)
class Check:
    name: str
    column: str | None
    severity: str
    failed: Column  # aggregate expression: number of failing rows
    kind: str = "count"  # count | ratio | not_empty
    threshold: float | None = None
    template: str = ""
    params: dict = field(default_factory=dict)


def _n(col: Column) -> Column:
    return F.format_number(col, 0)


def _pct(col: Column) -> Column:
    return F.concat(F.format_number(col * 100.0, 1), F.lit("%"))


def _keys_text(keys: list[str]) -> str:
    return "[" + ", ".join(f"'{k}'" for k in keys) + "]"


def _num_text(v) -> str:
    return str(v)


# ── checks ───────────────────────────────────────────────────────────────────


def not_empty() -> Check:
    return Check("not_empty", None, CRITICAL, F.lit(0).cast("long"), kind="not_empty", template=MSG_EMPTY)


def null_keys(columns: list[str]) -> list[Check]:
    return [
        Check("null_keys", c, CRITICAL, F.count_if(F.col(c).isNull()), template=MSG_NULL_KEYS)
        for c in columns
    ]


def _distinct_keys(keys: list[str]) -> Column:
    return F.count_distinct(F.struct(*[F.col(k) for k in keys]))


def duplicates(keys: list[str]) -> Check:
    failed = F.count(F.lit(1)) - _distinct_keys(keys)
    return Check("duplicates", ",".join(keys), CRITICAL, failed, template=MSG_DUPLICATES, params={"keys": keys})


def duplicate_ratio(keys: list[str], threshold: float = 0.01) -> Check:
    failed = F.count(F.lit(1)) - _distinct_keys(keys)
    return Check("duplicate_ratio", ",".join(keys), WARNING, failed, kind="ratio", threshold=threshold,
                 template=MSG_DUP_RATIO, params={"keys": keys})


def date_format(column: str, fmt: str = DATE_FORMAT) -> Check:
    text = F.col(column).cast("string")
    bad = F.try_to_date(text, fmt).isNull() & F.col(column).isNotNull()
    return Check("date_format", column, CRITICAL, F.count_if(bad), template=MSG_DATE, params={"fmt": fmt})


def value_range(column: str, min_val: float = 0, max_val: float | None = None) -> Check:
    c = F.col(column)
    cond = c < F.lit(min_val)
    if max_val is not None:
        cond = cond | (c > F.lit(max_val))
    desc = f">= {_num_text(min_val)}" + (f" and <= {_num_text(max_val)}" if max_val else "")
    return Check("value_range", column, WARNING, F.count_if(cond), template=MSG_RANGE, params={"desc": desc})


def null_ratio(column: str, threshold: float = 0.05) -> Check:
    return Check("null_ratio", column, WARNING, F.count_if(F.col(column).isNull()), kind="ratio",
                 threshold=threshold, template=MSG_NULL_RATIO)


def oee_bounds(columns: list[str], low: float = 0, high: float = 100) -> list[Check]:
    """One check per OEE metric present in ``columns`` (absent metrics are skipped)."""
    out = []
    for m in OEE_METRICS:
        if m in columns:
            c = F.col(m)
            out.append(Check("oee_bounds", m, WARNING, F.count_if((c < low) | (c > high)), template=MSG_OEE))
    return out


# ── suites ───────────────────────────────────────────────────────────────────


@dataclass(frozen=True)
class SuiteConfig:
    """Thresholds that vary per environment (dev / prod)."""

    max_null_ratio: float | None = None
    max_duplicate_ratio: float | None = None
    oee_min: float = 0
    oee_max: float = 100


DEV = SuiteConfig(max_null_ratio=0.10, max_duplicate_ratio=0.01)
PROD = SuiteConfig(max_null_ratio=0.05, max_duplicate_ratio=0.001)


def _extra(config: SuiteConfig | None, key: str) -> list[Check]:
    if config is None or config.max_duplicate_ratio is None:
        return []
    return [duplicate_ratio([key], config.max_duplicate_ratio)]


def production_suite(config: SuiteConfig | None = None) -> list[Check]:
    ratio = config.max_null_ratio if config and config.max_null_ratio is not None else 0.01
    return [
        not_empty(),
        *null_keys(["production_id", "machine_id", "production_date"]),
        duplicates(["production_id"]),
        date_format("production_date"),
        value_range("planned_qty", min_val=0),
        value_range("actual_qty", min_val=0),
        value_range("good_qty", min_val=0),
        null_ratio("shift_id", threshold=ratio),
        *_extra(config, "production_id"),
    ]


def downtime_suite(config: SuiteConfig | None = None) -> list[Check]:
    ratio = config.max_null_ratio if config and config.max_null_ratio is not None else 0.10
    return [
        not_empty(),
        *null_keys(["downtime_id", "machine_id"]),
        duplicates(["downtime_id"]),
        date_format("production_date"),
        value_range("downtime_minutes", min_val=0, max_val=1440),
        null_ratio("downtime_reason", threshold=ratio),
        *_extra(config, "downtime_id"),
    ]


def quality_suite(config: SuiteConfig | None = None) -> list[Check]:
    return [
        not_empty(),
        *null_keys(["inspection_id", "machine_id"]),
        duplicates(["inspection_id"]),
        date_format("production_date"),
        value_range("defect_qty", min_val=0),
        value_range("inspected_qty", min_val=0),
        *_extra(config, "inspection_id"),
    ]


def fact_suite(columns: list[str], config: SuiteConfig | None = None) -> list[Check]:
    low, high = (config.oee_min, config.oee_max) if config else (0, 100)
    return [
        not_empty(),
        *null_keys(["production_id", "machine_id", "production_date"]),
        duplicates(["production_id"]),
        *oee_bounds(columns, low, high),
        value_range("oee_pct", min_val=0, max_val=100),
        *_extra(config, "production_id"),
    ]


SUITES = {
    "production": production_suite,
    "downtime": downtime_suite,
    "quality": quality_suite,
}


def suite_for(table_name: str, df: DataFrame, config: SuiteConfig | None = None) -> list[Check]:
    if table_name == "fact_production":
        return fact_suite(df.columns, config)
    return SUITES[table_name](config)


# ── evaluation ───────────────────────────────────────────────────────────────


def _message(check: Check, table: str, failed: Column, ratio: Column) -> Column:
    t = check.template
    if check.kind == "not_empty":
        return F.lit(t.format(table=table))
    pieces = {"table": table, "col": check.column or "", "fmt": check.params.get("fmt", ""),
              "desc": check.params.get("desc", ""), "keys": _keys_text(check.params.get("keys", []))}
    # Split the template around the dynamic fields and splice Spark-formatted numbers in.
    dynamic = {"n": _n(failed), "ratio": _pct(ratio),
               "threshold": F.lit(f"{(check.threshold or 0) * 100:.1f}%")}
    parts: list[Column] = []
    rest = t
    while rest:
        start = rest.find("{")
        if start < 0:
            parts.append(F.lit(rest))
            break
        end = rest.index("}", start)
        parts.append(F.lit(rest[:start]))
        name = rest[start + 1:end]
        parts.append(dynamic[name] if name in dynamic else F.lit(str(pieces[name])))
        rest = rest[end + 1:]
    return F.concat(*parts)


def run_suite(df: DataFrame, table_name: str, checks: list[Check]) -> DataFrame:
    """Evaluate ``checks`` over ``df`` in one aggregation; one result row per check."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [c.failed.cast("long").alias(f"_f{i}") for i, c in enumerate(checks)]
    one_row = df.agg(*aggs)
    total = F.col("_total")
    rows = []
    for i, c in enumerate(checks):
        failed = F.col(f"_f{i}")
        if c.kind == "not_empty":
            failed = F.when(total == 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
        ratio = F.when(total > 0, failed.cast("double") / total.cast("double")).otherwise(F.lit(0.0))
        threshold = F.lit(c.threshold).cast("double")
        if c.kind == "ratio":
            passed = ratio <= threshold
        else:
            passed = failed == 0
        rows.append(
            F.struct(
                F.lit(i + 1).alias("check_seq"),
                F.lit(table_name).alias("table_name"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.column).cast("string").alias("column_name"),
                F.lit(c.severity).alias("severity"),
                failed.alias("failed_count"),
                total.alias("total_count"),
                ratio.alias("ratio"),
                threshold.alias("threshold"),
                passed.alias("passed"),
                F.when(~passed, _message(c, table_name, failed, ratio)).alias("message"),
            )
        )
    return one_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def run_suites(tables: dict[str, DataFrame], config: SuiteConfig | None = None) -> DataFrame:
    out = None
    for name, df in tables.items():
        res = run_suite(df, name, suite_for(name, df, config))
        out = res if out is None else out.unionByName(res)
    return out


def summary(results: DataFrame) -> DataFrame:
    """Failed checks with the action a gate takes: critical → raise, warning → log."""
    return results.filter(~F.col("passed")).select(
        "table_name", "check_seq", "check_name", "column_name", "severity", "failed_count", "message",
        F.when(F.col("severity") == CRITICAL, F.lit("raise")).otherwise(F.lit("log")).alias("action"),
    )


def enforce(results: DataFrame, gate: set[str] | None = None) -> list[str]:
    """Log warnings; raise for failed critical checks.

    ``gate`` restricts which critical checks raise: entries are a check name
    (``"duplicates"``) or ``"check:column"`` (``"null_keys:machine_id"``);
    ``None`` raises on every failed critical check.  Returns the warning messages.
    """
    failed = summary(results).orderBy("table_name", "check_seq").collect()  # one row per failed check
    warnings, errors = [], []
    for r in failed:
        gated = gate is None or r["check_name"] in gate or f"{r['check_name']}:{r['column_name']}" in gate
        if r["severity"] == CRITICAL and gated:
            errors.append(r["message"])
        else:
            warnings.append(r["message"])
    for w in warnings:
        log.warning(w)
    if errors:
        raise DataQualityError("Data quality checks failed:\n" + "\n".join(errors))
    return warnings

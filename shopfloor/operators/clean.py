"""Cleaning of the raw tables (key filters, dedup, date parsing, clamps).

Order of steps, per table: key filter → NaN normalisation → dedup by id →
parse / clamp / decode.  Filtering before dedup means a valid copy of an id
is never lost to a twin with a NULL key.

Dedup keeps, per id, the first row under the total order "every other
column ascending, NULLs last" — the same survivor on every run, retry and
partitioning.  It is written as ``row_number() = 1`` over that order; Spark
plans it with a partial ``WindowGroupLimit`` *before* the shuffle, so every
map task already keeps one row per id and an id carrying a third of all
rows sends one row per map task, not all of them, to a single reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from shopfloor.functions import clamp_negative, nan_to_null, parse_date


def dedup_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the first by the other columns (ascending, NULLs last)."""
    order = [F.col(c).asc_nulls_last() for c in df.columns if c != key]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")


def normalize_nan(df: DataFrame) -> DataFrame:
    """NaN → NULL in every double column."""
    return df.select(
        *[nan_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
          for f in df.schema.fields]
    )


def filter_production_keys(df: DataFrame) -> DataFrame:
    # On the text, before parsing: unparseable dates pass and become NULL later.
    return df.filter(F.col("machine_id").isNotNull() & F.col("production_date").isNotNull())


def filter_machine_key(df: DataFrame) -> DataFrame:
    return df.filter(F.col("machine_id").isNotNull())


def dedup_production(raw: DataFrame) -> DataFrame:
    return dedup_by_key(normalize_nan(filter_production_keys(raw)), "production_id")


def dedup_downtime(raw: DataFrame) -> DataFrame:
    return dedup_by_key(normalize_nan(filter_machine_key(raw)), "downtime_id")


def dedup_quality(raw: DataFrame) -> DataFrame:
    return dedup_by_key(normalize_nan(filter_machine_key(raw)), "inspection_id")


def clean_production(raw: DataFrame) -> DataFrame:
    return parse_production(dedup_production(raw))


def parse_production(records: DataFrame) -> DataFrame:
    """Unique records → dates parsed, quantities not below zero."""
    return (
        records
        .withColumn("production_date", parse_date(F.col("production_date")))
        .withColumn("planned_qty", clamp_negative(F.col("planned_qty")))
        .withColumn("actual_qty", clamp_negative(F.col("actual_qty")))
        .withColumn("good_qty", clamp_negative(F.col("good_qty")))
    )


def planned_flag(col) -> "F.Column":
    """``Y``/``y`` → true; anything else, NULL included, → false (no trimming)."""
    return F.coalesce(F.upper(col) == F.lit("Y"), F.lit(False))


def clean_downtime(raw: DataFrame) -> DataFrame:
    return parse_downtime(dedup_downtime(raw))


def parse_downtime(records: DataFrame) -> DataFrame:
    return (
        records
        .withColumn("production_date", parse_date(F.col("production_date")))
        .withColumn("is_planned_flag", planned_flag(F.col("is_planned")))
        .withColumn("downtime_minutes", clamp_negative(F.col("downtime_minutes")).cast("double"))
    )


def clean_quality(raw: DataFrame) -> DataFrame:
    return parse_quality(dedup_quality(raw))


def parse_quality(records: DataFrame) -> DataFrame:
    # least() skips NULL: a NULL defect count becomes the inspected count;
    # negative defect counts are left as they are.
    return (
        records
        .withColumn("production_date", parse_date(F.col("production_date")))
        .withColumn("defect_qty", F.least(F.col("defect_qty"), F.col("inspected_qty")))
    )

"""Lake dimensions derived from cleaned production runs.

Every dimension starts with a ``distinct`` of its columns: partial aggregation
on each map task keeps the shuffle at (members × tasks) rows however large the
production table is.  Ranking (dim_machine) runs on the distinct rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.operators.clean import dedup_by_key

# Names, placeholders and shift calendar of the dimension rows.
MACHINE_NAME_PREFIX = "Machine-"
LINE_NAME_PREFIX = "Line-"
PRODUCT_NAME_PREFIX = "Product-"
PLANT_NAME = "Plant 001"
MACHINE_TYPE = "CNC"
PRODUCT_FAMILY = "General"
UNIT_OF_MEASURE = "PCS"
SHIFT_NAMES = {
    "S1": "Morning (06:00–14:00)",
    "S2": "Afternoon (14:00–22:00)",
    "S3": "Night (22:00–06:00)",
}
UNKNOWN_SHIFT = "Unknown"
SHIFT_STARTS = {"S1": "06:00", "S2": "14:00"}
OTHER_SHIFT_START = "22:00"  # also used for unknown shifts
SHIFT_HOURS = 8


def dim_machine(production: DataFrame) -> DataFrame:
    """One row per machine; line and plant from its smallest (line_id, plant_id)."""
    members = dedup_by_key(production.select("machine_id", "line_id", "plant_id").distinct(), "machine_id")
    return (
        members.withColumn("machine_name", F.concat(F.lit(MACHINE_NAME_PREFIX), F.col("machine_id")))
        .withColumn("line_name", F.concat(F.lit(LINE_NAME_PREFIX), F.col("line_id")))
        .withColumn("plant_name", F.lit(PLANT_NAME))
        .withColumn("machine_type", F.lit(MACHINE_TYPE))
        .withColumn("is_active", F.lit(True))
    )


def _lookup(col, mapping: dict[str, str], default: str):
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == key, F.lit(value)) if expr is None else expr.when(col == key, F.lit(value)))
    return expr.otherwise(F.lit(default))


def shift_name(col):
    return _lookup(col, SHIFT_NAMES, UNKNOWN_SHIFT)


def shift_start(col):
    return _lookup(col, SHIFT_STARTS, OTHER_SHIFT_START)


def dim_shift(production: DataFrame) -> DataFrame:
    sid = F.col("shift_id")
    return (
        production.select("shift_id").distinct()
        .withColumn("shift_name", shift_name(sid))
        .withColumn("shift_start", shift_start(sid))
        .withColumn("shift_hours", F.lit(SHIFT_HOURS))
    )


def dim_product(production: DataFrame) -> DataFrame:
    return (
        production.select("product_id").distinct()
        .withColumn("product_name", F.concat(F.lit(PRODUCT_NAME_PREFIX), F.col("product_id")))
        .withColumn("product_family", F.lit(PRODUCT_FAMILY))
        .withColumn("unit_of_measure", F.lit(UNIT_OF_MEASURE))
    )


def calendar(date_col) -> list:
    """The eight calendar attributes of a DATE column (ISO week, 1 = Sunday)."""
    dow = F.dayofweek(date_col)
    return [
        F.year(date_col).alias("year"),
        F.quarter(date_col).alias("quarter"),
        F.month(date_col).alias("month"),
        F.date_format(date_col, "MMMM").alias("month_name"),
        F.weekofyear(date_col).alias("week"),
        dow.alias("day_of_week"),
        F.date_format(date_col, "EEEE").alias("day_name"),
        F.coalesce(dow.isin(1, 7), F.lit(False)).alias("is_weekend"),
    ]


def dim_date(production: DataFrame) -> DataFrame:
    """Distinct production dates; an unparseable date yields one NULL row (not a weekend)."""
    dates = production.select(F.col("production_date").alias("date_key")).distinct()
    return dates.select("date_key", *calendar(F.col("date_key")))


def all_dims(production: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_machine": dim_machine(production),
        "dim_shift": dim_shift(production),
        "dim_product": dim_product(production),
        "dim_date": dim_date(production),
    }

"""Schemas of the raw, lake and warehouse tables.

Fixed values: column names, order and types below must equal the source
system's so files written by either side line up column for column.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in fields])


# ── raw zone (fixed values) ──────────────────────────────────────────────────
# Declared NOT NULL where the source declares it; file sources return every
# column as nullable anyway, which is why cleaning filters on keys.
PRODUCTION = _struct(
    ("production_id", StringType(), False),
    ("plant_id", StringType(), False),
    ("line_id", StringType(), False),
    ("machine_id", StringType(), False),
    ("shift_id", StringType(), False),
    ("product_id", StringType(), False),
    ("production_date", StringType(), False),
    ("planned_qty", IntegerType(), True),
    ("actual_qty", IntegerType(), True),
    ("good_qty", IntegerType(), True),
    ("planned_runtime_min", DoubleType(), True),
    ("actual_runtime_min", DoubleType(), True),
)

DOWNTIME = _struct(
    ("downtime_id", StringType(), False),
    ("machine_id", StringType(), False),
    ("production_date", StringType(), False),
    ("shift_id", StringType(), False),
    ("downtime_reason", StringType(), True),
    ("downtime_minutes", DoubleType(), True),
    ("is_planned", StringType(), True),
)

QUALITY = _struct(
    ("inspection_id", StringType(), False),
    ("machine_id", StringType(), False),
    ("product_id", StringType(), False),
    ("production_date", StringType(), False),
    ("shift_id", StringType(), False),
    ("inspected_qty", IntegerType(), True),
    ("defect_qty", IntegerType(), True),
    ("defect_category", StringType(), True),
)

RAW_SCHEMAS = {"production": PRODUCTION, "downtime": DOWNTIME, "quality": QUALITY}
RAW_KEYS = {"production": "production_id", "downtime": "downtime_id", "quality": "inspection_id"}

# ── processed zone (lake) ────────────────────────────────────────────────────
# The 25 fact columns in output order.
FACT_COLUMNS = [
    "production_id",
    "plant_id", "line_id", "machine_id",
    "shift_id", "product_id",
    "production_date", "year", "month",
    "planned_qty", "actual_qty", "good_qty",
    "planned_runtime_min", "actual_runtime_min",
    "total_downtime_min", "planned_downtime_min", "unplanned_downtime_min",
    "downtime_events",
    "total_inspected_qty", "total_defect_qty",
    "first_pass_yield",
    "availability", "performance", "quality_rate", "oee_pct",
]

# Their types, so that a lake without rows (and so without files) can be read.
LAKE_FACT = ", ".join(f"{c} {kind}" for c, kind in zip(FACT_COLUMNS, [
    *["string"] * 6, "date", *["int"] * 5, *["double"] * 5, *["bigint"] * 3, *["double"] * 5]))

LAKE_DIMS = {
    "dim_machine": "machine_id string, line_id string, plant_id string, machine_name string, line_name string, "
                   "plant_name string, machine_type string, is_active boolean",
    "dim_shift": "shift_id string, shift_name string, shift_start string, shift_hours int",
    "dim_product": "product_id string, product_name string, product_family string, unit_of_measure string",
    "dim_date": "date_key date, year int, quarter int, month int, month_name string, week int, day_of_week int, "
                "day_name string, is_weekend boolean",
}

# ── warehouse (star schema) ──────────────────────────────────────────────────
MINUTES = DecimalType(10, 2)
PERCENT = DecimalType(6, 2)

DIM_DATE = _struct(
    ("date_key", DateType(), False),
    ("year", ShortType(), False),
    ("quarter", ShortType(), False),
    ("month", ShortType(), False),
    ("month_name", StringType(), False),
    ("week", ShortType(), False),
    ("day_of_week", ShortType(), False),
    ("day_name", StringType(), False),
    ("is_weekend", BooleanType(), False),
)

DIM_MACHINE = _struct(
    ("machine_key", IntegerType(), False),
    ("machine_id", StringType(), False),
    ("machine_name", StringType(), True),
    ("machine_type", StringType(), True),
    ("is_active", BooleanType(), False),
    ("line_id", StringType(), False),
    ("line_name", StringType(), True),
    ("plant_id", StringType(), False),
    ("plant_name", StringType(), True),
    ("plant_location", StringType(), True),
    ("created_at", TimestampType(), True),
    ("updated_at", TimestampType(), True),
)

DIM_SHIFT = _struct(
    ("shift_key", IntegerType(), False),
    ("shift_id", StringType(), False),
    ("shift_name", StringType(), False),
    ("shift_start", StringType(), True),
    ("shift_hours", ShortType(), True),
)

DIM_PRODUCT = _struct(
    ("product_key", IntegerType(), False),
    ("product_id", StringType(), False),
    ("product_name", StringType(), True),
    ("product_family", StringType(), True),
    ("unit_of_measure", StringType(), True),
)

FACT_PRODUCTION = _struct(
    ("production_sk", LongType(), False),
    ("production_id", StringType(), False),
    ("date_key", DateType(), False),
    ("machine_key", IntegerType(), False),
    ("shift_key", IntegerType(), False),
    ("product_key", IntegerType(), False),
    ("planned_qty", IntegerType(), True),
    ("actual_qty", IntegerType(), True),
    ("good_qty", IntegerType(), True),
    ("planned_runtime_min", MINUTES, True),
    ("actual_runtime_min", MINUTES, True),
    ("total_downtime_min", MINUTES, True),
    ("planned_downtime_min", MINUTES, True),
    ("unplanned_downtime_min", MINUTES, True),
    ("downtime_events", ShortType(), True),
    ("total_inspected_qty", IntegerType(), True),
    ("total_defect_qty", IntegerType(), True),
    ("first_pass_yield", PERCENT, True),
    ("availability", PERCENT, True),
    ("performance", PERCENT, True),
    ("quality_rate", PERCENT, True),
    ("oee_pct", PERCENT, True),
    ("loaded_at", TimestampType(), True),
)

WAREHOUSE_SCHEMAS = {
    "dim_date": DIM_DATE,
    "dim_machine": DIM_MACHINE,
    "dim_shift": DIM_SHIFT,
    "dim_product": DIM_PRODUCT,
    "fact_production": FACT_PRODUCTION,
}

# Text lengths of the warehouse columns (others are unbounded) and column defaults.
TEXT_LENGTHS = {
    "dim_date": {"month_name": 10, "day_name": 10},
    "dim_machine": {"machine_id": 50, "machine_name": 100, "machine_type": 50, "line_id": 50, "line_name": 100,
                    "plant_id": 50, "plant_name": 100, "plant_location": 200},
    "dim_shift": {"shift_id": 10, "shift_name": 50, "shift_start": 5},
    "dim_product": {"product_id": 50, "product_name": 200, "product_family": 100, "unit_of_measure": 20},
    "fact_production": {"production_id": 100},
}
COLUMN_DEFAULTS = {
    "dim_date": {"is_weekend": "false"},
    "dim_machine": {"is_active": "true", "created_at": "current_timestamp()", "updated_at": "current_timestamp()"},
    "dim_product": {"unit_of_measure": "'PCS'"},
    "fact_production": {"total_downtime_min": "0", "planned_downtime_min": "0", "unplanned_downtime_min": "0",
                        "downtime_events": "0", "total_inspected_qty": "0", "total_defect_qty": "0",
                        "loaded_at": "current_timestamp()"},
}

"""Raw production / downtime / quality tables derived from the shared test tables.

The benchmark and correctness data are TPC-H-like parquet tables; the three
raw tables of the plant model are projections of ``lineitem`` and ``events``.
The mapping is a pure projection of every row, so the scans keep column
pruning.  Machines, products and dates come from the tables' own keys and dates:
their numbers grow with the scale, and runs span seven years.

Fixed values: the modulus constants, offsets and labels below define the
mapping and must stay exactly as they are so every engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schemas

# Fixed values of the mapping.  Events lie in one month; they are moved back by
# a number of days from their id, so that downtime spreads over the runs' years.
EVENT_SHIFT_DAYS, EVENT_SPREAD_DAYS = 8100, 2500
BAD_DATE_EVERY = 97
BAD_DATE_TEXT = "bad-date"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col: Column) -> Column:
    return col.cast("string")


def _run_date(orderkey: Column) -> Column:
    day = F.col("l_shipdate").cast("date")
    return F.when(orderkey % BAD_DATE_EVERY == 0, F.lit(BAD_DATE_TEXT)).otherwise(_s(day))


def _pct_int(col: Column) -> Column:
    return F.round(col * 100).cast("int")


def raw_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    qty10 = F.col("l_quantity").cast("int") * 10
    return li.select(
        F.concat(F.lit("P"), _s(ok), F.lit("-"), _s(ln)).alias("production_id"),
        F.concat(F.lit("PLT"), _s(F.floor(sk / 40))).alias("plant_id"),
        F.concat(F.lit("L"), _s(F.floor(sk / 8))).alias("line_id"),
        F.concat(F.lit("M"), _s(sk)).alias("machine_id"),
        F.concat(F.lit("S"), _s(ln % 4)).alias("shift_id"),
        F.concat(F.lit("PRD"), _s(pk)).alias("product_id"),
        _run_date(ok).alias("production_date"),
        F.when(pk % 53 == 0, F.lit(0)).otherwise(qty10).alias("planned_qty"),
        F.when(pk % 59 == 0, F.lit(-5))
        .otherwise(qty10 + 3 - _pct_int(F.col("l_discount")))
        .alias("actual_qty"),
        F.when(pk % 61 == 0, F.lit(None).cast("int"))
        .otherwise(qty10 + 1 - _pct_int(F.col("l_discount")) - _pct_int(F.col("l_tax")))
        .alias("good_qty"),
        F.when(pk % 67 == 0, F.lit(None).cast("double")).otherwise(F.lit(480.0)).alias("planned_runtime_min"),
        (F.lit(480) - ln).cast("double").alias("actual_runtime_min"),
    )


def raw_downtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    hour = F.hour("ts")
    et = F.col("event_type")
    return ev.select(
        F.concat(F.lit("D"), _s(F.col("event_id"))).alias("downtime_id"),
        F.concat(F.lit("M"), _s(F.col("user_id"))).alias("machine_id"),
        _s(F.date_sub(F.col("ts").cast("date"), (F.col("event_id") % EVENT_SPREAD_DAYS + EVENT_SHIFT_DAYS).cast("int"))
           ).alias("production_date"),
        F.when((hour >= 6) & (hour < 14), F.lit("S1"))
        .when((hour >= 14) & (hour < 22), F.lit("S2"))
        .otherwise(F.lit("S3"))
        .alias("shift_id"),
        et.alias("downtime_reason"),
        (F.col("value") - 2).alias("downtime_minutes"),
        F.when(et == "view", F.lit("Y"))
        .when(et == "click", F.lit("y"))
        .when(et == "error", F.lit("N"))
        .otherwise(F.lit(None).cast("string"))
        .alias("is_planned"),
    )


def raw_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return li.select(
        F.concat(F.lit("Q"), _s(ok), F.lit("-"), _s(ln)).alias("inspection_id"),
        F.concat(F.lit("M"), _s(sk)).alias("machine_id"),
        F.concat(F.lit("PRD"), _s(pk)).alias("product_id"),
        _run_date(ok).alias("production_date"),
        F.concat(F.lit("S"), _s(ln % 4)).alias("shift_id"),
        F.when(pk % 71 == 0, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("inspected_qty"),
        F.when(pk % 73 == 0, F.lit(None).cast("int"))
        .otherwise(_pct_int(F.col("l_tax")) * 3)
        .alias("defect_qty"),
        F.col("l_linestatus").alias("defect_category"),
    )


_MAPPINGS = {"production": raw_production, "downtime": raw_downtime, "quality": raw_quality}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table, cast to its declared raw schema."""
    return conform(_MAPPINGS[name](spark, sf_dir), schemas.RAW_SCHEMAS[name])


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw tables, cast to the declared raw schemas."""
    return {name: raw_table(spark, sf_dir, name) for name in _MAPPINGS}


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast to ``schema`` by column name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

"""Downtime and inspection rollups to the grain the fact joins on.

Both are plain ``groupBy().agg()``: Spark plans partial (map-side) and final
aggregation around one shuffle on the group keys, so a hot machine/shift is
pre-reduced on every map task before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions import round2, sum_exact

DOWNTIME_GRAIN = ["machine_id", "production_date", "shift_id"]
QUALITY_GRAIN = ["machine_id", "product_id", "production_date", "shift_id"]


def agg_downtime(downtime: DataFrame) -> DataFrame:
    minutes = F.col("downtime_minutes")
    planned = F.col("is_planned_flag")
    return downtime.groupBy(*DOWNTIME_GRAIN).agg(
        sum_exact(minutes).alias("total_downtime_min"),
        sum_exact(F.when(planned, minutes).otherwise(F.lit(0.0))).alias("planned_downtime_min"),
        sum_exact(F.when(~planned, minutes).otherwise(F.lit(0.0))).alias("unplanned_downtime_min"),
        F.count("downtime_id").alias("downtime_events"),
    )


def first_pass_yield(inspected, defects):
    """(inspected − defects) / inspected × 100, rounded to 2; NULL when nothing was inspected."""
    return round2(F.try_divide(inspected - defects, inspected) * 100)


def agg_quality(quality: DataFrame) -> DataFrame:
    totals = quality.groupBy(*QUALITY_GRAIN).agg(
        F.sum("inspected_qty").alias("total_inspected_qty"),
        F.sum("defect_qty").alias("total_defect_qty"),
    )
    return totals.withColumn(
        "first_pass_yield", first_pass_yield(F.col("total_inspected_qty"), F.col("total_defect_qty"))
    )

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from shopfloor.functions import round2, sum_exact
from shopfloor.operators import aggregate, clean, fact

OEE_ROW = StructType([
    StructField("planned_runtime_min", DoubleType(), True),
    StructField("unplanned_downtime_min", DoubleType(), True),
    StructField("planned_qty", IntegerType(), True),
    StructField("actual_qty", IntegerType(), True),
    StructField("good_qty", IntegerType(), True),
])


def _oee(spark, *row):
    return fact.oee(spark.createDataFrame([row], OEE_ROW)).first()


def test_downtime_of_one_shift_is_split_by_plan(downtime_df):
    rows = {(r.machine_id, str(r.production_date), r.shift_id): r
            for r in aggregate.agg_downtime(clean.clean_downtime(downtime_df)).collect()}
    r = rows[("mx-2", "2023-12-31", "S3")]
    assert (r.total_downtime_min, r.planned_downtime_min, r.unplanned_downtime_min, r.downtime_events) == (50.0, 37.5, 12.5, 2)
    assert rows[("ov-9", "2024-02-29", "S1")].downtime_events == 2  # the event of no minutes counts
    assert len(rows) == 4


@pytest.mark.parametrize("row, want", [
    ((200.0, 0.0, 64, 64, 64), (100.0, 100.0, 100.0, 100.0)),
    ((200.0, 50.0, 64, 48, 36), (75.0, 75.0, 75.0, 42.19)),
    ((200.0, 200.0, 64, 64, 64), (0.0, 100.0, 100.0, 0.0)),
    ((200.0, 20.0, 0, 9, 9), (90.0, 0.0, 100.0, 0.0)),
    ((0.0, 0.0, 10, 10, 5), (0.0, 100.0, 50.0, 0.0)),
])
def test_ratios(spark, row, want):
    r = _oee(spark, *row)
    assert (r.availability, r.performance, r.quality_rate, r.oee_pct) == pytest.approx(want)


def test_oee_uses_unclamped_ratios(spark):
    # performance 1.2 is published as 100, but the product uses 1.2
    r = _oee(spark, 480.0, 0.0, 100, 120, 60)
    assert r.performance == 100.0 and r.quality_rate == 50.0 and r.oee_pct == 60.0


def test_null_inputs_clamp_to_zero(spark):
    r = _oee(spark, None, 0.0, 100, None, 5)
    assert (r.availability, r.performance, r.quality_rate, r.oee_pct) == (0.0, 0.0, 0.0, 0.0)


def test_first_pass_yield(quality_df):
    rows = {r.machine_id: r for r in aggregate.agg_quality(clean.clean_quality(quality_df)).collect()}
    assert (rows["mx-2"].total_inspected_qty, rows["mx-2"].first_pass_yield) == (200, 97.5)
    assert rows["ov-9"].first_pass_yield == 0.0
    assert rows["lt-1"].first_pass_yield is None  # nothing inspected


def test_fact_one_row_per_run_and_invariants(production_df, downtime_df, quality_df):
    p = clean.clean_production(production_df)
    out = fact.fact_production(
        p, aggregate.agg_downtime(clean.clean_downtime(downtime_df)),
        aggregate.agg_quality(clean.clean_quality(quality_df)),
    )
    assert out.count() == p.count() == 5
    assert out.filter(F.abs(F.col("planned_downtime_min") + F.col("unplanned_downtime_min")
                            - F.col("total_downtime_min")) > 1e-9).count() == 0
    for m in ["availability", "performance", "quality_rate", "oee_pct"]:
        assert out.filter((F.col(m) < 0) | (F.col(m) > 100)).count() == 0
    rows = {r.production_id: r for r in out.collect()}
    r = rows["w7-a"]
    assert (r.downtime_events, r.total_inspected_qty, r.year, r.month) == (2, 200, 2023, 12)
    assert (rows["W7-a"].year, rows["W7-a"].month, rows["W7-a"].total_inspected_qty) == (2024, 1, 0)
    assert rows["w7-a "].downtime_events is None and rows["w7-a "].first_pass_yield is None


def test_sums_and_rounding_keep_what_does_not_fit(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, inf), (1, 1.0), (1, 2e18), (2, 0.1), (2, 0.2), (3, 2e18), (3, -5.0)], "k int, x double")
    got = {r.k: r.s for r in df.groupBy("k").agg(sum_exact(F.col("x")).alias("s")).collect()}
    assert got == {1: inf, 2: 0.3, 3: 2e18 - 5.0}
    values = [inf, -inf, 1e30, 12.345, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    assert [r.r for r in df.select("i", round2(F.col("x")).alias("r")).orderBy("i").collect()] == [
        inf, -inf, 1e30, 12.35, None, None]

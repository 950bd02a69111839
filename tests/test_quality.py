from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import nullable
from shopfloor import schemas
from shopfloor.operators import quality as dq


def _by_check(results):
    return {(r.check_name, r.column_name): r for r in results.collect()}


def test_production_suite_one_pass(production_df):
    res = _by_check(dq.run_suite(production_df, "production", dq.production_suite()))
    assert res[("not_empty", None)].passed
    assert res[("duplicates", "production_id")].failed_count == 1
    assert not res[("duplicates", "production_id")].passed
    assert res[("duplicates", "production_id")].message == \
        "[production] 1 duplicate rows on keys ['production_id']."
    assert res[("value_range", "planned_qty")].failed_count == 1
    assert res[("value_range", "planned_qty")].message == \
        "[production] Column 'planned_qty' has 1 rows outside expected range (>= 0)."
    assert res[("date_format", "production_date")].passed


def test_duplicates_treat_null_keys_as_equal(spark):
    rows = [("a", None), ("a", None), ("b", 1), ("b", 1)]
    df = spark.createDataFrame(rows, "k string, v int")
    r = dq.run_suite(df, "t", [dq.duplicates(["k", "v"])]).first()
    assert r.failed_count == 2


def test_enforce_raises_on_critical(spark):
    rows = [("P1", "PLT1", "L1", None, "S1", "PRD1", "2024-01-15", 1, 1, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, nullable(schemas.PRODUCTION))
    res = dq.run_suite(df, "production", dq.production_suite())
    with pytest.raises(dq.DataQualityError, match="Column 'machine_id' has 1 NULL values"):
        dq.enforce(res)
    # gate on other checks only → no raise, warnings returned
    dq.enforce(res, gate={"duplicates"})


def test_not_empty_on_empty_table(spark):
    res = dq.run_suite(spark.createDataFrame([], schemas.DOWNTIME), "downtime", dq.downtime_suite()).collect()
    first = [r for r in res if r.check_name == "not_empty"][0]
    assert first.failed_count == 1 and not first.passed and first.message == "[downtime] DataFrame is empty."
    ratio = [r for r in res if r.check_name == "null_ratio"][0]
    assert ratio.ratio == 0.0 and ratio.passed


def test_null_ratio_and_range_bounds(spark, downtime_df):
    df = downtime_df.withColumn("downtime_reason", F.when(F.col("downtime_id") == "stop1", None)
                                .otherwise(F.col("downtime_reason")))
    res = _by_check(dq.run_suite(df, "downtime", dq.downtime_suite()))
    nr = res[("null_ratio", "downtime_reason")]
    assert nr.ratio == pytest.approx(1 / 6) and not nr.passed
    assert nr.message == "[downtime] Column 'downtime_reason' NULL ratio 16.7% exceeds threshold 10.0%."
    assert res[("value_range", "downtime_minutes")].failed_count == 1  # -6 < 0 (bounds inclusive)


def test_fact_suite_skips_absent_metrics(spark):
    df = spark.createDataFrame([("P1", "M1", "2024-01-15", 150.0)], "production_id string, machine_id string, "
                               "production_date string, oee_pct double")
    res = _by_check(dq.run_suite(df, "fact_production", dq.fact_suite(df.columns)))
    assert ("oee_bounds", "availability") not in res
    assert res[("oee_bounds", "oee_pct")].failed_count == 1


def test_config_adds_duplicate_ratio(production_df):
    res = _by_check(dq.run_suite(production_df, "production", dq.production_suite(dq.PROD)))
    r = res[("duplicate_ratio", "production_id")]
    assert r.ratio == pytest.approx(1 / 6) and r.threshold == 0.001 and not r.passed and r.severity == "warning"

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import aggregate, clean, dims, fact, views
from shopfloor.operators.ordered import dense_key, running_sum
from shopfloor.plans import load
from shopfloor.sources import testdata
from conftest import SF_SMALL


def _warehouse(spark, production_df, downtime_df, quality_df):
    p = clean.clean_production(production_df)
    f = fact.fact_production(p, aggregate.agg_downtime(clean.clean_downtime(downtime_df)),
                             aggregate.agg_quality(clean.clean_quality(quality_df)))
    return load.load(spark, f, dims.all_dims(f))


def test_dim_shift_names_and_unknown(spark):
    df = spark.createDataFrame([("S1",), ("S3",), ("S9",)], "shift_id string")
    got = {r.shift_id: (r.shift_name, r.shift_start, r.shift_hours) for r in dims.dim_shift(df).collect()}
    assert got["S1"] == ("Morning (06:00–14:00)", "06:00", 8)
    assert got["S9"] == ("Unknown", "22:00", 8)


def test_dim_date_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 1, 6),), (None,)], "production_date date")
    got = {r.date_key: r for r in dims.dim_date(df).collect()}
    d = got[dt.date(2024, 12, 30)]
    assert (d.year, d.quarter, d.month, d.week, d.day_of_week, d.month_name, d.day_name, d.is_weekend) == \
        (2024, 4, 12, 1, 2, "December", "Monday", False)
    assert got[dt.date(2024, 1, 6)].is_weekend is True
    assert got[None].is_weekend is False


def test_pareto_cumulative_reaches_100(spark, production_df, downtime_df, quality_df):
    w = _warehouse(spark, production_df, downtime_df, quality_df)
    rows = views.downtime_pareto(w["fact_production"], w["dim_machine"]).collect()
    assert rows[-1].cumulative_pct == 100.0
    assert [r.total_unplanned_min for r in rows] == sorted([r.total_unplanned_min for r in rows], reverse=True)
    assert sum(r.pct_of_total for r in rows) == pytest.approx(100.0, abs=0.05)


def test_views_on_fixture(spark, production_df, downtime_df, quality_df):
    w = _warehouse(spark, production_df, downtime_df, quality_df)
    daily = views.daily_oee(w["fact_production"], w["dim_date"], w["dim_machine"], w["dim_shift"])
    m1 = daily.filter("machine_id = 'mx-2' AND date_key = date'2023-12-31'").first()
    assert m1.total_downtime_min == 50.0 and m1.total_unplanned_downtime_min == 12.5
    assert m1.avg_first_pass_yield_pct == pytest.approx(97.5)
    monthly = views.monthly_summary(w["fact_production"], w["dim_date"], w["dim_machine"], w["dim_product"])
    got = {(r.year, r.month): r.attainment_pct for r in monthly.collect() if r.machine_name == "Machine-mx-2"}
    assert got == {(2023, 12): 96.0, (2024, 1): 102.0}
    shift = views.shift_performance(w["fact_production"], w["dim_shift"], w["dim_machine"])
    assert shift.agg(F.sum("shift_count")).first()[0] == 5
    drill = {(r.plant_id, r.line_id, r.machine_id): r for r in
             views.drilldown(w["fact_production"], w["dim_machine"]).collect()}
    assert drill[(None, None, None)].run_count == 5 and drill[(None, None, None)].drill_level == "all"
    assert drill[("south", "oven", None)].drill_level == "line" and drill[("south", None, None)].run_count == 2


def test_dense_key_matches_row_number(spark):
    df = testdata.raw_tables(spark, SF_SMALL)["production"].select("production_id").distinct()
    keyed = dense_key(df, "k", "production_id", start=10, num_partitions=4)
    got = sorted((r.production_id, r.k) for r in keyed.collect())
    ids = sorted(r.production_id for r in df.collect())
    assert got == [(pid, 11 + i) for i, pid in enumerate(ids)]


def test_running_sum_matches_brute_force(spark):
    df = testdata.raw_tables(spark, SF_SMALL)["downtime"].select("downtime_id", "downtime_minutes")
    df = df.filter(F.col("downtime_minutes").isNotNull())
    order = [F.col("downtime_minutes").desc(), F.col("downtime_id").asc()]
    out = running_sum(df, "downtime_minutes", order, "cum", num_partitions=4).collect()
    rows = sorted(((r.downtime_minutes, r.downtime_id) for r in df.collect()), key=lambda t: (-t[0], t[1]))
    expected, acc = {}, 0.0
    from decimal import Decimal

    acc = Decimal(0)
    for m, i in rows:
        acc += Decimal(str(round(m, 2)))
        expected[i] = acc
    assert {r.downtime_id: r.cum for r in out} == expected


def test_range_partition_count_follows_rows(spark):
    from shopfloor.operators import ordered

    assert ordered._partitions(None, 0) == 1
    assert ordered._partitions(None, 1_000) == 1
    assert ordered._partitions(None, 50_000 * ordered.ROWS_PER_PARTITION) == 50_000  # no upper limit
    assert ordered._partitions(7, 1) == 7

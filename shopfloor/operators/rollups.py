"""Additive partials of the warehouse fact, from which the views are merged.

A partial holds, for the runs of one month that share its keys, the number of runs
and of each measure its sum and the number of its values.  Sums and numbers add up
over any set of months, and a mean is one sum divided by one number, so a view of
partials equals the view of the facts, digit by digit: sums of DECIMALs are exact
and are divided in the type that a sum over facts has.

Two grains serve all views: date, machine and shift (daily, Pareto, shifts,
drilldown), and machine and product within a month (monthly).  The latter keeps one
date of its runs, which names the month in the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StructField, StructType

from shopfloor import schemas
from shopfloor.operators import layout, views

KEYS = {"rollup_shift": ["date_key", "machine_key", "shift_key"], "rollup_product": ["machine_key", "product_key"]}
MEASURES = [f.name for f in schemas.FACT_PRODUCTION.fields
            if f.name not in ("production_sk", "production_id", "date_key", "machine_key", "shift_key", "product_key", "loaded_at")]


def _sum_type(column: str):
    """Spark's type of a sum over the fact's column."""
    kind = schemas.FACT_PRODUCTION[column].dataType
    return DecimalType(min(kind.precision + 10, 38), kind.scale) if isinstance(kind, DecimalType) else LongType()


def _schema(name: str) -> StructType:
    keys = [StructField(k, schemas.FACT_PRODUCTION[k].dataType) for k in KEYS[name]]
    date = [] if "date_key" in KEYS[name] else [StructField("date_key", DateType())]
    values = [StructField(n, t) for c in MEASURES for n, t in ((c, _sum_type(c)), (f"n_{c}", LongType()))]
    return StructType([*keys, *date, StructField("runs", LongType()), *values])


SCHEMAS = {name: _schema(name) for name in KEYS}


def partials(fact: DataFrame, name: str, placed: bool = False) -> DataFrame:
    """One row for each month and keys of the grain, with ``month_key`` to write it by.

    The facts are range-partitioned by time and machine, a part of the grain's keys:
    this one shuffle serves the aggregate and leaves few months in a partition, and a
    hot month or day lies in as many partitions as its machines need.  ``placed`` says that
    ``fact`` is a persisted ``layout.placed_fact``: it is not shuffled again.
    """
    date = [] if "date_key" in KEYS[name] else [F.min("date_key").alias("date_key")]
    values = [v for c in MEASURES for v in (F.sum(c).alias(c), F.count(c).alias(f"n_{c}"))]
    if not placed:
        fact = layout.with_month(fact).select("month_key", *dict.fromkeys(["date_key", *KEYS[name], *MEASURES]))
        fact = fact.repartitionByRange("date_key" if "date_key" in KEYS[name] else "month_key", "machine_key")
    made = fact.groupBy("month_key", *KEYS[name]).agg(*date, F.count(F.lit(1)).alias("runs"), *values)
    return made.select(*SCHEMAS[name].names, "month_key")


class Partials:
    """Measures over partials, aliased ``f``; see ``views.Runs``."""

    @staticmethod
    def total(column: str):
        return F.sum(f"f.{column}").cast(_sum_type(column))

    @staticmethod
    def number(column: str):
        return F.sum(f"f.n_{column}")

    @staticmethod
    def runs():
        return F.sum("f.runs")

    @staticmethod
    def mean(column: str):
        return F.round(F.try_divide(Partials.total(column), Partials.number(column)), 6).cast("double")


VIEWS = {
    "vw_daily_oee": lambda w: views.daily_oee(w["rollup_shift"], w["dim_date"], w["dim_machine"], w["dim_shift"], Partials),
    "vw_monthly_summary": lambda w: views.monthly_summary(w["rollup_product"], w["dim_date"], w["dim_machine"],
                                                          w["dim_product"], Partials),
    "vw_downtime_pareto": lambda w: views.downtime_pareto(w["rollup_shift"], w["dim_machine"]),
    "vw_shift_performance": lambda w: views.shift_performance(w["rollup_shift"], w["dim_shift"], w["dim_machine"], Partials),
    "drilldown": lambda w: views.drilldown(w["rollup_shift"], w["dim_machine"], Partials),
}

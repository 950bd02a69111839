"""Batch ETL: raw zone → cleaned → fact + dimensions → processed zone.

Execution plan (one run):

1. scan the three raw tables (explicit schemas): once for the suites, once for
   the fact;
2. raw data-quality suites — one aggregation job per table, report only;
3. clean, roll up, join, compute OEE — one lazy plan;
4. write the fact as Parquet into the shared folder: it cuts the lineage (a
   lost executor re-reads files instead of re-running dedup and joins), and the
   suite, the dimensions and the sinks read only their columns of it;
5. fact suite on the materialised fact, enforced by a gate;
6. dimensions from the materialised fact (fact rows = cleaned production rows,
   so every member is there), each a map-side-combined ``distinct``;
7. sinks: fact partitioned by (year, month) with the row count observed
   during the write, dimensions unpartitioned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shopfloor.operators import aggregate, clean, dims, fact, quality
from shopfloor.plans import lake as published
from shopfloor.sources import quarantine as raw_quarantine
from shopfloor.sources import raw as raw_sources
from shopfloor.sources import sinks

# Critical fact checks that stop a run by default; "strict" raises on all.
# Runs with an unparseable date stay in the lake (NULL date) and are split
# off as rejects by the warehouse load, so a NULL production_date does not
# stop the job by default.
DEFAULT_GATE = {"not_empty", "null_keys:production_id", "null_keys:machine_id", "duplicates"}


@dataclass
class Lake:
    fact: DataFrame
    dims: dict[str, DataFrame]
    raw_quality: DataFrame | None
    fact_quality: DataFrame | None


materialize, discard = sinks.stage, sinks.discard


def build_fact(raw: dict[str, DataFrame]) -> DataFrame:
    production = clean.clean_production(raw["production"])
    downtime = aggregate.agg_downtime(clean.clean_downtime(raw["downtime"]))
    inspections = aggregate.agg_quality(clean.clean_quality(raw["quality"]))
    return fact.fact_production(production, downtime, inspections)


def build_lake(
    raw: dict[str, DataFrame],
    config: quality.SuiteConfig | None = None,
    enforce: str = "default",
    check_raw: bool = True,
) -> Lake:
    """Steps 2–6.  ``enforce``: "default" (gate on not_empty / null keys /
    duplicates of the fact, NULL-date rows reported as rejects by the load),
    "strict" (every failed critical check raises) or "off"."""
    raw_results = None
    if check_raw:
        # Report-only by default: one aggregation job per raw table, failures
        # logged; "strict" raises on any failed critical check.
        raw_results = quality.run_suites(raw, config)
        quality.enforce(raw_results, gate=None if enforce == "strict" else set())
    fact_df = materialize(build_fact(raw))
    fact_results = quality.run_suite(fact_df, "fact_production", quality.fact_suite(fact_df.columns, config))
    if enforce != "off":
        quality.enforce(fact_results, gate=None if enforce == "strict" else DEFAULT_GATE)
    return Lake(fact_df, dims.all_dims(fact_df), raw_results, fact_results)


def write_lake(lake: Lake, processed_base: str) -> int:
    base = processed_base.rstrip("/")
    rows = sinks.write_fact(lake.fact, f"{base}/fact_production")
    sinks.write_dims(lake.dims, base)
    return rows


def run(
    spark: SparkSession,
    raw_base: str,
    processed_base: str,
    fmt: str = "csv",
    config: quality.SuiteConfig | None = None,
    enforce: str = "default",
    incremental: bool = False,
    quarantine: str | None = None,
) -> dict:
    """The whole job; returns the number of facts written and the quality results.

    With ``quarantine``, a new folder of the shared file system, text is parsed
    once into it: damaged records stay there and take no part, their numbers are
    returned as ``damaged``.  Without it, values that do not fit become NULL.

    ``incremental=True`` brings the published zone under ``processed_base`` up to
    date with the records of ``raw_base`` (see :mod:`shopfloor.plans.lake`); the first
    such run makes it.  Otherwise plain folders are written and replaced.
    """
    damaged = {}
    if quarantine:
        parts = raw_quarantine.split_zone(spark, raw_base, quarantine, fmt)
        raw = {name: part.kept for name, part in parts.items()}
        damaged = {"damaged": {name: part.damaged.count() for name, part in parts.items()}}
    else:
        raw = raw_sources.read_raw_zone(spark, raw_base, fmt)
    if incremental:
        if not published.manifest.manifests(spark, processed_base) and sinks.exists(spark, f"{processed_base}/fact_production"):
            raise ValueError(f"{processed_base} holds plain folders without the raw records that a batch is merged with")
        raw_results = quality.run_suites(raw, config)
        raw_results = spark.createDataFrame(raw_results.collect(), raw_results.schema)  # a row per check
        quality.enforce(raw_results, gate=None if enforce == "strict" else set())
        gate = {"strict": None, "off": set()}.get(enforce, DEFAULT_GATE)
        made = published.update(spark, raw, processed_base, config, gate)
        return {"fact_rows": made["fact_rows"], "raw_quality": raw_results, "fact_quality": made["fact_quality"], **damaged}
    lake = build_lake(raw, config, enforce)
    rows = write_lake(lake, processed_base)
    checks = {name: spark.createDataFrame(df.collect(), df.schema)  # a row per check; no later reader scans again
              for name, df in (("raw_quality", lake.raw_quality), ("fact_quality", lake.fact_quality))}
    discard(lake.fact)
    return {"fact_rows": rows, **checks, **damaged}

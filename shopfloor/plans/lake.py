"""Published lake zone, kept up to date by batches of raw records.

A batch may hold new runs, runs sent again, and downtime or inspections that
arrive long after their run.  Changes propagate by month: both rollups join a run
on its date, so a month's facts follow from that month's raw records alone.

One update:

1. the batch's records are deduplicated by id; they replace the kept record of the
   same id, whichever month that is in.  Only the ids meet: the records that go are
   marked by their places in the files (:mod:`shopfloor.operators.places`);
2. a month is touched if it gets a record or loses one.  Of each raw table only its
   touched months are written again, from the kept records and the batch;
3. the facts of all touched months are computed again from the kept records, of
   which no other month is read, into new folders; the checks read these, and a
   gate that fails leaves them unlisted;
4. members (machines with their lines and plants, shifts, products, dates) are
   kept by month beside the facts; the dimensions are merged from the members of
   all months, a few rows each, so a member lives as long as any run has it;
5. one manifest publishes records, facts, members and dimensions together.

After any sequence of updates the zone equals one run over the newest version of
every record.  A crash leaves the previous manifest in force.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.functions import parse_date
from shopfloor.operators import aggregate, clean, dims, fact, places, quality
from shopfloor.operators.joins import rebalanced
from shopfloor.sources import manifest, sinks
from shopfloor.sources.manifest import MONTH, month_of

DIMS = ["dim_date", "dim_machine", "dim_shift", "dim_product"]
FACT, MEMBERS, KEPT = "fact_production", "members", "kept_"
MEMBER_KEYS = {
    "dim_machine": ["machine_id", "line_id", "plant_id"],
    "dim_shift": ["shift_id"],
    "dim_product": ["product_id"],
    "dim_date": ["production_date"],
}
MEMBERS_SCHEMA = "dim string, machine_id string, line_id string, plant_id string, shift_id string, product_id string, production_date date"
DEDUP = {"production": clean.dedup_production, "downtime": clean.dedup_downtime, "quality": clean.dedup_quality}
GENERATION = "generation"  # manifest row; its part names the zone from its first batch on, and changes if it is replaced
TABLES = [FACT, MEMBERS, *DIMS, *[KEPT + n for n in schemas.RAW_SCHEMAS]]


def kept_schema(name: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_SCHEMAS[name].fields)


def dim_schema(name: str) -> str:
    return schemas.LAKE_DIMS[name]


def members(facts: DataFrame) -> DataFrame:
    """The distinct members of each dimension in each month of the facts."""
    columns = [c for keys in MEMBER_KEYS.values() for c in keys]
    parts = [facts.select(MONTH, *keys).distinct().select(
        F.lit(name).alias("dim"), *[F.col(c) if c in keys else F.lit(None).cast(facts.schema[c].dataType).alias(c)
                                    for c in columns], MONTH) for name, keys in MEMBER_KEYS.items()]
    return reduce(DataFrame.unionByName, parts)


def dims_of(kept: DataFrame) -> dict[str, DataFrame]:
    """The dimensions of all months' members."""
    made = {"dim_machine": dims.dim_machine, "dim_shift": dims.dim_shift, "dim_product": dims.dim_product,
            "dim_date": dims.dim_date}
    return {name: made[name](kept.where(F.col("dim") == name).select(*keys)) for name, keys in MEMBER_KEYS.items()}


def read_manifest(spark: SparkSession, base: str) -> list[tuple] | None:
    return manifest.read_rows(spark, base, DIMS)


def read(spark: SparkSession, base: str, table: str, months: set[str] | None = None) -> DataFrame:
    """A fact, dimension, kept raw table or the members of the published zone."""
    rows = read_manifest(spark, base)
    if rows is None:
        raise FileNotFoundError(f"no published lake under {base}")
    return read_rows(spark, rows, table, months)


def read_rows(spark: SparkSession, rows: list[tuple], table: str, months: set[str] | None = None) -> DataFrame:
    schema = (schemas.LAKE_FACT if table == FACT else MEMBERS_SCHEMA if table == MEMBERS
              else kept_schema(table[len(KEPT):]) if table.startswith(KEPT) else dim_schema(table))
    return manifest.read_part(spark, rows, table, schema, months)


def months_within(rows: list[tuple], start: str | None, end: str | None) -> set[str]:
    """Months of the published fact that [start, end] can meet; undated rows only where nothing is asked."""
    found = {part for t, part, _ in rows if t == FACT}
    if start is None and end is None:
        return found
    low, high = ((d or "").replace("-", "")[:6] for d in (start, end))
    return {m for m in found if m.isdigit() and (not low or m >= low) and (not high or m <= high)}


def update(spark: SparkSession, raw: dict[str, DataFrame], base: str, config: quality.SuiteConfig | None = None,
           gate: set[str] | None = frozenset(), replace: bool = False) -> dict:
    """Bring the zone under ``base`` up to date with a batch of raw records.

    ``replace=True`` publishes the batch as the whole zone.  ``gate`` names the
    critical checks of the recomputed facts that stop the update before it
    publishes (None: all).  Returns the touched months and the checks' results.
    """
    before = [] if replace else read_manifest(spark, base) or []
    run_id, new, staged = uuid.uuid4().hex[:12], [], []
    touched: dict[str, set[str]] = {}
    next_rows: dict[str, list[tuple]] = {}
    for name, schema in schemas.RAW_SCHEMAS.items():
        key, table = schemas.RAW_KEYS[name], KEPT + name
        records = DEDUP[name](raw[name].select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]))
        records = records.withColumn(MONTH, month_of(parse_date(F.col("production_date"))))
        if any(t == table for t, _, _ in before):
            records = sinks.stage(records)
            gone = places.marked(read_rows(spark, before, table), key, records.select(key),
                                 month_of(parse_date(F.col("production_date"))).alias(MONTH))
            staged += [records, gone]
            touched[name] = {r[0] for r in records.select(MONTH).union(gone.select(MONTH)).distinct().collect()}  # a row per calendar month
            if any(t == table and part in touched[name] for t, part, _ in before):
                stay = places.without(read_rows(spark, before, table, touched[name]), gone)
                records = stay.withColumn(MONTH, month_of(parse_date(F.col("production_date")))).unionByName(records)
            written = manifest.write_months(rebalanced(records, MONTH), base, table, run_id) if touched[name] else []
        else:
            written = manifest.write_months(rebalanced(records, MONTH), base, table, run_id)
            touched[name] = {part for _, part, _ in written}
        next_rows[name] = [r for r in before if r[0] == table and r[1] not in touched[name]] + written
        new += next_rows[name]
    every = set().union(*touched.values())
    if not every and before:
        sinks.discard(*staged)
        return {"months": every, "fact_rows": 0, "fact_quality": None}
    records = {n: read_rows(spark, next_rows[n], KEPT + n, every) for n in schemas.RAW_SCHEMAS}
    joined = fact.fact_join(  # the kept records are unique by id already
        clean.parse_production(records["production"]),
        aggregate.agg_downtime(clean.parse_downtime(records["downtime"])),
        aggregate.agg_quality(clean.parse_quality(records["quality"]))).withColumn(MONTH, month_of(F.col("production_date")))
    # Rates and periods follow from the other columns, so they are made behind the shuffle.
    ordered = fact.rated(rebalanced(joined, MONTH), MONTH).sortWithinPartitions(MONTH, "machine_id", "production_date")
    facts = manifest.write_months(ordered, base, FACT, run_id)
    made = read_rows(spark, facts, FACT)
    results = quality.run_suite(made, FACT, quality.fact_suite(schemas.FACT_COLUMNS, config))
    results = spark.createDataFrame(results.collect(), results.schema)  # a row per check
    quality.enforce(results, gate=gate)
    new += facts
    found = members(made.withColumn(MONTH, month_of(F.col("production_date"))))
    new += manifest.write_months(rebalanced(found, MONTH), base, MEMBERS, run_id)
    new += [r for r in before if r[0] in (FACT, MEMBERS) and r[1] not in every]
    for name, df in dims_of(read_rows(spark, new, MEMBERS)).items():
        new.append(manifest.write_whole(df, base, name, run_id))
    new += [r for r in before if r[0] == GENERATION] or [(GENERATION, run_id, None)]
    rows = made.count()
    manifest.write_rows(spark, base, new)
    sinks.discard(*staged)
    return {"months": every, "fact_rows": rows, "fact_quality": results}


def reclaim(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    return manifest.reclaim(spark, base, TABLES, keep)

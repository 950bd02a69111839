"""Star-schema load: key-preserving upserts, foreign-key resolution, rejects.

The warehouse tables are immutable DataFrames/snapshots: every load function
takes the current table (or ``None`` for an empty warehouse) and the staged
lake data and returns the next version.  Writing that version to a fresh
snapshot folder and switching readers to it (see ``plans.load``) replaces the
delete-then-insert statements and cannot lose rows half way.

Behaviour relative to a plain delete + insert:

* dimension upserts keep the surrogate key (and ``created_at``) of members
  already present, so older facts keep resolving to them;
* ``dim_product`` / ``dim_date`` inserts are idempotent (anti-join on the
  natural key), so re-running a load does not duplicate members;
* fact rows that cannot be loaded — NULL id or date, unknown machine / shift /
  product, a measure that does not fit its warehouse type — are returned by
  :func:`fact_rejects` with a reason instead of vanishing.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopfloor import schemas
from shopfloor.functions.numeric import EXACT
from shopfloor.operators.ordered import dense_key

# The seeded shift members, in insertion order.
SHIFT_SEED = [
    ("S1", "Morning (06:00–14:00)", "06:00", 8),
    ("S2", "Afternoon (14:00–22:00)", "14:00", 8),
    ("S3", "Night (22:00–06:00)", "22:00", 8),
]

MINUTE_COLS = [
    "planned_runtime_min", "actual_runtime_min",
    "total_downtime_min", "planned_downtime_min", "unplanned_downtime_min",
]
PERCENT_COLS = ["first_pass_yield", "availability", "performance", "quality_rate", "oee_pct"]
INT_COLS = ["planned_qty", "actual_qty", "good_qty", "total_inspected_qty", "total_defect_qty"]


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schemas.WAREHOUSE_SCHEMAS[name])


def _now(load_ts: Column | None) -> Column:
    return (load_ts if load_ts is not None else F.current_timestamp()).cast("timestamp")


def _next_key(target: DataFrame | None, key: str) -> int:
    """Largest surrogate key in use (0 for no table) — a one-row aggregate."""
    if target is None:
        return 0
    value = target.agg(F.max(key)).first()[0]
    return int(value or 0)


def _conform(df: DataFrame, schema) -> DataFrame:
    """Warehouse types; a value that does not fit stops the load (facts were conformed or rejected before)."""
    def fitted(name, dtype):
        value, cast = F.col(name), F.col(name).try_cast(dtype)
        if df.schema[name].dataType == dtype:
            return value
        text = F.concat(F.lit(f"{name}: value does not fit {dtype.simpleString()}: "), value.cast("string"))
        return F.when(value.isNotNull() & cast.isNull(), F.raise_error(text).cast(dtype)).otherwise(cast)
    return df.select(*[fitted(f.name, f.dataType).alias(f.name) for f in schema.fields])


# ── dimensions ───────────────────────────────────────────────────────────────


def upsert_dim_machine(stage: DataFrame, target: DataFrame | None = None, load_ts: Column | None = None) -> DataFrame:
    """Stage (lake dim_machine) replaces matching members; keys and created_at survive."""
    spark = stage.sparkSession
    start = _next_key(target, "machine_key")
    target = target if target is not None else empty(spark, "dim_machine")
    now = _now(load_ts)
    location = F.col("plant_location") if "plant_location" in stage.columns else F.lit(None).cast("string")
    staged = stage.select(
        "machine_id", "machine_name", "machine_type", "is_active", "line_id", "line_name",
        "plant_id", "plant_name", location.alias("plant_location"),
    )
    ids = staged.select("machine_id")
    kept = target.join(ids, "machine_id", "left_anti")
    matched = staged.join(target.select("machine_id", "machine_key", "created_at"), "machine_id", "inner")
    matched = matched.withColumn("updated_at", now)
    new = staged.join(target.select("machine_id"), "machine_id", "left_anti")
    new = dense_key(new, "machine_key", "machine_id", start=start, key_type="int")
    new = new.withColumn("created_at", now).withColumn("updated_at", now)
    result = kept.unionByName(_conform(matched, schemas.DIM_MACHINE)).unionByName(_conform(new, schemas.DIM_MACHINE))
    return _conform(result, schemas.DIM_MACHINE)


def seed_dim_shift(spark: SparkSession, target: DataFrame | None = None) -> DataFrame:
    """Insert the seeded shifts that are not present yet (anti-join on shift_id)."""
    start = _next_key(target, "shift_key")
    target = target if target is not None else empty(spark, "dim_shift")
    seed = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(SHIFT_SEED)],
        "seq int, shift_id string, shift_name string, shift_start string, shift_hours int",
    )
    new = seed.join(target.select("shift_id"), "shift_id", "left_anti")
    # The seed is three rows: the ordering window runs over those only.
    new = new.withColumn("shift_key", F.lit(start) + F.row_number().over(Window.orderBy("seq")))
    return _conform(target.unionByName(_conform(new, schemas.DIM_SHIFT)), schemas.DIM_SHIFT)


def insert_dim_product(stage: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Append members whose product_id is not present; keys continue after the largest."""
    spark = stage.sparkSession
    start = _next_key(target, "product_key")
    target = target if target is not None else empty(spark, "dim_product")
    staged = stage.select("product_id", "product_name", "product_family", "unit_of_measure").filter(
        F.col("product_id").isNotNull()
    )
    new = staged.join(target.select("product_id"), "product_id", "left_anti")
    new = dense_key(new, "product_key", "product_id", start=start, key_type="int")
    return _conform(target.unionByName(_conform(new, schemas.DIM_PRODUCT)), schemas.DIM_PRODUCT)


def insert_dim_date(stage: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Append calendar rows for dates not present; the NULL-date row is not loadable."""
    spark = stage.sparkSession
    target = target if target is not None else empty(spark, "dim_date")
    staged = _conform(stage.filter(F.col("date_key").isNotNull()), schemas.DIM_DATE)
    new = staged.join(target.select("date_key"), "date_key", "left_anti")
    return target.unionByName(new)


# ── fact ─────────────────────────────────────────────────────────────────────


def conform_measures(df: DataFrame) -> DataFrame:
    """Lake doubles → warehouse DECIMAL(10,2) / DECIMAL(6,2); events → SMALLINT.

    Values are rounded half-up to 2 places first (on their decimal value, as ``round2``
    does; what is beyond its range does not fit either type); a value that does not fit
    becomes NULL and is flagged in ``_overflow`` (counted as a reject).
    """
    conformed = {}
    for c in MINUTE_COLS + PERCENT_COLS:
        dtype = schemas.MINUTES if c in MINUTE_COLS else schemas.PERCENT
        conformed[c] = F.round(F.col(c).try_cast(EXACT), 2).try_cast(dtype)
    conformed["downtime_events"] = F.col("downtime_events").try_cast("smallint")
    conformed |= {c: F.col(c).try_cast("int") for c in INT_COLS}
    # One projection of values and flag: the planner makes each value once, in a method of its own.  In a
    # projection of their own they share a method that is too large for the JVM to compile.
    overflow = reduce(operator.or_, [F.col(c).isNotNull() & value.isNull() for c, value in conformed.items()])
    return df.withColumns({**conformed, "_overflow": overflow})


REJECT_REASONS = [
    ("production_id", "null production_id"),
    ("date_key", "null or invalid production_date"),
    ("machine_key", "unknown machine_id"),
    ("shift_key", "unknown shift_id"),
    ("product_key", "unknown product_id"),
]


LOADED = StructType([f for f in schemas.FACT_PRODUCTION.fields if f.name not in ("production_sk", "loaded_at")])
REJECTED = ["production_id", "machine_id", "shift_id", "product_id", "production_date", "reject_reason"]


def loaded_or_rejected(resolved: DataFrame) -> DataFrame:
    """The columns of resolved runs that facts and rejects are made of; natural keys and dates are those of rejects alone."""
    alone = {c: F.when(F.col("reject_reason").isNotNull(), F.col(c)).alias(c) for c in REJECTED if c not in LOADED.names}
    alone["reject_reason"] = F.col("reject_reason")
    return resolved.select(*LOADED.names, *alone.values())


def resolve_fact(
    stage: DataFrame,
    dim_machine: DataFrame,
    dim_shift: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    """Natural ids → surrogate keys (left joins) plus a ``reject_reason`` column.

    Rows with ``reject_reason IS NULL`` are exactly the rows the inner-join
    insert loads; the others are the rejects.  Adaptive execution broadcasts
    a dimension if its measured bytes allow.
    """
    def lookup(dim: DataFrame, nat: str, key: str) -> DataFrame:
        return dim.select(nat, key)

    # Measures are conformed before the joins: a projection that also holds the reasons is too large to compile.
    # Products are most likely to be too many to broadcast: first, so that no key found before is shuffled with the runs.
    resolved = (
        conform_measures(stage)
        .join(lookup(dim_product, "product_id", "product_key"), "product_id", "left")
        .join(lookup(dim_machine, "machine_id", "machine_key"), "machine_id", "left")
        .join(lookup(dim_shift, "shift_id", "shift_key"), "shift_id", "left")
    )
    resolved = resolved.withColumn("date_key", F.col("production_date"))
    reason = None
    for col, text in REJECT_REASONS:
        cond = F.col(col).isNull()
        reason = F.when(cond, F.lit(text)) if reason is None else reason.when(cond, F.lit(text))
    reason = reason.when(F.col("_overflow"), F.lit("measure out of warehouse range"))
    return resolved.withColumn("reject_reason", reason).drop("_overflow")


def fact_rejects(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("reject_reason").isNotNull()).select(*REJECTED)


def upsert_fact(
    resolved: DataFrame,
    stage: DataFrame,
    target: DataFrame | None = None,
    load_ts: Column | None = None,
    start: int | None = None,
    written: bool = False,
    stay: DataFrame | None = None,
) -> DataFrame:
    """Replace facts whose production_id is staged; insert the loadable staged rows.

    ``start`` is the largest key in use where ``target`` is only a part of the table;
    ``written`` says that ``resolved`` is read from files; ``stay`` holds the rows of
    ``target`` whose id is not staged, where they are known.

    Every staged id removes its old row (also when the new version is
    rejected); new rows get production_sk after the largest key in use, in
    production_id order.
    """
    start = _next_key(target, "production_sk") if start is None else start
    # The columns of the fact alone are shuffled and sorted for the key: rows that are alike in them are alike.
    loadable = _conform(resolved.filter(F.col("reject_reason").isNull()), LOADED)
    keyed = dense_key(loadable, "production_sk", "production_id", start=start, written=written)
    new = _conform(keyed.withColumn("loaded_at", _now(load_ts)), schemas.FACT_PRODUCTION)
    if target is None:
        return new
    if stay is None:
        stay = target.join(stage.select("production_id").filter(F.col("production_id").isNotNull()),
                           "production_id", "left_anti")
    return stay.unionByName(new)


# ── verification ─────────────────────────────────────────────────────────────


def load_verification(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and last load time per warehouse table, ordered by table name."""
    last = {"fact_production": "loaded_at", "dim_machine": "updated_at"}
    parts = []
    for name in ["fact_production", "dim_machine", "dim_date", "dim_shift", "dim_product"]:
        df = tables[name]
        ts = F.max(last[name]) if name in last else F.lit(None).cast("timestamp")
        parts.append(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                            ts.cast("timestamp").alias("last_loaded")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")

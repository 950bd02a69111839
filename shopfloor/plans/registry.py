"""Every registered query as ``(spark, sf_dir) -> DataFrame`` over the shared test tables.

Each query rebuilds its inputs from the whole ``lineitem`` / ``events`` tables
through the raw-table mapping, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schemas as _schemas
from shopfloor.operators import aggregate, clean, fact
from shopfloor.operators import dims as _dims
from shopfloor.operators import layout as _layout
from shopfloor.operators import quality as _dq
from shopfloor.operators import rollups as _rollups
from shopfloor.operators import views as _views
from shopfloor.operators import warehouse as _wh
from shopfloor.plans import etl as _etl
from shopfloor.plans import lake as _lake
from shopfloor.plans import load as _load
from shopfloor.sources import catalog as _catalog
from shopfloor.sources import manifest as _manifest
from shopfloor.sources import quarantine as _quarantine
from shopfloor.sources import raw as _raw
from shopfloor.sources import sinks as _sinks
from shopfloor.sources import testdata
from shopfloor.streaming import ingest as _ingest

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testdata.raw_tables(spark, sf_dir)


def raw_one(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return testdata.raw_table(spark, sf_dir, name)


_CLEAN = {"production": clean.clean_production, "downtime": clean.clean_downtime, "quality": clean.clean_quality}


def cleaned_one(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _CLEAN[name](raw_one(spark, sf_dir, name))


def cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: cleaned_one(spark, sf_dir, name) for name in _CLEAN}


def lake_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cleaned(spark, sf_dir)
    return fact.fact_production(
        c["production"], aggregate.agg_downtime(c["downtime"]), aggregate.agg_quality(c["quality"])
    )


def q_dedup_production(spark, sf_dir):
    return clean.dedup_production(raw_one(spark, sf_dir, "production"))


def q_dedup_downtime(spark, sf_dir):
    return clean.dedup_downtime(raw_one(spark, sf_dir, "downtime"))


def q_dedup_quality(spark, sf_dir):
    return clean.dedup_quality(raw_one(spark, sf_dir, "quality"))


def q_clean_production(spark, sf_dir):
    return cleaned_one(spark, sf_dir, "production")


def q_clean_downtime(spark, sf_dir):
    return cleaned_one(spark, sf_dir, "downtime")


def q_clean_quality(spark, sf_dir):
    return cleaned_one(spark, sf_dir, "quality")


def q_agg_downtime(spark, sf_dir):
    return aggregate.agg_downtime(cleaned_one(spark, sf_dir, "downtime"))


def q_agg_quality(spark, sf_dir):
    return aggregate.agg_quality(cleaned_one(spark, sf_dir, "quality"))


def q_fact_join(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return fact.fact_join(c["production"], aggregate.agg_downtime(c["downtime"]), aggregate.agg_quality(c["quality"]))


def q_oee(spark, sf_dir):
    return lake_fact(spark, sf_dir).select("production_id", "availability", "performance", "quality_rate", "oee_pct")


def q_fact_production(spark, sf_dir):
    return lake_fact(spark, sf_dir)


# ── dimensions, warehouse, views ─────────────────────────────────────────────


TIMESTAMP_COLS = {"created_at", "updated_at", "loaded_at", "last_loaded"}


def _no_clock(df: DataFrame) -> DataFrame:
    """Drop load-time columns (wall clock) from a registered result."""
    return df.select(*[c for c in df.columns if c not in TIMESTAMP_COLS])


def lake_dims(spark, sf_dir) -> dict[str, DataFrame]:
    return _dims.all_dims(cleaned_one(spark, sf_dir, "production"))


def materialized_lake(spark, sf_dir) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Lake fact checkpointed once, dimensions derived from it (as the batch plan does)."""
    f = _etl.materialize(lake_fact(spark, sf_dir))
    return f, _dims.all_dims(f)


def warehouse(spark, sf_dir) -> dict[str, DataFrame]:
    """A fresh warehouse loaded from one lake snapshot (plus ``rejects``)."""
    f, d = materialized_lake(spark, sf_dir)
    made = _load.load(spark, f, d)
    _etl.discard(f)  # dimensions and resolved runs are files by now
    return made


def resolved_fact(spark, sf_dir) -> DataFrame:
    f, d = materialized_lake(spark, sf_dir)
    m = _etl.materialize(_wh.upsert_dim_machine(d["dim_machine"]))
    p = _etl.materialize(_wh.insert_dim_product(d["dim_product"]))
    return _wh.resolve_fact(f, m, _wh.seed_dim_shift(spark), p)


def q_dim_machine(spark, sf_dir):
    return lake_dims(spark, sf_dir)["dim_machine"]


def q_dim_shift(spark, sf_dir):
    return lake_dims(spark, sf_dir)["dim_shift"]


def q_dim_product(spark, sf_dir):
    return lake_dims(spark, sf_dir)["dim_product"]


def q_dim_date(spark, sf_dir):
    return lake_dims(spark, sf_dir)["dim_date"]


def q_load_upsert_dim_machine(spark, sf_dir):
    return _no_clock(_wh.upsert_dim_machine(lake_dims(spark, sf_dir)["dim_machine"]))


def q_load_dim_product(spark, sf_dir):
    return _wh.insert_dim_product(lake_dims(spark, sf_dir)["dim_product"])


def q_load_dim_date(spark, sf_dir):
    return _wh.insert_dim_date(lake_dims(spark, sf_dir)["dim_date"])


def q_load_fact_fk_lookup(spark, sf_dir):
    r = resolved_fact(spark, sf_dir).filter("reject_reason IS NULL")
    return r.select("production_id", "date_key", "machine_key", "shift_key", "product_key")


def q_load_fact_rejects(spark, sf_dir):
    return warehouse(spark, sf_dir)["rejects"]


def q_load_fact_conform(spark, sf_dir):
    r = resolved_fact(spark, sf_dir).filter("reject_reason IS NULL")
    return r.select("production_id", *_wh.MINUTE_COLS, "downtime_events", *_wh.PERCENT_COLS)


def q_load_upsert_fact(spark, sf_dir):
    return _no_clock(warehouse(spark, sf_dir)["fact_production"])


def q_load_surrogate_keys(spark, sf_dir):
    return warehouse(spark, sf_dir)["fact_production"].select("production_sk", "production_id")


def q_load_verification(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return _no_clock(_wh.load_verification({k: v for k, v in w.items() if k != "rejects"}))


def view_by_name(spark, sf_dir, name: str) -> DataFrame:
    """The view as a dashboard asks for it."""
    w = warehouse(spark, sf_dir)
    w.pop("rejects")
    _views.create_views(w, [name])
    return spark.sql(f"SELECT * FROM {name}")


def q_vw_daily_oee(spark, sf_dir):
    return view_by_name(spark, sf_dir, "vw_daily_oee")


def q_vw_monthly_summary(spark, sf_dir):
    return view_by_name(spark, sf_dir, "vw_monthly_summary")


def q_vw_downtime_pareto(spark, sf_dir):
    return view_by_name(spark, sf_dir, "vw_downtime_pareto")


def q_vw_shift_performance(spark, sf_dir):
    return view_by_name(spark, sf_dir, "vw_shift_performance")


def q_drilldown_plant_line_machine(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return _views.drilldown(w["fact_production"], w["dim_machine"])


# ── data quality ─────────────────────────────────────────────────────────────


def q_dq_suite_production(spark, sf_dir):
    return _dq.run_suite(raw_one(spark, sf_dir, "production"), "production", _dq.production_suite())


def q_dq_suite_downtime(spark, sf_dir):
    return _dq.run_suite(raw_one(spark, sf_dir, "downtime"), "downtime", _dq.downtime_suite())


def q_dq_suite_quality(spark, sf_dir):
    return _dq.run_suite(raw_one(spark, sf_dir, "quality"), "quality", _dq.quality_suite())


def q_dq_suite_fact(spark, sf_dir):
    f = lake_fact(spark, sf_dir)
    return _dq.run_suite(f, "fact_production", _dq.fact_suite(f.columns))


def q_dq_not_empty(spark, sf_dir):
    return _dq.run_suite(lake_fact(spark, sf_dir), "fact_production", [_dq.not_empty()])


def q_dq_null_keys(spark, sf_dir):
    keys = ["production_id", "machine_id", "production_date"]
    return _dq.run_suite(lake_fact(spark, sf_dir), "fact_production", _dq.null_keys(keys))


def q_dq_duplicates(spark, sf_dir):
    return _dq.run_suite(raw_one(spark, sf_dir, "production"), "production", [_dq.duplicates(["production_id"])])


def q_dq_date_format(spark, sf_dir):
    return _dq.run_suite(raw_one(spark, sf_dir, "production"), "production", [_dq.date_format("production_date")])


def q_dq_value_range(spark, sf_dir):
    check = _dq.value_range("downtime_minutes", min_val=0, max_val=1440)
    return _dq.run_suite(raw_one(spark, sf_dir, "downtime"), "downtime", [check])


def q_dq_null_ratio(spark, sf_dir):
    check = _dq.null_ratio("downtime_reason", threshold=_dq.DEV.max_null_ratio)
    return _dq.run_suite(raw_one(spark, sf_dir, "downtime"), "downtime", [check])


def q_dq_oee_bounds(spark, sf_dir):
    f = lake_fact(spark, sf_dir)
    return _dq.run_suite(f, "fact_production", _dq.oee_bounds(f.columns, _dq.DEV.oee_min, _dq.DEV.oee_max))


def q_dq_duplicate_ratio(spark, sf_dir):
    check = _dq.duplicate_ratio(["production_id"], threshold=_dq.DEV.max_duplicate_ratio)
    return _dq.run_suite(raw_one(spark, sf_dir, "production"), "production", [check])


def q_dq_summary(spark, sf_dir):
    tables = {**raw(spark, sf_dir), "fact_production": lake_fact(spark, sf_dir)}
    return _dq.summary(_dq.run_suites(tables))


# ── scans, sinks, catalog, layout, streaming ─────────────────────────────────
# Each writes data derived from the test tables into a fresh folder under the
# shared checkpoint directory and reads it back through the operator.


def _write_raw_text(spark, sf_dir, fmt: str, tables: tuple[str, ...] = ("production", "downtime", "quality")) -> str:
    base = _sinks.scratch_folder(spark, f"raw-{fmt}")
    for name in tables:
        df = raw_one(spark, sf_dir, name)
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", "true").option("nullValue", "").csv(f"{base}/{name}")
        else:
            writer.json(f"{base}/{name}")
    return base


def q_scan_csv_production(spark, sf_dir):
    base = _write_raw_text(spark, sf_dir, "csv", ("production",))
    return _raw.read_production(spark, f"{base}/production")


def q_scan_csv_downtime(spark, sf_dir):
    base = _write_raw_text(spark, sf_dir, "csv", ("downtime",))
    return _raw.read_downtime(spark, f"{base}/downtime")


def q_scan_csv_quality(spark, sf_dir):
    base = _write_raw_text(spark, sf_dir, "csv", ("quality",))
    return _raw.read_quality(spark, f"{base}/quality")


def q_scan_json_production(spark, sf_dir):
    base = _write_raw_text(spark, sf_dir, "json", ("production",))
    return _raw.read_production(spark, f"{base}/production", fmt="json")


def _damaged_runs(spark, sf_dir) -> DataFrame:
    """Raw runs as text fields; every run of every 89th machine has a planned quantity that is no number."""
    text = raw_one(spark, sf_dir, "production").select(*[F.col(f.name).cast("string") for f in _schemas.PRODUCTION])
    broken = F.substring("machine_id", 2, 20).cast("long") % 89 == 1
    return text.withColumn("planned_qty", F.when(broken, F.concat("planned_qty", F.lit("x"))).otherwise(F.col("planned_qty")))


def _states(parts: _quarantine.Split, id_pattern: str) -> DataFrame:
    """Kept and damaged records in one table; a damaged one is its line, from which the id is taken."""
    kept = parts.kept.select("production_id", F.lit("kept").alias("state"), "planned_qty", F.lit(None).cast("string").alias("line"))
    return kept.unionByName(parts.damaged.select(
        F.regexp_extract("line", id_pattern, 1).alias("production_id"), F.lit("damaged").alias("state"),
        F.lit(None).cast("int").alias("planned_qty"), "line"))


def q_scan_csv_quarantine(spark, sf_dir):
    base = _sinks.scratch_folder(spark, "damaged-csv")
    _damaged_runs(spark, sf_dir).write.option("header", "true").option("nullValue", "").csv(f"{base}/raw")
    return _states(_quarantine.split(spark, f"{base}/raw", _schemas.PRODUCTION, f"{base}/split"), r"^([^,]*),")


def q_scan_json_quarantine(spark, sf_dir):
    """Runs as JSON lines, those of every 89th machine cut short before their last brace."""
    base = _sinks.scratch_folder(spark, "damaged-json")
    runs = raw_one(spark, sf_dir, "production")
    whole = F.to_json(F.struct(*runs.columns))
    broken = F.substring("machine_id", 2, 20).cast("long") % 89 == 1
    cut = F.when(broken, F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    runs.select(cut.alias("value")).write.text(f"{base}/raw")
    parts = _quarantine.split(spark, f"{base}/raw", _schemas.PRODUCTION, f"{base}/split", "json")
    return _states(parts, '"production_id":"([^"]*)"').drop("line")


def q_sink_parquet(spark, sf_dir):
    path = _sinks.scratch_folder(spark, "sink-parquet")
    _sinks.write_parquet(raw_one(spark, sf_dir, "production"), path)
    return spark.read.parquet(path)


def q_sink_fact_partitioned(spark, sf_dir):
    path = _sinks.scratch_folder(spark, "sink-fact")
    _sinks.write_fact(lake_fact(spark, sf_dir), path)
    return spark.read.parquet(path).select(*_schemas.FACT_COLUMNS)


def q_fact_rowcount(spark, sf_dir):
    path = _sinks.scratch_folder(spark, "sink-fact-count")
    rows = _sinks.write_fact(lake_fact(spark, sf_dir), path)
    return spark.createDataFrame([(rows,)], "fact_rows long")


def q_sink_dims(spark, sf_dir):
    base = _sinks.scratch_folder(spark, "sink-dims")
    _sinks.write_dims(lake_dims(spark, sf_dir), base)
    return _members_as_text({n: spark.read.parquet(f"{base}/{n}") for n in _lake.DIMS})


def _members_as_text(tables: dict[str, DataFrame]) -> DataFrame:
    """Whole rows as text, columns by name, so that the four tables fit one result."""
    def members(name: str, df: DataFrame) -> DataFrame:
        text = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns)]
        return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *text).alias("member"))

    return reduce(DataFrame.unionByName, [members(n, df) for n, df in tables.items()])


# ── a published lake, kept up to date by two batches ─────────────────────────
# All raw records, by hashes of their ids.  The first batch lacks three tenths of
# the runs and four of the downtime and inspections, which arrive late, and has a
# tenth of the records in versions that the second batch corrects (other days,
# machines, quantities).  The second batch also sends a tenth again unchanged.


def _tenth(key: str):
    return F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(10))


def two_batches(spark, sf_dir) -> list[dict[str, DataFrame]]:
    first, second = {}, {}
    late = {"production": 7, "downtime": 6, "quality": 6}
    for name, df in raw(spark, sf_dir).items():
        key = _schemas.RAW_KEYS[name]
        stale = df.where(_tenth(key) == 0).withColumn("production_date", F.lit("1997-03-14"))
        stale = stale.withColumn("machine_id", F.concat("machine_id", F.lit("-old")))
        first[name] = df.where((_tenth(key) >= 1) & (_tenth(key) < late[name])).unionByName(stale)
        second[name] = df.where((_tenth(key) <= 1) | (_tenth(key) >= late[name]))
    return [first, second]


def updated_lake(spark, sf_dir) -> str:
    base = _sinks.scratch_folder(spark, "lake")
    for batch in two_batches(spark, sf_dir):
        _lake.update(spark, batch, base)
    return base


def q_lake_update_fact(spark, sf_dir):
    return _lake.read(spark, updated_lake(spark, sf_dir), "fact_production").select(*_schemas.FACT_COLUMNS)


def q_lake_update_dims(spark, sf_dir):
    base = updated_lake(spark, sf_dir)
    return _members_as_text({n: _lake.read(spark, base, n) for n in _lake.DIMS})


def q_lake_update_load(spark, sf_dir):
    """Rows loaded and rejected when a new warehouse takes the twice updated zone."""
    base, wh = updated_lake(spark, sf_dir), _sinks.scratch_folder(spark, "lake-wh")
    out = _load.run(spark, base, wh)
    loaded = _load.read_current(spark, wh)["fact_production"]
    return loaded.agg(F.count("*").alias("loaded"), F.lit(out["rejected"]).cast("long").alias("rejected"))


def mirrored_warehouse(spark, sf_dir) -> str:
    """A warehouse loaded after each of the two batches; the second load reads the changed months of the lake."""
    base, wh = _sinks.scratch_folder(spark, "lake"), _sinks.scratch_folder(spark, "mirror")
    for batch in two_batches(spark, sf_dir):
        _lake.update(spark, batch, base)
        _load.run(spark, base, wh)
    return wh


def q_load_changed_fact(spark, sf_dir):
    loaded = _load.read_current(spark, mirrored_warehouse(spark, sf_dir))["fact_production"]
    return loaded.select("production_id", "date_key", *_rollups.MEASURES)


def q_rollup_daily_oee(spark, sf_dir):
    return _load.read_views(spark, mirrored_warehouse(spark, sf_dir))["vw_daily_oee"]


def q_rollup_monthly_summary(spark, sf_dir):
    return _load.read_views(spark, mirrored_warehouse(spark, sf_dir))["vw_monthly_summary"]


def rollup_view(spark, sf_dir, name: str) -> DataFrame:
    """A view merged from the partials of a warehouse that was published whole."""
    base = _sinks.scratch_folder(spark, "partials")
    _load.publish(spark, base, warehouse(spark, sf_dir))
    return _load.read_views(spark, base)[name]


def q_rollup_downtime_pareto(spark, sf_dir):
    return rollup_view(spark, sf_dir, "vw_downtime_pareto")


def q_rollup_shift_performance(spark, sf_dir):
    return rollup_view(spark, sf_dir, "vw_shift_performance")


def q_rollup_drilldown(spark, sf_dir):
    return rollup_view(spark, sf_dir, "drilldown")


def q_load_copy_parquet(spark, sf_dir):
    """Parquet → staging dim_machine by column name; plant_location is not in the files → NULL."""
    base = _sinks.scratch_folder(spark, "copy")
    _sinks.write_dims({"dim_machine": lake_dims(spark, sf_dir)["dim_machine"]}, base)
    cols = ["machine_id", "machine_name", "machine_type", "is_active", "line_id", "line_name",
            "plant_id", "plant_name", "plant_location"]
    return _load.stage_from_parquet(spark, f"{base}/dim_machine", _schemas.DIM_MACHINE, cols)


def _fresh_db(prefix: str) -> str:
    import uuid

    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def q_catalog_register_raw(spark, sf_dir):
    base = _write_raw_text(spark, sf_dir, "csv")
    db = _fresh_db("shopfloor_raw")
    tables = _catalog.register_raw(spark, db, base)
    return spark.table(tables[0])


def q_catalog_register_fact(spark, sf_dir):
    path = _sinks.scratch_folder(spark, "catalog-fact")
    _sinks.write_fact(lake_fact(spark, sf_dir), path)
    table = _catalog.register_fact(spark, _fresh_db("shopfloor_processed"), path)
    return spark.table(table).select(*_schemas.FACT_COLUMNS)


def q_catalog_star_schema(spark, sf_dir):
    db = _fresh_db("shopfloor_wh")
    _catalog.create_star_schema(spark, db, _sinks.scratch_folder(spark, "star"))
    _catalog.create_star_schema(spark, db)  # idempotent second run
    _wh.insert_dim_date(lake_dims(spark, sf_dir)["dim_date"]).write.insertInto(f"{db}.dim_date")
    return spark.table(f"{db}.dim_date")


def q_catalog_column_defaults(spark, sf_dir):
    """All products inserted into the catalog table without their unit: the column's default fills it in."""
    db = _fresh_db("shopfloor_defaults")
    _catalog.create_star_schema(spark, db, _sinks.scratch_folder(spark, "defaults"))
    _wh.insert_dim_product(lake_dims(spark, sf_dir)["dim_product"]).createOrReplaceTempView("new_products")
    columns = "product_key, product_id, product_name, product_family"
    spark.sql(f"INSERT INTO {db}.dim_product ({columns}) SELECT {columns} FROM new_products")
    return spark.table(f"{db}.dim_product")


def published_view(spark, sf_dir, name: str) -> DataFrame:
    """A permanent view over catalog tables that follow the manifest, queried in SQL by another session."""
    base, db = _sinks.scratch_folder(spark, "published"), _fresh_db("shopfloor_published")
    _load.publish(spark, base, warehouse(spark, sf_dir))
    _catalog.publish_warehouse(spark, db, base)
    return spark.newSession().sql(f"SELECT * FROM {db}.{name}")


def q_catalog_vw_daily_oee(spark, sf_dir):
    return published_view(spark, sf_dir, "vw_daily_oee")


def q_catalog_vw_monthly_summary(spark, sf_dir):
    return published_view(spark, sf_dir, "vw_monthly_summary")


def q_catalog_vw_downtime_pareto(spark, sf_dir):
    return published_view(spark, sf_dir, "vw_downtime_pareto")


def q_catalog_vw_shift_performance(spark, sf_dir):
    return published_view(spark, sf_dir, "vw_shift_performance")


def q_catalog_schema_drift(spark, sf_dir):
    """All raw runs read through a table whose later files have one column more than it was registered with."""
    path = f"{_sinks.scratch_folder(spark, 'drift')}/production"
    rows = raw_one(spark, sf_dir, "production")
    early = F.col("shift_id").isin("S1", "S3")
    rows.where(early).drop("actual_runtime_min").write.parquet(path)
    db = _fresh_db("shopfloor_drift")
    _catalog.ensure_database(spark, db)
    spark.catalog.createTable(f"{db}.runs", path=path, source="parquet")
    rows.where(~early).write.mode("append").parquet(path)
    _catalog.update_from_files(spark, f"{db}.runs", path)
    return spark.table(f"{db}.runs")


# ── two loads, one after the other ───────────────────────────────────────────
# All runs, in two overlapping batches: some members are in the first only, some
# in both, some in the second only, and half a year of runs is loaded twice.

FIRST_BATCH = "plant_id = 'PLT0' OR (plant_id <> 'PLT1' AND production_date < date '1999-01-01')"
SECOND_BATCH = ("plant_id <> 'PLT0' AND (plant_id = 'PLT1' OR production_date >= date '1998-07-01' "
                "OR production_date IS NULL)")
LOAD_TIMES = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def two_loads(spark, sf_dir) -> dict[str, DataFrame]:
    """The warehouse after both batches went through the load job, read back from its manifest."""
    fact_rows = _etl.materialize(lake_fact(spark, sf_dir))
    base = _sinks.scratch_folder(spark, "two-loads")
    for n, (batch, at) in enumerate(zip((FIRST_BATCH, SECOND_BATCH), LOAD_TIMES)):
        part = fact_rows.where(batch)
        _sinks.write_fact(part, f"{base}/lake{n}/fact_production")
        _sinks.write_dims(_dims.all_dims(part), f"{base}/lake{n}")
        _load.run(spark, f"{base}/lake{n}", f"{base}/wh", load_ts=F.lit(at).cast("timestamp"))
    _etl.discard(fact_rows)
    return _load.read_current(spark, f"{base}/wh")


def two_dims(spark, sf_dir, name: str, upsert) -> DataFrame:
    """One dimension through both batches; the first version is written before the second reads it."""
    runs = cleaned_one(spark, sf_dir, "production")
    version = None
    for batch, at in zip((FIRST_BATCH, SECOND_BATCH), LOAD_TIMES):
        stage = _dims.all_dims(runs.where(batch))[name]
        version = _etl.materialize(upsert(stage, version, F.lit(at).cast("timestamp")))
    return version


def q_load_two_dim_machine(spark, sf_dir):
    return two_dims(spark, sf_dir, "dim_machine", _wh.upsert_dim_machine)


def q_load_two_dim_product(spark, sf_dir):
    return two_dims(spark, sf_dir, "dim_product", lambda stage, old, _: _wh.insert_dim_product(stage, old))


def q_load_two_dim_date(spark, sf_dir):
    return two_dims(spark, sf_dir, "dim_date", lambda stage, old, _: _wh.insert_dim_date(stage, old))


def q_load_two_fact(spark, sf_dir):
    return two_loads(spark, sf_dir)["fact_production"]


def q_load_two_verification(spark, sf_dir):
    return _wh.load_verification(two_loads(spark, sf_dir))


def q_layout_fact_sorted(spark, sf_dir):
    return _no_clock(_layout.sorted_fact(warehouse(spark, sf_dir)["fact_production"])).drop("month_key")


def q_maint_compact(spark, sf_dir):
    base = _sinks.scratch_folder(spark, "wh")
    w = warehouse(spark, sf_dir)
    _load.publish(spark, base, {t: w[t] for t in _load.TABLES}, sort=False)
    _load.compact(spark, base)
    return _no_clock(_load.read_current(spark, base)["fact_production"])


def q_maint_compact_months(spark, sf_dir):
    """Rows of each month after a compaction of the months with an even number, whose files had been cut up before."""
    base = _sinks.scratch_folder(spark, "wh-months")
    rows = _load.publish(spark, base, {t: df for t, df in warehouse(spark, sf_dir).items() if t in _load.TABLES})
    even = {part for t, part, _ in rows if t == _load.FACT and int(part) % 2 == 0}
    cut = _layout.with_month(_load.read_table(spark, rows, _load.FACT, even)).repartition(4)
    parts = _manifest.write_months(cut, base, _load.FACT, "cut")
    _load.write_manifest(spark, base, [r for r in rows if r[1] not in even] + parts)
    after = _load.compact(spark, base)
    months = spark.createDataFrame(
        [(int(part), _layout.files_needed(sizes := _sinks.file_sizes(spark, path)) == len(sizes))
         for t, part, path in after if t == _load.FACT], "month_key int, is_packed boolean")
    counts = _layout.with_month(_load.read_current(spark, base)[_load.FACT]).groupBy("month_key").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("actual_qty").alias("actual_qty"))
    return counts.join(months, "month_key")


STATISTICS = ["date_key", "planned_qty", "actual_qty", "first_pass_yield", "oee_pct"]


def _fact_table(spark, sf_dir) -> str:
    path = _sinks.scratch_folder(spark, "wh-columns")
    _sinks.write_parquet(_layout.sorted_fact(warehouse(spark, sf_dir)["fact_production"]), path)
    db = _fresh_db("shopfloor_columns")
    _catalog.ensure_database(spark, db)
    spark.catalog.createTable(f"{db}.fact_production", path=path, source="parquet")
    return f"{db}.fact_production"


def q_maint_column_statistics(spark, sf_dir):
    # The number of distinct values is approximate, so it is not compared.
    return _layout.column_statistics(spark, _fact_table(spark, sf_dir), STATISTICS).drop("distinct_count")


def q_maint_analyze(spark, sf_dir):
    base = _sinks.scratch_folder(spark, "wh-analyze")
    snap = f"{base}/fact_production"
    _sinks.write_parquet(_layout.sorted_fact(warehouse(spark, sf_dir)["fact_production"]), snap)
    db = _fresh_db("shopfloor_stats")
    _catalog.ensure_database(spark, db)
    spark.catalog.createTable(f"{db}.fact_production", path=snap, source="parquet")
    return _layout.analyze(spark, f"{db}.fact_production").select("table_name", "row_count")


def q_stream_raw_to_parquet(spark, sf_dir):
    base = _write_raw_text(spark, sf_dir, "csv", ("production",))
    out = _sinks.scratch_folder(spark, "raw-parquet")
    ckpt = _sinks.scratch_folder(spark, "raw-stream-ckpt")
    q = _ingest.start_ingest(spark, f"{base}/production", f"{out}/production", f"{ckpt}/production", "production")
    q.awaitTermination()
    return _ingest.read_parquet_copy(spark, f"{out}/production", "production")


def queries() -> dict[str, Query]:
    """Registered queries, in build order (lake → warehouse → views → quality → I/O)."""
    return {
        "dedup_production": q_dedup_production,
        "dedup_downtime": q_dedup_downtime,
        "dedup_quality": q_dedup_quality,
        "clean_production": q_clean_production,
        "clean_downtime": q_clean_downtime,
        "clean_quality": q_clean_quality,
        "agg_downtime": q_agg_downtime,
        "agg_quality": q_agg_quality,
        "fact_join": q_fact_join,
        "oee": q_oee,
        "fact_production": q_fact_production,
        "dim_machine": q_dim_machine,
        "dim_shift": q_dim_shift,
        "dim_product": q_dim_product,
        "dim_date": q_dim_date,
        "load_upsert_dim_machine": q_load_upsert_dim_machine,
        "load_dim_product": q_load_dim_product,
        "load_dim_date": q_load_dim_date,
        "load_fact_fk_lookup": q_load_fact_fk_lookup,
        "load_fact_rejects": q_load_fact_rejects,
        "load_fact_conform": q_load_fact_conform,
        "load_upsert_fact": q_load_upsert_fact,
        "load_surrogate_keys": q_load_surrogate_keys,
        "load_verification": q_load_verification,
        "load_two_dim_machine": q_load_two_dim_machine,
        "load_two_dim_product": q_load_two_dim_product,
        "load_two_dim_date": q_load_two_dim_date,
        "load_two_fact": q_load_two_fact,
        "catalog_vw_daily_oee": q_catalog_vw_daily_oee,
        "catalog_vw_monthly_summary": q_catalog_vw_monthly_summary,
        "catalog_vw_downtime_pareto": q_catalog_vw_downtime_pareto,
        "catalog_vw_shift_performance": q_catalog_vw_shift_performance,
        "lake_update_fact": q_lake_update_fact,
        "lake_update_dims": q_lake_update_dims,
        "lake_update_load": q_lake_update_load,
        "load_changed_fact": q_load_changed_fact,
        "rollup_daily_oee": q_rollup_daily_oee,
        "rollup_monthly_summary": q_rollup_monthly_summary,
        "rollup_downtime_pareto": q_rollup_downtime_pareto,
        "rollup_shift_performance": q_rollup_shift_performance,
        "rollup_drilldown": q_rollup_drilldown,
        "load_two_verification": q_load_two_verification,
        "vw_daily_oee": q_vw_daily_oee,
        "vw_monthly_summary": q_vw_monthly_summary,
        "vw_downtime_pareto": q_vw_downtime_pareto,
        "vw_shift_performance": q_vw_shift_performance,
        "drilldown_plant_line_machine": q_drilldown_plant_line_machine,
        "dq_suite_production": q_dq_suite_production,
        "dq_suite_downtime": q_dq_suite_downtime,
        "dq_suite_quality": q_dq_suite_quality,
        "dq_suite_fact": q_dq_suite_fact,
        "dq_not_empty": q_dq_not_empty,
        "dq_null_keys": q_dq_null_keys,
        "dq_duplicates": q_dq_duplicates,
        "dq_date_format": q_dq_date_format,
        "dq_value_range": q_dq_value_range,
        "dq_null_ratio": q_dq_null_ratio,
        "dq_oee_bounds": q_dq_oee_bounds,
        "dq_duplicate_ratio": q_dq_duplicate_ratio,
        "dq_summary": q_dq_summary,
        "scan_csv_production": q_scan_csv_production,
        "scan_csv_downtime": q_scan_csv_downtime,
        "scan_csv_quality": q_scan_csv_quality,
        "scan_json_production": q_scan_json_production,
        "scan_csv_quarantine": q_scan_csv_quarantine,
        "scan_json_quarantine": q_scan_json_quarantine,
        "sink_parquet": q_sink_parquet,
        "sink_fact_partitioned": q_sink_fact_partitioned,
        "fact_rowcount": q_fact_rowcount,
        "sink_dims": q_sink_dims,
        "load_copy_parquet": q_load_copy_parquet,
        "catalog_register_raw": q_catalog_register_raw,
        "catalog_register_fact": q_catalog_register_fact,
        "catalog_star_schema": q_catalog_star_schema,
        "catalog_column_defaults": q_catalog_column_defaults,
        "catalog_schema_drift": q_catalog_schema_drift,
        "layout_fact_sorted": q_layout_fact_sorted,
        "maint_compact": q_maint_compact,
        "maint_compact_months": q_maint_compact_months,
        "maint_column_statistics": q_maint_column_statistics,
        "maint_analyze": q_maint_analyze,
        "stream_raw_to_parquet": q_stream_raw_to_parquet,
    }

"""Catalog registration of raw, processed and warehouse tables.

* raw zone tables ``raw_<name>`` over the CSV (or JSON) folders with the
  declared schemas — no inference pass over the files;
* processed fact ``processed_fact_production`` (partitioned by year, month;
  partitions recovered from the folder layout);
* warehouse star schema ``CREATE TABLE IF NOT EXISTS … USING parquet``, plus
  staging tables created ``LIKE`` their targets;
* schema drift: compare a table's current schema with what the files hold now
  — added columns are applied, removed / retyped columns are only reported;
* the published warehouse: external tables whose locations follow the newest
  manifest, and the four views as permanent SQL views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shopfloor import schemas
from shopfloor.sources import manifest, sinks, sql_views

RAW_PREFIX = "raw_"
PROCESSED_PREFIX = "processed_"


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def register_raw(spark: SparkSession, database: str, raw_base: str, fmt: str = "csv") -> list[str]:
    ensure_database(spark, database)
    names = []
    for name, schema in schemas.RAW_SCHEMAS.items():
        table = f"{database}.{RAW_PREFIX}{name}"
        options = {"header": "true", "nullValue": "", "mode": "PERMISSIVE"} if fmt == "csv" else {}
        if not spark.catalog.tableExists(table):
            spark.catalog.createTable(table, path=f"{raw_base.rstrip('/')}/{name}", source=fmt, schema=schema,
                                      **options)
        names.append(table)
    return names


def register_fact(spark: SparkSession, database: str, path: str) -> str:
    ensure_database(spark, database)
    table = f"{database}.{PROCESSED_PREFIX}fact_production"
    if not spark.catalog.tableExists(table):
        schema = spark.read.parquet(path).schema  # footer of one file + folder names
        spark.sql(
            f"CREATE TABLE {table} ({_ddl(schema, nullable=True)}) USING parquet "
            f"PARTITIONED BY (year, month) LOCATION '{path}'"
        )
    spark.catalog.recoverPartitions(table)
    return table


def _ddl(schema: StructType, nullable: bool = False) -> str:
    return ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if (f.nullable or nullable) else ' NOT NULL'}"
        for f in schema.fields
    )


def warehouse_ddl(name: str) -> str:
    """Columns of a warehouse table with text lengths (checked on insert) and defaults (used by inserts that omit them)."""
    lengths, defaults = schemas.TEXT_LENGTHS.get(name, {}), schemas.COLUMN_DEFAULTS.get(name, {})
    columns = []
    for f in schemas.WAREHOUSE_SCHEMAS[name].fields:
        kind = f"VARCHAR({lengths[f.name]})" if f.name in lengths else f.dataType.simpleString()
        default = f" DEFAULT {defaults[f.name]}" if f.name in defaults else ""
        columns.append(f"{f.name} {kind}{'' if f.nullable else ' NOT NULL'}{default}")
    return ", ".join(columns)


STAGING = {"stg_fact_production": "fact_production", "stg_dim_machine": "dim_machine"}


def create_star_schema(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """Idempotent DDL for the four dimensions, the fact and two staging tables."""
    ensure_database(spark, database)
    created = []
    for name in schemas.WAREHOUSE_SCHEMAS:
        loc = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({warehouse_ddl(name)}) USING parquet{loc}")
        created.append(f"{database}.{name}")
    for stg, target in STAGING.items():
        loc = f" LOCATION '{location.rstrip('/')}/{stg}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{stg} LIKE {database}.{target} USING parquet{loc}")
        created.append(f"{database}.{stg}")
    return created


def schema_drift(spark: SparkSession, registered: StructType, observed: StructType) -> DataFrame:
    """One row per differing column: (column_name, change, old_type, new_type, action)."""
    old = {f.name: f.dataType.simpleString() for f in registered.fields}
    new = {f.name: f.dataType.simpleString() for f in observed.fields}
    rows = []
    for name, t in new.items():
        if name not in old:
            rows.append((name, "added", None, t, "update"))
        elif old[name] != t:
            rows.append((name, "type_changed", old[name], t, "log"))
    for name, t in old.items():
        if name not in new:
            rows.append((name, "removed", t, None, "log"))
    return spark.createDataFrame(
        rows, "column_name string, change string, old_type string, new_type string, action string"
    )


def apply_drift(spark: SparkSession, table: str, drift: DataFrame) -> list[str]:
    """Add new columns to the table; removals and type changes are left to a person."""
    added = [(r["column_name"], r["new_type"]) for r in drift.filter("change = 'added'").collect()]
    if added:
        cols = ", ".join(f"{n} {t}" for n, t in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [n for n, _ in added]


def update_from_files(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Compare a table with the files in its folder, add the columns they have more, and return the drift."""
    observed = spark.read.option("mergeSchema", "true").parquet(path).schema
    drift = schema_drift(spark, spark.table(table).schema, observed)
    apply_drift(spark, table, drift)
    spark.catalog.refreshTable(table)
    return drift


# ── the published warehouse as catalog tables ────────────────────────────────

PARTITIONS_AT_ONCE = 500  # in one ALTER TABLE
PUBLISHED = "shopfloor.manifest"  # table property: the manifest that the partitions follow


def publish_warehouse(spark: SparkSession, database: str, base: str) -> list[str]:
    """Let catalog tables and permanent views follow the newest manifest of a warehouse; returns their names.

    They point at the manifest's folders and own no data: the dimensions are views
    of theirs, the fact is an external table whose partitions are months; of these
    only the ones whose folder changed since the last publication are touched.  Any session of the catalog
    can then query the tables and ``vw_*`` views in SQL, after each load anew.
    """
    ensure_database(spark, database)
    newest = manifest.manifests(spark, base)[-1]
    rows = [tuple(r) for r in spark.read.schema(manifest.MANIFEST_SCHEMA).json(newest).collect()]
    names = []
    for name, schema in schemas.WAREHOUSE_SCHEMAS.items():
        table = f"{database}.{name}"
        if name == "fact_production":
            _publish_fact(spark, table, schema, base, newest, {part: path for t, part, path in rows if t == name})
        else:
            # A view, as other sessions keep a table's old location in their cache but resolve views each time.
            (path,) = (p for t, _, p in rows if t == name)
            columns = ", ".join(f.name for f in schema.fields)
            spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM parquet.`{path}`")
        names.append(table)
    for name, text in sql_views.VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text(database)}")
        names.append(f"{database}.{name}")
    return names


def _publish_fact(spark: SparkSession, table: str, schema: StructType, base: str, newest: str, months: dict[str, str]) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(schema, nullable=True)}, {manifest.MONTH} int) USING parquet "
              f"PARTITIONED BY ({manifest.MONTH}) LOCATION '{base.rstrip('/')}/fact_production'")
    shown = {r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}  # a row per month
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    last, old = properties.get(PUBLISHED), {}
    if last and sinks.exists(spark, last):
        old = {r["part"]: r["path"] for r in spark.read.schema(manifest.MANIFEST_SCHEMA).json(last)
               .where("table = 'fact_production'").collect()}
    gone = sorted(m for m in shown if old.get(m) is None or old[m] != months.get(m))
    new = sorted(m for m in months if m not in shown or m in gone)
    for at in range(0, len(gone), PARTITIONS_AT_ONCE):
        parts = ", ".join(f"PARTITION ({manifest.MONTH} = {m})" for m in gone[at:at + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    for at in range(0, len(new), PARTITIONS_AT_ONCE):
        parts = " ".join(f"PARTITION ({manifest.MONTH} = {m}) LOCATION '{months[m]}'" for m in new[at:at + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PUBLISHED}' = '{newest}')")
    spark.catalog.refreshTable(table)

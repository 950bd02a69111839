"""Publication by manifest: immutable data folders, and one list of the folders that are in force.

A writer makes new folders first and then one manifest that lists the folders of
all tables; the newest complete manifest is the zone.  Nothing is overwritten: a
crash at any point leaves the previous manifest in force, and readers see all
tables of one run or all of another.  No manifest folder means a new zone; an
unreadable or incomplete manifest is an error and never an empty zone.

Manifest rows: ``(table, part, path)``; ``part`` is the month (yyyymm) of a folder
of a table kept by month, and null where a table is one folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.operators.joins import rebalanced
from shopfloor.sources import sinks

MANIFESTS = "_manifests"
MANIFEST_SCHEMA = "table string, part string, path string"
MONTH = "month_key"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a date


def names_in(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder, or None if there is no such folder; any other problem is raised."""
    if not sinks.exists(spark, path):
        return None
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(target))


def manifests(spark: SparkSession, base: str) -> list[str]:
    """Complete manifests, oldest first."""
    folder = f"{base.rstrip('/')}/{MANIFESTS}"
    return [f"{folder}/{name}" for name in names_in(spark, folder) or []
            if "_SUCCESS" in (names_in(spark, f"{folder}/{name}") or [])]


def read_rows(spark: SparkSession, base: str, required: list[str]) -> list[tuple] | None:
    """Rows of the newest manifest, or None for a new zone."""
    found = manifests(spark, base)
    if not found:
        return None
    rows = [tuple(r) for r in spark.read.schema(MANIFEST_SCHEMA).json(found[-1]).collect()]
    missing = set(required) - {r[0] for r in rows}
    if missing:
        raise RuntimeError(f"manifest {found[-1]} does not list {sorted(missing)}")
    gone = [path for _, _, path in rows if path and not sinks.exists(spark, path)]
    if gone:
        raise RuntimeError(f"manifest {found[-1]} lists folders that do not exist: {gone[:5]}")
    return rows


def write_rows(spark: SparkSession, base: str, rows: list[tuple]) -> str:
    """Publish the rows as the newest manifest (a new folder, complete once it holds _SUCCESS)."""
    last = [int(name.split("-")[0]) for name in names_in(spark, f"{base.rstrip('/')}/{MANIFESTS}") or []]
    path = f"{base.rstrip('/')}/{MANIFESTS}/{max(last, default=0) + 1:012d}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("errorifexists").json(path)
    return path


def read_part(spark: SparkSession, rows: list[tuple], table: str, schema, parts: set[str] | None = None) -> DataFrame:
    """One table of a manifest; ``parts`` restricts a table kept by month to those months."""
    paths = [p for t, part, p in rows if t == table and p and (parts is None or part in parts)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_whole(df: DataFrame, base: str, table: str, run_id: str) -> tuple:
    """Write a table as one new folder; returns its manifest row."""
    path = f"{base.rstrip('/')}/{table}/v-{run_id}"
    rebalanced(df).write.mode("errorifexists").parquet(path)
    return (table, None, path)


def write_months(df: DataFrame, base: str, table: str, run_id: str) -> list[tuple]:
    """Write rows with a ``month_key`` into one new folder per month; returns their manifest rows."""
    spark, path = df.sparkSession, f"{base.rstrip('/')}/{table}/v-{run_id}"
    df.write.mode("errorifexists").option("compression", "zstd").partitionBy(MONTH).parquet(path)
    return [(table, name.split("=")[1], f"{path}/{name}") for name in names_in(spark, path) or []
            if name.startswith(f"{MONTH}=")]


def month_of(date_col):
    """yyyymm of a date as text; rows without a date have the name of their folder."""
    return F.coalesce((F.year(date_col) * 100 + F.month(date_col)).cast("string"), F.lit(NO_MONTH))


def reclaim(spark: SparkSession, base: str, tables: list[str], keep: int = 2) -> list[str]:
    """Delete data folders that none of the ``keep`` newest manifests lists, and older manifests; returns the paths.

    Run it when no reader still uses an older manifest and no writer is under way.
    """
    base, found = base.rstrip("/"), manifests(spark, base)
    used = {r["path"] for m in found[-keep:] for r in spark.read.schema(MANIFEST_SCHEMA).json(m).collect()}
    dropped = list(found[:-keep])
    for table in tables:
        for version in names_in(spark, f"{base}/{table}") or []:
            path = f"{base}/{table}/{version}"
            if path in used:
                continue
            months = [f"{path}/{m}" for m in names_in(spark, path) if m.startswith(f"{MONTH}=")]
            unused = [m for m in months if m not in used]
            dropped += unused if len(unused) < len(months) else [path]
    for path in dropped:
        sinks.drop_folder(spark, path)
    return dropped

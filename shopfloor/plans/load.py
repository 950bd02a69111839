"""Warehouse load: processed zone → star schema snapshots.

Data folders are immutable and published by manifest (:mod:`shopfloor.sources.manifest`):
a crash at any point leaves the previous load in force, and readers see all tables
of one load or all of another, never a mix.

The fact is kept by month.  A load rewrites only the months that its rows change
and carries the folders of all other months over.  Rows that cannot be loaded
are published with the load's id.  Beside the facts lie their additive partials
(:mod:`shopfloor.operators.rollups`), made anew for the same months only.

A warehouse that only ever took one published lake mirrors it, and remembers for
each month the lake folder it was loaded from.  A run is in one month of the lake,
which loses no run, and both months of a run that moves get new folders; so the
months whose folders differ hold every new run and every older version of one: a
whole load reads those months of both sides and no other, and needs no look-up of
ids.  A lake that was replaced is another lake.

Manifest rows: ``(table, part, path)``; ``part`` is the month (yyyymm) of a fact or
partials folder, the load id of a rejects folder, and null for a dimension.  Rows
without a path hold the largest surrogate key of the fact, the lake that the
warehouse mirrors, and of each month the folder it was loaded from.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from shopfloor import schemas
from shopfloor.operators import layout, places, rollups
from shopfloor.operators import warehouse as wh
from shopfloor.operators.joins import rebalanced
from shopfloor.plans import lake
from shopfloor.sources import manifest, sinks

DIMS = ["dim_date", "dim_machine", "dim_shift", "dim_product"]
TABLES = [*DIMS, "fact_production"]
FACT, REJECTS = "fact_production", "rejects"
LARGEST_KEY = "largest_production_sk"  # manifest row; its part is the key, so that a load need not look for it
MIRROR = "mirror_of"  # manifest row; its part is the lake that all rows came from, and its generation
LOADED = "loaded_month"  # manifest rows; their part is a month and the lake folder it was last loaded from
MONTHS_AT_ONCE = 32  # jobs of a compaction; the cluster's cores bound how many of their tasks run
REJECTS_SCHEMA = ("load_id string, production_id string, machine_id string, shift_id string, product_id string, "
                  "production_date date, reject_reason string")


def stage_from_parquet(spark: SparkSession, path: str, schema: StructType,
                       columns: list[str] | None = None) -> DataFrame:
    """Bulk-load Parquet into a staging shape, binding columns **by name**.

    ``columns`` (default: all of ``schema``) are taken from the files and cast
    to the staging types; a column the files do not have comes back NULL.
    Only the listed columns are read (pruned scan).
    """
    files = spark.read.parquet(path)
    present = set(files.columns)
    wanted = columns or [f.name for f in schema.fields]
    return files.select(*[
        (F.col(c) if c in present else F.lit(None)).cast(schema[c].dataType).alias(c) for c in wanted
    ])


def staged_runs(runs: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Resolved runs as files, with the columns that facts and rejects are made of."""
    resolved = wh.resolve_fact(runs, dims["dim_machine"], dims["dim_shift"], dims["dim_product"])
    return sinks.stage(wh.loaded_or_rejected(resolved))


def load(
    spark: SparkSession,
    lake_fact: DataFrame,
    lake_dims: dict[str, DataFrame],
    current: dict[str, DataFrame] | None = None,
    load_ts: Column | None = None,
) -> dict[str, DataFrame]:
    """Next version of every warehouse table plus ``rejects``.

    The dimensions and the resolved runs are staged as files.  So the planner knows
    the dimensions' sizes and broadcasts the small ones before any run is shuffled,
    and runs are resolved once for facts and rejects.
    """
    cur = current or {}
    dims = {
        "dim_date": wh.insert_dim_date(lake_dims["dim_date"], cur.get("dim_date")),
        "dim_machine": wh.upsert_dim_machine(lake_dims["dim_machine"], cur.get("dim_machine"), load_ts),
        "dim_shift": wh.seed_dim_shift(spark, cur.get("dim_shift")),
        "dim_product": wh.insert_dim_product(lake_dims["dim_product"], cur.get("dim_product")),
    }
    dims = {name: sinks.stage(rebalanced(df)) for name, df in dims.items()}
    resolved = staged_runs(lake_fact, dims)
    fact = wh.upsert_fact(resolved, lake_fact, cur.get("fact_production"), load_ts, written=True)
    return {**dims, "fact_production": fact, "rejects": wh.fact_rejects(resolved)}


# ── manifests ────────────────────────────────────────────────────────────────


def manifests(spark: SparkSession, base: str) -> list[str]:
    return manifest.manifests(spark, base)


def read_manifest(spark: SparkSession, base: str) -> list[tuple] | None:
    return manifest.read_rows(spark, base, DIMS)


def write_manifest(spark: SparkSession, base: str, rows: list[tuple]) -> str:
    return manifest.write_rows(spark, base, rows)


def read_table(spark: SparkSession, rows: list[tuple], table: str, parts: set[str] | None = None) -> DataFrame:
    """One table of a manifest; ``parts`` restricts a fact or its partials to those months."""
    known = {**schemas.WAREHOUSE_SCHEMAS, **rollups.SCHEMAS, REJECTS: REJECTS_SCHEMA}
    return manifest.read_part(spark, rows, table, known[table], parts)


def read_current(spark: SparkSession, base: str) -> dict[str, DataFrame] | None:
    """All tables of the newest manifest (without rejects), or None for a new warehouse."""
    rows = read_manifest(spark, base)
    return None if rows is None else {t: read_table(spark, rows, t) for t in TABLES}


def read_rejects(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, read_manifest(spark, base) or [], REJECTS)


def write_dim(df: DataFrame, base: str, table: str, load_id: str) -> tuple:
    return manifest.write_whole(df, base, table, load_id)


def write_fact(df: DataFrame, base: str, load_id: str, sort: bool = True, rows: int | None = None) -> list[tuple]:
    """Write fact rows, and their partials, into one new folder per month each; returns their manifest rows.

    The rows are shuffled once, by month and machine, and kept on the executors' disks while
    the three are written; a lost executor's rows are made again from the files before the
    shuffles.  ``rows`` is about their number, if known.  Without ``sort`` they are written as they
    come, and no partials.
    """
    if not sort:
        return manifest.write_months(layout.with_month(df), base, FACT, load_id)
    placed = layout.placed_fact(df, df.count() if rows is None else rows).persist(StorageLevel.DISK_ONLY)
    try:
        written = manifest.write_months(layout.sorted_within(placed), base, FACT, load_id)
        for name in rollups.KEYS:
            written += manifest.write_months(rollups.partials(placed, name, placed=True), base, name, load_id)
        return written
    finally:
        placed.unpersist()


def with_rollups(spark: SparkSession, base: str, rows: list[tuple], made_before: list[tuple], load_id: str) -> list[tuple]:
    """Manifest rows plus those of the partials made before, and of new ones of all fact months that still lack them."""
    months = {part for t, part, _ in rows if t == FACT}
    out = list(rows)
    for name in rollups.KEYS:
        out += [r for r in made_before if r[0] == name and r[1] in months]
        lack = months - {part for t, part, _ in out if t == name}
        if lack:
            made = rollups.partials(read_table(spark, rows, FACT, lack), name)
            out += manifest.write_months(made, base, name, f"{load_id}-lacking")
    return out


def read_views(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The four views and the drilldown, merged from the partials of all months; the facts are not read.

    Of a warehouse that was published without partials, those of its months are
    made while it is read; the next load writes them.
    """
    rows = read_manifest(spark, base)
    if rows is None:
        raise FileNotFoundError(f"no published warehouse under {base}")
    tables = {t: read_table(spark, rows, t) for t in DIMS}
    for name in rollups.KEYS:
        tables[name] = read_table(spark, rows, name)
        lack = {part for t, part, _ in rows if t == FACT} - {part for t, part, _ in rows if t == name}
        if lack:
            made = rollups.partials(read_table(spark, rows, FACT, lack), name)
            tables[name] = tables[name].unionByName(made.drop(manifest.MONTH))
    return {name: view(tables) for name, view in rollups.VIEWS.items()}


def publish(spark: SparkSession, base: str, tables: dict[str, DataFrame], sort: bool = True) -> list[tuple]:
    """Write whole tables to new folders and make them the warehouse, next to the current others."""
    load_id = uuid.uuid4().hex[:12]
    of_fact = {*rollups.KEYS, LARGEST_KEY, MIRROR, LOADED} if FACT in tables else set()
    rows = [r for r in read_manifest(spark, base) or [] if r[0] not in tables and r[0] not in of_fact]
    for name, df in tables.items():
        rows += write_fact(df, base, load_id, sort) if name == FACT else [write_dim(df, base, name, load_id)]
    if FACT in tables:
        rows = with_rollups(spark, base, rows, [], load_id)
    write_manifest(spark, base, rows)
    return rows


#: Columns that a load takes from the processed zone for each dimension; any other is not of its files.
STAGED = {
    "dim_date": ["date_key", "year", "quarter", "month", "month_name", "week", "day_of_week", "day_name", "is_weekend"],
    "dim_machine": ["machine_id", "machine_name", "machine_type", "is_active", "line_id", "line_name", "plant_id",
                    "plant_name", "plant_location"],
    "dim_shift": ["shift_id", "shift_name", "shift_start", "shift_hours"],
    "dim_product": ["product_id", "product_name", "product_family", "unit_of_measure"],
}


def stage_dim(files: DataFrame, name: str) -> DataFrame:
    """A dimension's columns by name in the warehouse's types; an absent column has its declared default, else NULL."""
    defaults = schemas.COLUMN_DEFAULTS.get(name, {})
    schema = schemas.WAREHOUSE_SCHEMAS[name]

    def column(c: str) -> Column:
        value = F.col(c) if c in files.columns else F.expr(defaults.get(c, "NULL"))
        return value.cast(schema[c].dataType).alias(c)

    return files.select(*[column(c) for c in STAGED[name]])


def read_lake(spark: SparkSession, base: str, rows: list[tuple] | None, start: str | None = None, end: str | None = None,
              months: set[str] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Facts dated within [start, end] and staged dimensions, of a published lake (its manifest ``rows``) or of plain folders.

    ``months`` restricts a published lake to some of its months.
    """
    if rows is None:
        facts = sinks.read_fact(spark, f"{base}/{FACT}", start, end)
        files = {n: spark.read.parquet(f"{base}/{n}") for n in DIMS}
    else:
        within = lake.months_within(rows, start, end)
        facts = lake.read_rows(spark, rows, FACT, within if months is None else within & months)
        facts = facts.where(F.lit(True) if start is None else F.col("production_date") >= F.lit(start).cast("date"))
        facts = facts.where(F.lit(True) if end is None else F.col("production_date") <= F.lit(end).cast("date"))
        files = {n: lake.read_rows(spark, rows, n) for n in DIMS}
    return facts, {n: stage_dim(files[n], n) for n in DIMS}


def changed_months(before: list[tuple], lake_rows: list[tuple]) -> set[str]:
    """Months of a mirrored lake whose folders are not the ones last loaded, and loaded months of no known folder."""
    loaded = dict(part.split(" ", 1) for t, part, _ in before if t == LOADED)
    now = {part: path for t, part, path in lake_rows if t == FACT}
    months = loaded.keys() | now.keys() | {part for t, part, _ in before if t == FACT}
    return {m for m in months if m not in loaded or loaded[m] != now.get(m)}


def run(spark: SparkSession, processed_base: str, warehouse_base: str, start: str | None = None,
        end: str | None = None, load_ts: Column | None = None) -> dict:
    """Load the processed zone, or its runs dated within [start, end], into the warehouse.

    Dimensions are written once and read back for the key lookup.  Of the fact,
    only the months of the staged rows, and those that hold an older version of
    a staged run, are read and rewritten.  They are known from the folders that
    changed where the warehouse mirrors a published lake and all of it is asked for; all
    runs of unchanged months keep their keys and load times then.  Otherwise, the
    older versions are found by a scan of the fact's ids.  Older versions are marked by
    their places in the files, so that the facts that stay are not shuffled by id.
    """
    base, load_id = processed_base.rstrip("/"), uuid.uuid4().hex[:12]
    lake_rows = lake.read_manifest(spark, base)
    before = read_manifest(spark, warehouse_base) or []
    mirror = next(((MIRROR, f"{base} {part}", None) for t, part, _ in lake_rows or [] if t == lake.GENERATION), None)
    mirrors = mirror is not None and (not before or mirror in before)
    changed = changed_months(before, lake_rows) if mirrors and start is None and end is None else None
    staged, stage = read_lake(spark, base, lake_rows, start, end, changed)
    old = {t: read_table(spark, before, t) for t in TABLES} if before else {}
    new = [
        write_dim(wh.insert_dim_date(stage["dim_date"], old.get("dim_date")), warehouse_base, "dim_date", load_id),
        write_dim(wh.upsert_dim_machine(stage["dim_machine"], old.get("dim_machine"), load_ts), warehouse_base,
                  "dim_machine", load_id),
        write_dim(wh.seed_dim_shift(spark, old.get("dim_shift")), warehouse_base, "dim_shift", load_id),
        write_dim(wh.insert_dim_product(stage["dim_product"], old.get("dim_product")), warehouse_base, "dim_product",
                  load_id),
    ]
    dims = {t: read_table(spark, new, t) for t in DIMS}
    resolved = staged_runs(staged, dims)
    ids = staged.select("production_id").where("production_id IS NOT NULL")
    held = {part for t, part, _ in before if t == FACT and (changed is None or part in changed)}
    gone = places.marked(read_table(spark, before, FACT, held), "production_id", ids, _month("date_key")) if held else None
    touched = changed if changed is not None else months_of_runs(staged, gone)
    part = read_table(spark, before, FACT, touched) if old else None
    stay = places.without(part, gone) if held & touched else part
    known = [int(part) for t, part, _ in before if t == LARGEST_KEY]
    key = max(known) if known else wh._next_key(old.get(FACT), "production_sk")
    facts = wh.upsert_fact(resolved, staged, part, load_ts, start=key, written=True, stay=stay)
    at_most = resolved.count() + (part.count() if old else 0)  # from the files' footers
    written = write_fact(facts, warehouse_base, load_id, rows=at_most)
    largest = wh._next_key(read_table(spark, written, FACT), "production_sk") if written else 0
    rejects = wh.fact_rejects(resolved).select(F.lit(load_id).alias("load_id"), "*")
    rejects_path = f"{warehouse_base.rstrip('/')}/{REJECTS}/v-{load_id}"
    rebalanced(rejects).write.mode("errorifexists").parquet(rejects_path)
    sinks.discard(resolved, *([gone] if held else []))
    untouched = [r for r in before if r[1] not in touched]
    new += [r for r in untouched if r[0] in (FACT, REJECTS)] + written
    new = with_rollups(spark, warehouse_base, new, untouched, load_id)
    new += [(LARGEST_KEY, str(max(key, largest)), None), (REJECTS, load_id, rejects_path)]
    if mirrors:
        new.append(mirror)
        if changed is None:  # a period: months that it touched may hold other runs in older versions
            new += [r for r in before if r[0] == LOADED and r[1].split(" ")[0] not in touched]
        else:
            new += [(LOADED, f"{month} {path}", None) for t, month, path in lake_rows if t == FACT]
    write_manifest(spark, warehouse_base, new)
    return {"load_id": load_id, "rejected": spark.read.parquet(rejects_path).count(), "months": touched,
            "verification": wh.load_verification(read_current(spark, warehouse_base))}


def _month(date: str) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("string").alias("m")


def months_of_runs(staged: DataFrame, gone: DataFrame | None) -> set[str]:
    """Months of the staged runs and of their older versions, as marked among the facts."""
    months = staged.select(_month("production_date"))
    if gone is not None:
        months = months.union(gone.select("m"))
    return {r["m"] for r in months.distinct().collect() if r["m"]}  # a row per calendar month


def compact(spark: SparkSession, warehouse_base: str, target_bytes: int = layout.FILE_BYTES) -> list[tuple]:
    """Rewrite the fragmented months of the fact, sorted, and publish them; returns the manifest rows in force.

    A month is fragmented if its files, packed by their sizes in the listing, fit
    into fewer files of ``target_bytes``.  It is rewritten into that many; all
    other months keep their files and are not read.  A month in one file is one task,
    so several months are rewritten at once.  Each rewrite leaves a month
    with fewer files, so repeated runs come to rest; a run that finds nothing to
    pack publishes nothing.
    """
    rows = read_manifest(spark, warehouse_base)
    if rows is None:
        raise FileNotFoundError(f"no published warehouse under {warehouse_base}")
    version = f"{warehouse_base.rstrip('/')}/{FACT}/v-{uuid.uuid4().hex[:12]}"
    fragmented = {}
    for table, part, path in rows:  # a listing per calendar month
        sizes = sinks.file_sizes(spark, path) if table == FACT else []
        files = layout.files_needed(sizes, target_bytes)
        if files < len(sizes):
            fragmented[part] = path, files

    def rewrite(month: str) -> None:
        path, files = fragmented[month]
        facts = spark.read.schema(schemas.WAREHOUSE_SCHEMAS[FACT]).parquet(path)
        packed = layout.packed(facts, files).write.mode("errorifexists").option("compression", "zstd")
        packed.parquet(f"{version}/{manifest.MONTH}={month}")

    with ThreadPoolExecutor(MONTHS_AT_ONCE) as pool:
        list(pool.map(rewrite, fragmented))
    out = [(t, part, f"{version}/{manifest.MONTH}={part}") if t == FACT and part in fragmented else (t, part, path)
           for t, part, path in rows]
    if out != rows:
        write_manifest(spark, warehouse_base, out)
    return out


def reclaim(spark: SparkSession, warehouse_base: str, keep: int = 2) -> list[str]:
    """Delete data folders that none of the ``keep`` newest manifests lists, and older manifests; returns the paths.

    Run it when no reader still uses an older manifest and no load is under way.
    """
    return manifest.reclaim(spark, warehouse_base, [*TABLES, *rollups.KEYS, REJECTS], keep)

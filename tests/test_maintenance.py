"""Damaged raw records, compaction of fragmented months, column statistics."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.operators import dims, layout
from shopfloor.plans import etl, load
from shopfloor.sources import manifest, quarantine, sinks

HEADER = ",".join(schemas.DOWNTIME.names)
GOOD = ["D1,M1,2024-01-15,S1,jam,30.0,N", 'D2,M1,2024-01-15,S1,"",,Y']
BAD = ["D3,M1,2024-01-15,S1,jam,oops,Y", "D4,M2,2024-01-15", "D5,M2,2024-01-15,S2,jam,5.0,N,extra"]


def _folder(path, *files):
    path.mkdir(parents=True)
    for i, lines in enumerate(files):
        (path / f"part-{i}.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def test_kept_and_damaged_records_are_all_records_of_the_files(spark, tmp_path):
    raw = _folder(tmp_path / "raw", [HEADER, GOOD[0], BAD[0], ""], [HEADER, BAD[1], GOOD[1], BAD[2]])
    parts = quarantine.split(spark, raw, schemas.DOWNTIME, str(tmp_path / "out"))
    kept = {r.downtime_id: r for r in parts.kept.collect()}
    assert sorted(kept) == ["D1", "D2"] and kept["D2"].downtime_minutes is None
    assert parts.kept.columns == schemas.DOWNTIME.names
    found = {r.line: r.file for r in parts.damaged.collect()}
    assert sorted(found) == sorted(BAD)
    assert found[BAD[0]].endswith("part-0.csv") and found[BAD[2]].endswith("part-1.csv")
    again = quarantine.read(spark, str(tmp_path / "out"), schemas.DOWNTIME)
    assert (again.kept.count(), again.damaged.count()) == (2, 3)


def test_damaged_json_lines(spark, tmp_path):
    good = {"downtime_id": "D1", "machine_id": "M1", "production_date": "2024-01-15", "shift_id": "S1", "downtime_minutes": 3.0}
    wrong = good | {"downtime_id": "D2", "downtime_minutes": "long"}
    lines = [json.dumps(good), json.dumps(wrong), json.dumps(good)[:-1], "[]", "[{}, {}]", "null"]
    parts = quarantine.split(spark, _folder(tmp_path / "raw", lines), schemas.DOWNTIME, str(tmp_path / "out"), "json")
    assert [r.downtime_id for r in parts.kept.collect()] == ["D1"]
    assert sorted(r.line for r in parts.damaged.collect()) == sorted(lines[1:])
    with pytest.raises(ValueError):
        quarantine.split(spark, str(tmp_path / "raw"), schemas.DOWNTIME, str(tmp_path / "other"), "xml")


def test_files_without_records_give_two_empty_tables(spark, tmp_path):
    parts = quarantine.split(spark, _folder(tmp_path / "raw", [HEADER]), schemas.DOWNTIME, str(tmp_path / "out"))
    assert parts.kept.count() == 0 and parts.damaged.count() == 0


def test_only_the_parts_own_folder_is_read(spark, tmp_path):
    parts = quarantine.split(spark, _folder(tmp_path / "raw", [HEADER, GOOD[0], BAD[0]]), schemas.DOWNTIME, str(tmp_path / "out"))
    plan = parts.kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_state" in plan and "_damaged_line" not in plan


def test_the_job_leaves_damaged_records_in_quarantine(spark, production_df, downtime_df, quality_df, tmp_path):
    base = tmp_path / "raw"
    for name, df in (("production", production_df), ("downtime", downtime_df), ("quality", quality_df)):
        df.coalesce(1).write.option("header", "true").csv(str(base / name))
    (base / "production" / "more.csv").write_text(
        ",".join(schemas.PRODUCTION.names) + "\nw99,north,press,mx-2,S3,bolt,2023-12-31,many,1,1,1.0,1.0\n")
    plain = etl.run(spark, str(base), str(tmp_path / "plain"))
    out = etl.run(spark, str(base), str(tmp_path / "lake"), quarantine=str(tmp_path / "quarantine"))
    assert out["damaged"] == {"production": 1, "downtime": 0, "quality": 0}
    assert out["fact_rows"] == plain["fact_rows"] - 1
    ids = {r.production_id for r in sinks.read_fact(spark, str(tmp_path / "lake" / "fact_production")).collect()}
    assert "w99" not in ids and "w8" in ids


# ── compaction ───────────────────────────────────────────────────────────────


@pytest.mark.parametrize("sizes, files", [
    ([], 0), ([5], 1), ([40], 1), ([5, 5], 1), ([6, 5], 2), ([6, 4, 5, 5], 2), ([40, 3, 3, 3], 2), ([10, 10], 2)])
def test_files_needed(sizes, files):
    assert layout.files_needed(sizes, 10) == files


@settings(deadline=None)
@given(st.lists(st.integers(0, 30)))
def test_files_needed_is_between_the_bytes_and_the_number_of_files(sizes):
    needed = layout.files_needed(sizes, 10)
    assert sum(-(-min(s, 10) // 1) for s in sizes) <= 10 * max(needed, 0) and needed <= len(sizes)


def _cut_warehouse(spark, production_df, downtime_df, quality_df, tmp_path):
    f = etl.build_fact({"production": production_df, "downtime": downtime_df, "quality": quality_df})
    # twenty runs in February 2024, so that its folder can be cut up
    runs = f.where("production_id = 'w8'").crossJoin(spark.range(20)).withColumn(
        "production_id", F.concat("production_id", F.col("id").cast("string"))).drop("id").unionByName(f)
    base, lake = str(tmp_path / "wh"), str(tmp_path / "lake")
    sinks.write_fact(runs, f"{lake}/fact_production")
    sinks.write_dims(dims.all_dims(runs), lake)
    load.run(spark, lake, base)
    rows = load.read_manifest(spark, base)
    cut = layout.with_month(load.read_table(spark, rows, load.FACT, {"202402"})).repartition(5)
    parts = manifest.write_months(cut, base, load.FACT, "cut")
    load.write_manifest(spark, base, [r for r in rows if r[1] != "202402"] + parts)
    return base


def test_only_fragmented_months_are_rewritten(spark, production_df, downtime_df, quality_df, tmp_path):
    base = _cut_warehouse(spark, production_df, downtime_df, quality_df, tmp_path)
    before = {r[1]: r[2] for r in load.read_manifest(spark, base) if r[0] == load.FACT}
    facts = sorted(map(str, load.read_current(spark, base)[load.FACT].collect()))
    assert len(sinks.file_sizes(spark, before["202402"])) > 1
    after = {r[1]: r[2] for r in load.compact(spark, base) if r[0] == load.FACT}
    assert {m for m in before if before[m] != after[m]} == {"202402"}
    assert len(sinks.file_sizes(spark, after["202402"])) == 1
    assert sorted(map(str, load.read_current(spark, base)[load.FACT].collect())) == facts
    published = len(load.manifests(spark, base))
    load.compact(spark, base)  # nothing is fragmented any more
    assert len(load.manifests(spark, base)) == published


def test_large_files_are_left_alone(spark, production_df, downtime_df, quality_df, tmp_path):
    base = _cut_warehouse(spark, production_df, downtime_df, quality_df, tmp_path)
    before = load.read_manifest(spark, base)
    assert load.compact(spark, base, target_bytes=1000) == before  # no two of the files fit into one


def test_a_new_warehouse_cannot_be_compacted(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load.compact(spark, str(tmp_path / "none"))


# ── statistics ───────────────────────────────────────────────────────────────


def test_column_statistics_change_the_planners_estimate(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS stats_of_columns")
    spark.range(1000).select(F.col("id"), F.when(F.col("id") >= 100, F.col("id")).alias("v")).write.parquet(str(tmp_path / "t"))
    table = "stats_of_columns.t"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=str(tmp_path / "t"), source="parquet")
    found = {r.column_name: r for r in layout.column_statistics(spark, table, ["id", "v"]).collect()}
    assert (found["id"].min_value, found["id"].max_value, found["id"].null_count) == ("0", "999", 0)
    assert (found["v"].min_value, found["v"].null_count) == ("100", 100)
    assert 850 < found["v"].distinct_count < 950
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        plan = spark.table(table).where("id < 100")._jdf.queryExecution().optimizedPlan()
        assert 90 <= plan.stats().rowCount().get() <= 110
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
        spark.sql(f"DROP TABLE {table}")

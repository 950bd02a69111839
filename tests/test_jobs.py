"""End-to-end jobs: CSV raw zone → batch ETL → processed zone → warehouse snapshots."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import DOWNTIME_ROWS, PRODUCTION_ROWS, QUALITY_ROWS
from shopfloor import schemas
from shopfloor.operators import quality as dq
from shopfloor.operators import warehouse as wh
from shopfloor.plans import etl, lake, load
from shopfloor.sources import sinks


def _csv(tmp_path, name, schema, rows):
    d = tmp_path / "raw" / name
    d.mkdir(parents=True)
    lines = [",".join(f.name for f in schema.fields)]
    lines += [",".join("" if v is None else str(v) for v in r) for r in rows]
    (d / "part-0.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture
def raw_zone(tmp_path):
    _csv(tmp_path, "production", schemas.PRODUCTION, PRODUCTION_ROWS)
    _csv(tmp_path, "downtime", schemas.DOWNTIME, DOWNTIME_ROWS)
    _csv(tmp_path, "quality", schemas.QUALITY, QUALITY_ROWS)
    return tmp_path


def test_batch_job_and_load(spark, raw_zone):
    out = etl.run(spark, str(raw_zone / "raw"), str(raw_zone / "processed"))
    assert out["fact_rows"] == 5
    raw_failed = {(r.table_name, r.check_name) for r in dq.summary(out["raw_quality"]).collect()}
    assert ("production", "duplicates") in raw_failed  # reported, not raised
    lake = spark.read.parquet(str(raw_zone / "processed" / "fact_production"))
    assert sorted(r.production_id for r in lake.collect()) == ["W7-a", "late", "w7-a", "w7-a ", "w8"]
    res = load.run(spark, str(raw_zone / "processed"), str(raw_zone / "wh"))
    assert res["rejected"] == 0
    ver = {r.table_name: r.row_count for r in res["verification"].collect()}
    assert ver["fact_production"] == 5 and ver["dim_shift"] == 3
    # a second load of the same lake changes nothing but load times
    load.run(spark, str(raw_zone / "processed"), str(raw_zone / "wh"))
    current = load.read_current(spark, str(raw_zone / "wh"))
    ver2 = {r.table_name: r.row_count for r in wh.load_verification(current).collect()}
    assert ver2 == ver


def test_strict_mode_raises_on_raw_duplicates(spark, raw_zone):
    with pytest.raises(dq.DataQualityError, match="duplicate rows on keys"):
        etl.run(spark, str(raw_zone / "raw"), str(raw_zone / "processed"), enforce="strict")


def test_empty_raw_zone_stops_the_job(spark, tmp_path):
    for name, schema in schemas.RAW_SCHEMAS.items():
        _csv(tmp_path, name, schema, [])
    with pytest.raises(dq.DataQualityError, match="DataFrame is empty"):
        etl.run(spark, str(tmp_path / "raw"), str(tmp_path / "processed"))


def _tables(spark, production, downtime, quality):
    rows = {"production": production, "downtime": downtime, "quality": quality}
    return {n: spark.createDataFrame(rows[n], s) for n, s in schemas.RAW_SCHEMAS.items()}


def _zone(spark, base):
    return {t: sorted(map(repr, lake.read(spark, base, t).collect())) for t in ["fact_production", *lake.DIMS]}


def _one_run(spark, tmp_path, production, downtime, quality):
    base = str(tmp_path / f"one-{len(production)}-{len(downtime)}-{len(quality)}")
    lake.update(spark, _tables(spark, production, downtime, quality), base)
    return _zone(spark, base)


def _folders(spark, base):
    return {(t, m): p for t, m, p in lake.read_manifest(spark, base)}


def test_late_and_corrected_records_give_what_one_run_gives(spark, tmp_path):
    base = str(tmp_path / "lake")
    lake.update(spark, _tables(spark, PRODUCTION_ROWS, DOWNTIME_ROWS[:1], QUALITY_ROWS[:1]), base)
    # Late downtime and inspections of loaded runs; nothing else is in the batch.
    made = lake.update(spark, _tables(spark, [], DOWNTIME_ROWS[1:], QUALITY_ROWS[1:]), base)
    assert made["months"] == {"202312", "202401", "202402", "202206"}
    zone = _zone(spark, base)
    assert zone == _one_run(spark, tmp_path, PRODUCTION_ROWS, DOWNTIME_ROWS, QUALITY_ROWS)
    # A run sent again without its downtime keeps it; other months keep their folders.
    before = _folders(spark, base)
    made = lake.update(spark, _tables(spark, PRODUCTION_ROWS[3:5], [], []), base)
    assert made["months"] == {"202402"}
    after = _folders(spark, base)
    assert {k for k in after if k[1] and after[k] != before[k]} == {
        ("fact_production", "202402"), ("members", "202402"), ("kept_production", "202402")}
    assert before.keys() == after.keys()
    assert _zone(spark, base) == zone
    # A corrected date moves a run and a stop to other months, and its old month has no row left.
    moved = ("late", "north", "lathe", "lt-1", "S1", "gear", "2024-02-01", 3, 7, 2, 120.0, 118.0)
    stop = ("stop3", "mx-2", "2023-12-31", "S3", "power", 8.0, "N")
    made = lake.update(spark, _tables(spark, [moved], [stop], []), base)
    assert made["months"] == {"202206", "202312", "202401", "202402"}
    assert ("fact_production", "202206") not in _folders(spark, base)
    production = [r for r in PRODUCTION_ROWS if r[0] != "late"] + [moved]
    downtime = [r for r in DOWNTIME_ROWS if r[0] != "stop3"] + [stop]
    # Undated runs join one another; a run on another line takes its old line's member away.
    undated = [(f"bad{i}", "north", "press", "mx-2", "S3", "bolt", "soon", 1, 1, 1, 1.0, 1.0) for i in range(2)]
    lake.update(spark, _tables(spark, undated[:1], [], []), base)
    other = (*moved[:2], "a-line", *moved[3:])
    lake.update(spark, _tables(spark, [undated[1], other], [], []), base)
    assert _zone(spark, base) == _one_run(
        spark, tmp_path, [r for r in production if r != moved] + [other, *undated], downtime, QUALITY_ROWS)
    lines = {r.machine_id: r.line_id for r in lake.read(spark, base, "dim_machine").collect()}
    assert lines == {"mx-2": "press", "ov-9": "oven", "lt-1": "a-line"}
    # A new warehouse takes the zone as after one run; an empty batch changes nothing.
    assert load.run(spark, base, str(tmp_path / "wh"))["rejected"] == 2  # the undated runs
    manifests = lake.manifest.manifests(spark, base)
    assert lake.update(spark, _tables(spark, [], [], []), base)["months"] == set()
    assert lake.manifest.manifests(spark, base) == manifests
    zone = _zone(spark, base)
    assert lake.reclaim(spark, base, keep=1) and _zone(spark, base) == zone


def test_a_crash_leaves_the_lake_as_it_was(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "lake")
    lake.update(spark, _tables(spark, PRODUCTION_ROWS, DOWNTIME_ROWS, QUALITY_ROWS), base)
    zone, moved = _zone(spark, base), (*PRODUCTION_ROWS[5][:6], "2024-01-05", *PRODUCTION_ROWS[5][7:])
    for step in ("write_months", "write_whole", "write_rows"):
        with monkeypatch.context() as m:
            m.setattr(lake.manifest, step, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                lake.update(spark, _tables(spark, [moved], [], []), base)
        assert _zone(spark, base) == zone
    lake.update(spark, _tables(spark, [moved], [], []), base)
    assert _zone(spark, base) != zone
    # A failed gate publishes nothing.
    zone = _zone(spark, base)
    with pytest.raises(dq.DataQualityError):
        lake.update(spark, _tables(spark, [("x", "a", "b", "m", "S1", "p", "soon", 1, 1, 1, None, None)], [], []), base,
                    gate=None)
    assert _zone(spark, base) == zone


def test_incremental_job_over_files(spark, raw_zone):
    raw, base = str(raw_zone / "raw"), str(raw_zone / "lake")
    out = etl.run(spark, raw, base, incremental=True)
    assert out["fact_rows"] == 5 and out["fact_quality"].where("NOT passed").count() >= 0
    assert load.run(spark, base, str(raw_zone / "wh"))["rejected"] == 0
    etl.run(spark, raw, base, incremental=True)  # the same files once more
    assert load.run(spark, base, str(raw_zone / "wh2"), start="2024-02-01", end="2024-02-29")["rejected"] == 0
    assert load.read_current(spark, str(raw_zone / "wh2"))["fact_production"].count() == 2
    etl.run(spark, raw, str(raw_zone / "plain"))
    with pytest.raises(ValueError, match="plain folders"):
        etl.run(spark, raw, str(raw_zone / "plain"), incremental=True)


def test_catalog_tables_and_views_follow_the_manifest(spark, tmp_path):
    from shopfloor.operators import views
    from shopfloor.sources import catalog

    base, wh_base = str(tmp_path / "lake"), str(tmp_path / "wh")
    db, other = f"pub_{tmp_path.name}".replace("-", "_"), spark.newSession()

    def load_and_publish(production):
        lake.update(spark, _tables(spark, production, DOWNTIME_ROWS, QUALITY_ROWS), base)
        load.run(spark, base, wh_base)
        catalog.publish_warehouse(spark, db, wh_base)
        tables = load.read_current(spark, wh_base)
        for name, view in views.VIEWS.items():
            seen, want = other.sql(f"SELECT * FROM {db}.{name}"), view(tables)
            assert set(seen.columns) == set(want.columns)
            assert sorted(map(repr, seen.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
        return {r[0] for r in other.sql(f"SHOW PARTITIONS {db}.fact_production").collect()}

    assert load_and_publish(PRODUCTION_ROWS) == {f"month_key={m}" for m in (202206, 202312, 202401, 202402)}
    moved = (*PRODUCTION_ROWS[5][:6], "2024-01-05", *PRODUCTION_ROWS[5][7:])  # its old month has no run left
    assert load_and_publish([moved]) == {f"month_key={m}" for m in (202312, 202401, 202402)}
    query = other.sql(f"SELECT machine_id, avg_oee_pct FROM {db}.vw_daily_oee WHERE year = 2024 AND month = 2")
    assert query.count() == 2
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "month_key" in plan.split("PartitionFilters")[1]


def test_staged_dimensions_have_the_declared_columns(spark):
    files = spark.createDataFrame([("m1", "l1", "p1", 7)], "machine_id string, line_id string, plant_id string, extra int")
    row = load.stage_dim(files, "dim_machine").first().asDict()
    assert row == {"machine_id": "m1", "machine_name": None, "machine_type": None, "is_active": True, "line_id": "l1",
                   "line_name": None, "plant_id": "p1", "plant_name": None, "plant_location": None}
    product = load.stage_dim(spark.createDataFrame([("x",)], "product_id string"), "dim_product").first()
    assert product["unit_of_measure"] == "PCS" and product["product_name"] is None


def test_job_reads_the_streamed_parquet_copy(spark, raw_zone):
    from shopfloor.streaming import ingest

    ingest.ingest_available(spark, str(raw_zone / "raw"), str(raw_zone / "raw_pq"), str(raw_zone / "ckpt"))
    from_csv = etl.run(spark, str(raw_zone / "raw"), str(raw_zone / "p_csv"))
    from_pq = etl.run(spark, str(raw_zone / "raw_pq"), str(raw_zone / "p_pq"), fmt="parquet")
    assert from_csv["fact_rows"] == from_pq["fact_rows"] == 5
    cols = [c for c in schemas.FACT_COLUMNS]
    a = sorted(map(tuple, spark.read.parquet(str(raw_zone / "p_csv" / "fact_production")).select(*cols).collect()))
    b = sorted(map(tuple, spark.read.parquet(str(raw_zone / "p_pq" / "fact_production")).select(*cols).collect()))
    assert a == b


def test_declared_lake_types_are_those_of_the_fact(spark, raw_zone):
    etl.run(spark, str(raw_zone / "raw"), str(raw_zone / "processed"))
    written = spark.read.parquet(str(raw_zone / "processed" / "fact_production"))
    read = sinks.read_fact(spark, str(raw_zone / "processed" / "fact_production"))
    assert dict(read.dtypes) == dict(written.dtypes)
    assert read.count() == 5


def test_a_load_of_nothing_keeps_the_warehouse(spark, raw_zone):
    lake, base = str(raw_zone / "processed"), str(raw_zone / "wh")
    etl.run(spark, str(raw_zone / "raw"), lake)
    load.run(spark, lake, base)
    none = etl.build_lake({n: spark.createDataFrame([], s) for n, s in schemas.RAW_SCHEMAS.items()}, enforce="off")
    etl.write_lake(none, str(raw_zone / "none"))
    assert load.run(spark, str(raw_zone / "none"), base)["rejected"] == 0
    assert load.read_current(spark, base)["fact_production"].count() == 5
    assert load.run(spark, lake, base, start="1990-01-01", end="1990-12-31")["rejected"] == 0
    assert load.read_current(spark, base)["fact_production"].count() == 5

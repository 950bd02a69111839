from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import DOWNTIME_ROWS, PRODUCTION_ROWS, QUALITY_ROWS
from shopfloor import schemas
from shopfloor.operators import aggregate, clean, dims, fact, rollups, views
from shopfloor.operators import warehouse as wh
from shopfloor.plans import lake as published
from shopfloor.plans import load
from shopfloor.sources import sinks


def _ts(month):
    return F.lit(dt.datetime(2024, month, 1, 0, 0, 0))


def _lake(production_df, downtime_df, quality_df):
    p = clean.clean_production(production_df)
    f = fact.fact_production(p, aggregate.agg_downtime(clean.clean_downtime(downtime_df)),
                             aggregate.agg_quality(clean.clean_quality(quality_df)))
    return f, dims.all_dims(f)


def test_dim_machine_upsert_keeps_keys(spark, production_df, downtime_df, quality_df):
    _, d = _lake(production_df, downtime_df, quality_df)
    first = wh.upsert_dim_machine(d["dim_machine"], None, _ts(1)).checkpoint()
    keys1 = {r.machine_id: r.machine_key for r in first.collect()}
    assert keys1 == {"lt-1": 1, "mx-2": 2, "ov-9": 3}
    extra = spark.createDataFrame([("aa-0", "saw", "west", "Machine-aa-0", "Line-saw", "Plant 001", "CNC", True)],
                                  d["dim_machine"].schema)
    second = wh.upsert_dim_machine(d["dim_machine"].unionByName(extra), first, _ts(2))
    rows = {r.machine_id: r for r in second.collect()}
    assert {k: rows[k].machine_key for k in keys1} == keys1  # existing members keep their key
    assert rows["aa-0"].machine_key == 4  # new member continues after the largest key
    assert rows["mx-2"].created_at == dt.datetime(2024, 1, 1) and rows["mx-2"].updated_at == dt.datetime(2024, 2, 1)


def test_upsert_twice_equals_once(spark, production_df, downtime_df, quality_df):
    f, d = _lake(production_df, downtime_df, quality_df)
    once = load.load(spark, f, d, None, _ts(1))
    once = {k: v.checkpoint() for k, v in once.items()}
    twice = load.load(spark, f, d, {k: v for k, v in once.items() if k != "rejects"}, _ts(1))
    for t in ["dim_machine", "dim_shift", "dim_product", "dim_date"]:
        a = sorted(map(tuple, once[t].collect()))
        b = sorted(map(tuple, twice[t].collect()))
        assert a == b, t
    cols = [c for c in once["fact_production"].columns if c not in ("production_sk", "loaded_at")]
    a = sorted(map(tuple, once["fact_production"].select(*cols).collect()))
    b = sorted(map(tuple, twice["fact_production"].select(*cols).collect()))
    assert a == b


def test_loaded_plus_rejected_equals_staged(spark, production_df, downtime_df, quality_df):
    f, d = _lake(production_df, downtime_df, quality_df)
    out = load.load(spark, f, d)
    assert out["fact_production"].count() + out["rejects"].count() == f.count()
    sks = [r.production_sk for r in out["fact_production"].collect()]
    assert sorted(sks) == list(range(1, len(sks) + 1))


def test_unknown_shift_rejected(spark, production_df, downtime_df, quality_df):
    p = production_df.withColumn("shift_id", F.when(F.col("production_id") == "late", "S9").otherwise(F.col("shift_id")))
    f, d = _lake(p, downtime_df, quality_df)
    rejects = {r.production_id: r.reject_reason for r in load.load(spark, f, d)["rejects"].collect()}
    assert rejects == {"late": "unknown shift_id"}


def test_dim_shift_seed_idempotent(spark):
    once = wh.seed_dim_shift(spark)
    twice = wh.seed_dim_shift(spark, once.checkpoint())
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert [r.shift_key for r in once.orderBy("shift_key").collect()] == [1, 2, 3]


def test_conform_overflow_is_rejected(spark, production_df, downtime_df, quality_df):
    f, d = _lake(production_df, downtime_df, quality_df)
    big = f.withColumn("actual_runtime_min", F.when(F.col("production_id") == "w8", F.lit(1e12))
                       .otherwise(F.col("actual_runtime_min")))
    rejects = {r.production_id: r.reject_reason for r in load.load(spark, big, d)["rejects"].collect()}
    assert rejects == {"w8": "measure out of warehouse range"}


def _files(base):
    return {str(p.relative_to(base)): p.stat().st_mtime_ns for p in base.rglob("*.parquet")}


def _write_lake(f, d, path):
    sinks.write_fact(f, str(path / "fact_production"))
    sinks.write_dims(d, str(path))
    return str(path)


def test_load_publishes_all_tables_and_rejects(spark, production_df, downtime_df, quality_df, tmp_path):
    p = production_df.withColumn("shift_id", F.when(F.col("production_id") == "late", "S9").otherwise(F.col("shift_id")))
    lake = _write_lake(*_lake(p, downtime_df, quality_df), tmp_path / "lake")
    base = str(tmp_path / "wh")
    assert load.read_current(spark, base) is None
    out = load.run(spark, lake, base)
    ver = {r.table_name: r.row_count for r in out["verification"].collect()}
    assert ver == {"dim_date": 4, "dim_machine": 3, "dim_product": 3, "dim_shift": 3, "fact_production": 4}
    rejects = load.read_rejects(spark, base).collect()
    assert [(r.load_id, r.production_id, r.reject_reason) for r in rejects] == [
        (out["load_id"], "late", "unknown shift_id")]
    load.compact(spark, base)
    assert load.read_current(spark, base)["fact_production"].count() == 4
    assert load.read_rejects(spark, base).count() == 1


def test_a_period_load_leaves_other_months_alone_and_reclaim_keeps_them(spark, production_df, downtime_df, quality_df, tmp_path):
    f, d = _lake(production_df, downtime_df, quality_df)
    lake, base = _write_lake(f, d, tmp_path / "lake"), tmp_path / "wh"
    load.run(spark, lake, str(base))
    before = _files(base / "fact_production")
    keys = {r.production_id: r.production_sk for r in load.read_current(spark, str(base))["fact_production"].collect()}
    changed = f.withColumn("actual_qty", F.when(F.col("production_id") == "w8", 73).otherwise(F.col("actual_qty")))
    # "w7-a " moves from February to March
    moved = changed.withColumn("production_date", F.when(F.col("production_id") == "w7-a ", F.lit("2024-03-01").cast("date"))
                               .otherwise(F.col("production_date"))).withColumn("month", F.month("production_date"))
    lake2 = _write_lake(moved, dims.all_dims(moved), tmp_path / "lake2")
    load.run(spark, lake2, str(base), start="2024-02-01", end="2024-03-31")
    after = _files(base / "fact_production")
    assert all(after[k] == v for k, v in before.items())
    rows = {r.production_id: r for r in load.read_current(spark, str(base))["fact_production"].collect()}
    assert sorted(rows) == sorted(keys)
    assert {k: rows[k].production_sk for k in ("W7-a", "late", "w7-a")} == {k: keys[k] for k in ("W7-a", "late", "w7-a")}
    assert rows["w8"].actual_qty == 73 and rows["w8"].production_sk > max(keys.values())
    assert str(rows["w7-a "].date_key) == "2024-03-01"
    months = [m for t, m, _ in load.read_manifest(spark, str(base)) if t == "fact_production"]
    assert sorted(months) == ["202206", "202312", "202401", "202402", "202403"]
    assert load.reclaim(spark, str(base), keep=2) == []
    dropped = load.reclaim(spark, str(base), keep=1)
    assert any("month_key=202402" in p for p in dropped) and not any("month_key=202312" in p for p in dropped)
    assert load.read_current(spark, str(base))["fact_production"].count() == 5


def test_a_crash_before_the_manifest_leaves_the_old_warehouse(spark, production_df, downtime_df, quality_df, tmp_path, monkeypatch):
    lake, base = _write_lake(*_lake(production_df, downtime_df, quality_df), tmp_path / "lake"), str(tmp_path / "wh")
    load.run(spark, lake, base)
    before = load.read_manifest(spark, base)

    def crash(*args, **kw):
        raise OSError("lost connection")

    for step in ("write_fact", "write_manifest"):
        with monkeypatch.context() as m:
            m.setattr(load, step, crash)
            with pytest.raises(OSError):
                load.run(spark, lake, base)
        assert load.read_manifest(spark, base) == before
    # a manifest without _SUCCESS was not finished: the last complete one stays in force
    (tmp_path / "wh" / "_manifests" / "999999999999-x").mkdir()
    assert load.read_manifest(spark, base) == before
    load.run(spark, lake, base)
    assert load.read_current(spark, base)["fact_production"].count() == 5


def test_a_damaged_manifest_is_an_error_not_an_empty_warehouse(spark, production_df, downtime_df, quality_df, tmp_path, monkeypatch):
    lake, base = _write_lake(*_lake(production_df, downtime_df, quality_df), tmp_path / "lake"), str(tmp_path / "wh")
    load.run(spark, lake, base)
    rows = load.read_manifest(spark, base)
    load.write_manifest(spark, base, [r for r in rows if r[0] != "dim_shift"])
    with pytest.raises(RuntimeError, match="dim_shift"):
        load.run(spark, lake, base)
    load.write_manifest(spark, base, [(t, p, path + "-gone" if t == "dim_date" else path) for t, p, path in rows])
    with pytest.raises(RuntimeError, match="do not exist"):
        load.read_current(spark, base)

    def denied(*args):
        raise PermissionError("denied")

    monkeypatch.setattr(load.sinks, "exists", denied)
    with pytest.raises(PermissionError):
        load.run(spark, lake, base)


def test_a_dimension_value_that_does_not_fit_stops_the_load(spark):
    stage = spark.createDataFrame([(dt.date(2024, 1, 1), 70000, 1, 1, "January", 1, 2, "Monday", False)],
                                  "date_key date, year int, quarter int, month int, month_name string, week int, "
                                  "day_of_week int, day_name string, is_weekend boolean")
    with pytest.raises(Exception, match="year: value does not fit smallint: 70000"):
        wh.insert_dim_date(stage).collect()


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from shopfloor.session import checkpoint_dir

    class Cluster:
        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Cluster)


def _batch(spark, production=(), downtime=(), quality=()):
    rows = {"production": production, "downtime": downtime, "quality": quality}
    return {n: spark.createDataFrame(list(rows[n]), s) for n, s in schemas.RAW_SCHEMAS.items()}


def _same_views(spark, base):
    """The views merged from partials equal those of the facts; returns the facts by id."""
    tables = load.read_current(spark, base)
    whole = {**{n: v(tables) for n, v in views.VIEWS.items()},
             "drilldown": views.drilldown(tables["fact_production"], tables["dim_machine"])}
    merged = load.read_views(spark, base)
    assert merged.keys() == whole.keys()
    for name, want in whole.items():
        assert merged[name].dtypes == want.dtypes, name
        assert sorted(map(repr, merged[name].collect())) == sorted(map(repr, want.collect())), name
    rows = tables["fact_production"].collect()
    assert len({r.production_sk for r in rows}) == len(rows) == len({r.production_id for r in rows})
    return {r.production_id: r for r in rows}


def _damage(base, *months):
    """Overwrite the data files of all months of a table but these."""
    files = [p for p in base.rglob("*.parquet") if p.parent.name.split("=")[1] not in months]
    assert files
    for p in files:
        p.write_bytes(b"not a parquet file")


def _moved(row, day, qty=72):
    return (*row[:6], day, row[7], qty, *row[9:])


def test_a_whole_load_reads_changed_months_alone(spark, tmp_path):
    base, wh_base = str(tmp_path / "lake"), str(tmp_path / "wh")
    published.update(spark, _batch(spark, PRODUCTION_ROWS, DOWNTIME_ROWS, QUALITY_ROWS), base)
    load.run(spark, base, wh_base, load_ts=_ts(1))
    first = _same_views(spark, wh_base)
    # "w8" moves from February 2024 to January: two months change; the files of all others are destroyed.
    published.update(spark, _batch(spark, [_moved(PRODUCTION_ROWS[3], "2024-01-31")]), base)
    for table in (tmp_path / "lake" / "fact_production", *(tmp_path / "wh" / t for t in ("fact_production", *rollups.KEYS))):
        _damage(table, "202401", "202402")
    out = load.run(spark, base, wh_base, load_ts=_ts(2))
    assert out["months"] == {"202401", "202402"} and out["rejected"] == 0
    rows = load.read_manifest(spark, wh_base)
    seen = {r.production_id: r for r in load.read_table(spark, rows, load.FACT, out["months"]).collect()}
    assert sorted(seen) == ["W7-a", "w7-a ", "w8"] and str(seen["w8"].date_key) == "2024-01-31"
    assert min(r.production_sk for r in seen.values()) > max(r.production_sk for r in first.values())
    # Nothing new: no month is read or written.
    assert load.run(spark, base, wh_base)["months"] == set()
    assert [r for r in load.read_manifest(spark, wh_base) if r[0] == load.FACT] == [r for r in rows if r[0] == load.FACT]


def test_views_of_partials_follow_moves_rejects_and_periods(spark, tmp_path):
    base, wh_base = str(tmp_path / "lake"), str(tmp_path / "wh")
    published.update(spark, _batch(spark, PRODUCTION_ROWS, DOWNTIME_ROWS[:2], QUALITY_ROWS), base)
    load.run(spark, base, wh_base)
    _same_views(spark, wh_base)
    # "late" leaves its month empty; late downtime; "w8" now has a shift that the warehouse does not know.
    unknown = (*PRODUCTION_ROWS[3][:4], "S9", *PRODUCTION_ROWS[3][5:])
    published.update(spark, _batch(spark, [_moved(PRODUCTION_ROWS[5], "2024-01-05"), unknown], DOWNTIME_ROWS[2:]), base)
    assert load.run(spark, base, wh_base)["rejected"] == 1
    rows = _same_views(spark, wh_base)
    assert sorted(rows) == ["W7-a", "late", "w7-a", "w7-a "]
    assert {m for t, m, _ in load.read_manifest(spark, wh_base) if t == "rollup_shift"} == {"202312", "202401", "202402"}
    # Two runs move; a load of a period takes one of them, the next whole load the other, each id once.
    published.update(spark, _batch(spark, [_moved(PRODUCTION_ROWS[5], "2024-03-05"), _moved(PRODUCTION_ROWS[0], "2024-04-01"),
                                           PRODUCTION_ROWS[3]]), base)
    load.run(spark, base, wh_base, start="2024-03-01", end="2024-03-31")
    rows = _same_views(spark, wh_base)
    assert str(rows["late"].date_key) == "2024-03-05" and str(rows["w7-a"].date_key) == "2023-12-31" and "w8" not in rows
    load.run(spark, base, wh_base)
    rows = _same_views(spark, wh_base)
    assert str(rows["w7-a"].date_key) == "2024-04-01" and sorted(rows) == ["W7-a", "late", "w7-a", "w7-a ", "w8"]
    dropped = load.reclaim(spark, wh_base, keep=1)
    assert any("/rollup_shift/" in p for p in dropped)
    assert _same_views(spark, wh_base) == rows


def test_a_warehouse_of_several_lakes_looks_for_older_versions_by_id(spark, production_df, downtime_df, quality_df, tmp_path):
    base, wh_base = str(tmp_path / "lake"), str(tmp_path / "wh")
    load.run(spark, _write_lake(*_lake(production_df, downtime_df, quality_df), tmp_path / "plain"), wh_base)
    published.update(spark, _batch(spark, [_moved(PRODUCTION_ROWS[3], "2024-05-01")]), base)
    load.run(spark, base, wh_base)
    assert str(_same_views(spark, wh_base)["w8"].date_key) == "2024-05-01"
    # A replaced lake is another one: the ids it no longer has may be anywhere in the warehouse.
    other = str(tmp_path / "mirror")
    load.run(spark, base, other)
    published.update(spark, _batch(spark, [PRODUCTION_ROWS[0]]), base, replace=True)
    load.run(spark, base, other)
    published.update(spark, _batch(spark, [_moved(PRODUCTION_ROWS[3], "2024-06-01")]), base)
    load.run(spark, base, other)
    rows = _same_views(spark, other)
    assert {k: str(r.date_key) for k, r in rows.items()} == {"w7-a": "2023-12-31", "w8": "2024-06-01"}


def test_partials_are_made_for_a_warehouse_without_them(spark, production_df, downtime_df, quality_df, tmp_path):
    lake, base = _write_lake(*_lake(production_df, downtime_df, quality_df), tmp_path / "lake"), str(tmp_path / "wh")
    load.run(spark, lake, base)
    load.write_manifest(spark, base, [r for r in load.read_manifest(spark, base) if r[0] not in rollups.KEYS])
    _same_views(spark, base)
    load.run(spark, lake, base, start="1990-01-01", end="1990-12-31")  # changes no month
    assert {m for t, m, _ in load.read_manifest(spark, base) if t == "rollup_product"} == {"202206", "202312", "202401", "202402"}
    _same_views(spark, base)
    load.publish(spark, base, load.load(spark, *_lake(production_df, downtime_df, quality_df)))
    _same_views(spark, base)

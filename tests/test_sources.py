from __future__ import annotations

import contextlib
import io

import pytest

from shopfloor import schemas
from shopfloor.sources import catalog, raw, sinks
from shopfloor.streaming import ingest

HEADER = ",".join(f.name for f in schemas.DOWNTIME.fields)


def _write(tmp_path, name, text):
    d = tmp_path / name
    d.mkdir()
    (d / "part.csv").write_text(text)
    return str(d)


def test_csv_permissive_parsing(spark, tmp_path):
    text = "\n".join([
        HEADER,
        'D1,M1,2024-01-15,S1,Mechanical,30.0,N',
        'D2,M1,2024-01-15,S1,"",oops,Y',          # quoted empty → NULL, bad double → NULL
        'D3,M2,2024-01-15',                        # short row → trailing NULLs
        'D4,M2,2024-01-15,S2,Other,5.0,N,extra',   # extra token dropped
        'D5,M2,2024-01-15,S2,Other,NaN,N',         # text NaN → NaN double
    ])
    rows = {r.downtime_id: r for r in raw.read_downtime(spark, _write(tmp_path, "dt", text)).collect()}
    assert rows["D2"].downtime_reason is None and rows["D2"].downtime_minutes is None
    assert rows["D3"].shift_id is None and rows["D3"].is_planned is None
    assert rows["D4"].is_planned == "N"
    assert rows["D5"].downtime_minutes != rows["D5"].downtime_minutes  # NaN


def test_csv_reordered_header(spark, tmp_path):
    cols = [f.name for f in schemas.DOWNTIME.fields]
    swapped = [cols[1], cols[0]] + cols[2:]
    path = _write(tmp_path, "dt2", ",".join(swapped) + "\nM1,D1,2024-01-15,S1,r,1.0,Y\n")
    # default: positional binding (values shift silently)
    assert raw.read_downtime(spark, path).first().downtime_id == "M1"
    # enforce_header: header names are checked against the schema
    with pytest.raises(Exception):
        raw.read_downtime(spark, path, enforce_header=True).collect()


def test_json_wrong_type_becomes_null(spark, tmp_path):
    d = tmp_path / "js"
    d.mkdir()
    (d / "a.json").write_text('{"downtime_id": "D1", "machine_id": "M1", "downtime_minutes": "abc"}\n'
                              '{"downtime_id": "D2", "machine_id": "M1", "downtime_minutes": 4.5}\n')
    rows = {r.downtime_id: r.downtime_minutes for r in raw.read_downtime(spark, str(d), fmt="json").collect()}
    assert rows == {"D1": None, "D2": 4.5}


def test_partitioned_fact_sink_and_pruning(spark, production_df, downtime_df, quality_df, tmp_path):
    from shopfloor.operators import aggregate, clean, fact

    f = fact.fact_production(clean.clean_production(production_df),
                             aggregate.agg_downtime(clean.clean_downtime(downtime_df)),
                             aggregate.agg_quality(clean.clean_quality(quality_df)))
    path = str(tmp_path / "fact")
    assert sinks.write_fact(f, path) == 5
    df = sinks.read_fact(spark, path, "2024-01-16", "2024-02-29")
    assert df.count() == 2
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    scan = [line for line in buf.getvalue().splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [" in scan and "year" in scan.split("PartitionFilters:")[1]
    table = catalog.register_fact(spark, "sf_test_processed", path)
    assert spark.table(table).count() == 5


def test_schema_drift_report(spark):
    from pyspark.sql.types import StringType, StructField, StructType

    old = schemas.DOWNTIME
    new = StructType(list(old.fields) + [StructField("line_id", StringType(), True)])  # copy, not .add()
    drift = {r.column_name: (r.change, r.action) for r in catalog.schema_drift(spark, old, new).collect()}
    assert drift == {"line_id": ("added", "update")}


def test_stream_ingest_is_incremental(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + "\nD1,M1,2024-01-15,S1,r,1.0,Y\n")
    out, ck = str(tmp_path / "pq"), str(tmp_path / "ck")
    ingest.start_ingest(spark, str(src), out, ck, "downtime").awaitTermination()
    (src / "b.csv").write_text(HEADER + "\nD2,M1,2024-01-16,S1,r,2.0,N\n")
    ingest.start_ingest(spark, str(src), out, ck, "downtime").awaitTermination()
    got = sorted(r.downtime_id for r in ingest.read_parquet_copy(spark, out, "downtime").collect())
    assert got == ["D1", "D2"]  # each file once


def test_full_overwrite_drops_stale_partitions(spark, tmp_path):
    out = str(tmp_path / "ow")
    old = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "id int, year int, month int")
    new = spark.createDataFrame([(3, 2024, 3)], "id int, year int, month int")
    # Even with a session-wide dynamic default, a full overwrite replaces the folder.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.write_parquet(old, out, ["year", "month"])
        sinks.write_parquet(new, out, ["year", "month"])
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == [3]
        sinks.write_parquet(old, out, ["year", "month"], dynamic=True)
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_star_schema_checks_lengths_and_fills_defaults(spark, tmp_path):
    catalog.create_star_schema(spark, "sf_test_star", str(tmp_path / "star"))
    spark.sql("INSERT INTO sf_test_star.dim_product (product_key, product_id, product_name, product_family) "
              "VALUES (1, 'bolt', 'Bolt', 'steel')")
    assert spark.table("sf_test_star.dim_product").first().unit_of_measure == "PCS"
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        spark.sql("INSERT INTO sf_test_star.dim_product (product_key, product_id) VALUES (2, repeat('x', 51))")
    for t in ("dim_date", "dim_machine", "dim_shift", "dim_product", "fact_production"):
        spark.sql(f"DROP TABLE sf_test_star.{t}")


def test_new_columns_in_files_reach_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(path)
    catalog.ensure_database(spark, "sf_test_drift")
    spark.sql("DROP TABLE IF EXISTS sf_test_drift.t")
    spark.catalog.createTable("sf_test_drift.t", path=path, source="parquet")
    spark.createDataFrame([(2, "b", 2.5)], "id int, x string, y double").write.mode("append").parquet(path)
    drift = catalog.update_from_files(spark, "sf_test_drift.t", path)
    assert [(r.column_name, r.change) for r in drift.collect()] == [("y", "added")]
    assert sorted(map(tuple, spark.table("sf_test_drift.t").collect())) == [(1, "a", None), (2, "b", 2.5)]
    assert catalog.update_from_files(spark, "sf_test_drift.t", path).count() == 0


def test_streamed_copy_keeps_declared_types_and_month_folders(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + "\nD1,M1,2024-01-15,S1,r,1.0,Y\nD2,M1,2024-01-16,S1,r,1.0,Y\nD3,M1,nonsense,S1,r,1.0,Y\n")
    out = tmp_path / "pq"
    ingest.start_ingest(spark, str(src), str(out), str(tmp_path / "ck"), "downtime").awaitTermination()
    got = ingest.read_parquet_copy(spark, str(out), "downtime")
    assert got.schema["production_date"].dataType.simpleString() == "string"
    assert sorted(r.production_date for r in got.collect()) == ["2024-01-15", "2024-01-16", "nonsense"]
    assert sorted(p.name for p in out.glob("ingest_month=*")) == ["ingest_month=2024-01", "ingest_month=undated"]

"""Plans that keep rows from being shuffled more often than the job needs."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.functions import round2
from shopfloor.operators import aggregate, clean, dims, fact, layout, rollups, warehouse
from shopfloor.operators.ordered import dense_key
from shopfloor.plans import load


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def _whole_plan(spark, df) -> str:
    """The optimized plan with all columns of every step."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_dense_key_shuffles_only_for_readers_of_the_key(spark):
    ids = [f"r{i % 7}-{i}" for i in range(200)] + [None]
    keyed = dense_key(spark.createDataFrame([(v, 1) for v in ids], "id string, x int"), "k", "id", 5, num_partitions=9)
    got = {r.id: r.k for r in keyed.collect()}
    assert got == {v: 6 + i for i, v in enumerate([None, *sorted(ids[:-1])])}
    assert "Exchange" in _plan(keyed) and "Exchange" not in _plan(keyed.select("x"))


def test_dense_key_numbers_rows_that_share_a_value(spark):
    df = spark.createDataFrame([("a", i) for i in range(30)] + [("b", i) for i in range(3)], "id string, x int")
    keyed = dense_key(df, "k", "id", num_partitions=4)
    first = sorted(map(tuple, keyed.collect()))
    assert sorted(r[2] for r in first) == list(range(1, 34)) and {r[2] for r in first if r[0] == "b"} == {31, 32, 33}
    assert sorted(map(tuple, keyed.repartition(3).collect())) == first  # the same keys on every read


def test_a_load_resolves_runs_once(spark, production_df, downtime_df, quality_df):
    runs = clean.clean_production(production_df)
    facts = fact.fact_production(runs, aggregate.agg_downtime(clean.clean_downtime(downtime_df)),
                                 aggregate.agg_quality(clean.clean_quality(quality_df)))
    made = load.load(spark, facts, dims.all_dims(runs))
    assert "Join" not in _plan(made["rejects"])  # read from the resolved runs
    assert made["fact_production"].count() + made["rejects"].count() == facts.count()


def test_partials_shuffle_facts_once(spark):
    days = ("date_key", "loaded_at")
    day, number = F.date_add(F.lit("1997-01-05"), F.col("id").cast("int")), F.col("id").cast("string")
    rows = spark.range(3).select(*[(day if f.name in days else number).cast(f.dataType).alias(f.name)
                                   for f in schemas.FACT_PRODUCTION])
    for name in rollups.KEYS:
        plan = rollups.partials(rows, name)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "rangepartitioning" in plan, plan


def test_round2_of_hundredths(spark):
    values = [0.0, -0.0, 0.29, 1.15, -2.675, 99.99, 12345678.9, 1e11, -1e11, 0.005, 1e300, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r.r for r in df.select("i", round2(F.col("x")).alias("r")).orderBy("i").collect()]
    assert got == [0.0, 0.0, 0.29, 1.15, -2.68, 99.99, 12345678.9, 1e11, -1e11, 0.01, 1e300, float("inf"), None, None]
    assert str(got[1]) == "0.0"


def test_measures_are_conformed_below_the_key_lookups(spark, production_df, downtime_df, quality_df):
    """Above them, values, flag and reasons became one method, too large to be compiled."""
    runs = clean.clean_production(production_df)
    facts = fact.fact_production(runs, aggregate.agg_downtime(clean.clean_downtime(downtime_df)),
                                 aggregate.agg_quality(clean.clean_quality(quality_df)))
    dim = dims.all_dims(runs)
    resolved = warehouse.resolve_fact(facts, warehouse.upsert_dim_machine(dim["dim_machine"]), warehouse.seed_dim_shift(spark),
                                      warehouse.insert_dim_product(dim["dim_product"]))
    plan = _whole_plan(spark, resolved)
    assert -1 < plan.find("Join LeftOuter") < plan.find("AS _overflow"), plan


def test_a_fact_is_keyed_and_staged_without_columns_of_the_lake_alone(spark, production_df, downtime_df, quality_df):
    runs = clean.clean_production(production_df)
    facts = fact.fact_production(runs, aggregate.agg_downtime(clean.clean_downtime(downtime_df)),
                                 aggregate.agg_quality(clean.clean_quality(quality_df)))
    made = load.load(spark, facts, dims.all_dims(runs))["fact_production"]
    plan = _whole_plan(spark, made)
    hashed = plan.split("xxhash64(")[1].split(")")[0]
    assert "oee_pct" in hashed and "machine_id" not in hashed and "reject_reason" not in hashed, hashed
    assert "production_sk" in plan and "plant_id" not in plan and "line_id" not in plan


def test_conformed_measures_are_those_of_round2(spark):
    values = [0.0, -0.0, 0.005, 1.015, -2.675, 94.2276875, 9999.994, 9999.995, 99999999.994, 99999999.995, 123456789.12,
              1e11, 1e27, 1e29, 1e300, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    events = {"downtime_events": 1} | dict.fromkeys(warehouse.INT_COLS, 1)
    rows = df.select("i", *[F.col("x").alias(c) for c in warehouse.MINUTE_COLS + warehouse.PERCENT_COLS],
                     *[F.lit(v).alias(c) for c, v in events.items()])
    got = warehouse.conform_measures(rows).orderBy("i").collect()
    want = df.select(round2(F.col("x")).try_cast(schemas.MINUTES).alias("m"), round2(F.col("x")).try_cast(schemas.PERCENT).alias("p"),
                     "i").orderBy("i").collect()
    assert [(r.actual_runtime_min, r.oee_pct) for r in got] == [(r.m, r.p) for r in want]
    assert [r._overflow for r in got] == [v is not None and (r.m is None or r.p is None) for v, r in zip(values, want)]


def test_a_month_packed_into_one_file_is_not_shuffled(spark, tmp_path):
    columns = [F.col("id").cast("string").cast(f.dataType).alias(f.name) if f.name not in ("date_key", "loaded_at")
               else F.lit("1997-01-05").cast(f.dataType).alias(f.name) for f in schemas.FACT_PRODUCTION]
    spark.range(40).repartition(5).select(*columns).write.parquet(f"{tmp_path}/month")
    month = spark.read.parquet(f"{tmp_path}/month")
    one, more = layout.packed(month, 1), layout.packed(month, 3)
    assert "Exchange" not in _plan(one) and "Exchange" in _plan(more)
    assert [r.machine_key for r in one.collect()] == list(range(40))
    assert sorted(map(tuple, more.collect())) == sorted(map(tuple, month.collect()))


def test_a_load_shuffles_its_facts_once_for_files_and_partials(spark, tmp_path, monkeypatch):
    days = ("date_key", "loaded_at")
    day, number = F.date_add(F.lit("1997-01-05"), (F.col("id") * 9).cast("int")), (F.col("id") % 40).cast("string")
    facts = spark.range(200).select(*[(day if f.name in days else number).cast(f.dataType).alias(f.name)
                                      for f in schemas.FACT_PRODUCTION])
    asked, write_months = [], load.manifest.write_months

    def noted(df, base, table, run_id):
        df.count()  # so that the plan is the one after the rows were kept
        plan = df.groupBy().count() if table == load.FACT else df
        plan.collect()
        asked.append((table, plan._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]))
        return write_months(df, base, table, run_id)

    monkeypatch.setattr(load.manifest, "write_months", noted)
    rows = load.publish(spark, str(tmp_path), {"fact_production": facts})
    assert [t for t, _ in asked] == ["fact_production", *rollups.KEYS]
    for table, plan in asked[1:]:
        assert "Aggregate" in plan and "InMemoryTableScan" in plan and "Exchange" not in plan, plan
    for name in rollups.KEYS:
        columns = [*rollups.SCHEMAS[name].names]
        got = load.read_table(spark, rows, name).select(columns)
        want = rollups.partials(facts, name).select(columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert load.read_table(spark, rows, "fact_production").count() == 200
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_staged_runs_keep_natural_keys_of_rejects_alone(spark, production_df, downtime_df, quality_df):
    runs = clean.clean_production(production_df)
    facts = fact.fact_production(runs, aggregate.agg_downtime(clean.clean_downtime(downtime_df)),
                                 aggregate.agg_quality(clean.clean_quality(quality_df)))
    dim = dims.all_dims(runs.where("product_id <> 'tile'"))  # so that runs of tiles are rejected
    made = {"dim_machine": warehouse.upsert_dim_machine(dims.dim_machine(runs)), "dim_shift": warehouse.seed_dim_shift(spark),
            "dim_product": warehouse.insert_dim_product(dim["dim_product"])}
    staged = load.staged_runs(facts, made)
    kept = {r.production_id: (r.machine_id, r.shift_id, r.product_id, str(r.production_date)) for r in staged.collect()}
    assert kept == {"w7-a": (None, None, None, "None"), "W7-a": (None, None, None, "None"), "late": (None, None, None, "None"),
                    "w7-a ": ("ov-9", "S2", "tile", "2024-02-29"), "w8": ("ov-9", "S1", "tile", "2024-02-29")}
    assert {r.reject_reason for r in warehouse.fact_rejects(staged).collect()} == {"unknown product_id"}

"""Physical layout and maintenance of warehouse tables.

* ``sorted_fact``: rebalance by month (adaptive execution cuts a hot month into
  many partitions and merges small ones, by bytes) and sort each partition by
  (date_key, machine_key, shift_key), so Parquet min/max statistics skip row
  groups for date / machine predicates, the role a sort key plays in a
  columnar warehouse.
* ``placed_fact``: the rows of a machine's month in one partition, which serves the
  files of a load and both of its partials, so that its facts are shuffled once for
  the three; a hot month lies in as many partitions as its machines need.
* ``files_needed`` and ``packed``: the files that a month's small files fit into, and
  the month rewritten as that many files of the same layout.
* ``analyze``: catalog statistics for the cost-based optimizer; ``column_statistics``
  those of single columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.operators.joins import rebalanced
from shopfloor.operators.ordered import partitions

FACT_SORT = ["date_key", "machine_key", "shift_key"]
FILE_BYTES = 128 << 20  # a file that one task reads


def with_month(fact: DataFrame) -> DataFrame:
    """The fact plus ``month_key`` (yyyymm of date_key), its partition column in the warehouse."""
    return fact.withColumn("month_key", F.year("date_key") * 100 + F.month("date_key"))


def sorted_fact(fact: DataFrame) -> DataFrame:
    return sorted_within(rebalanced(with_month(fact), "month_key"))


def placed_fact(fact: DataFrame, rows: int) -> DataFrame:
    """``rows`` is about the number of facts: adaptive execution does not change the partitions of what is persisted."""
    return with_month(fact).repartitionByRange(partitions(rows), "month_key", "machine_key")


def sorted_within(placed: DataFrame) -> DataFrame:
    return placed.sortWithinPartitions("month_key", *FACT_SORT)


def files_needed(sizes: list[int], target: int = FILE_BYTES) -> int:
    """Number of files of at most ``target`` bytes that files of these sizes fit into, largest first into the first with room.

    A file above the target stays one.  Fewer than there are means that the
    folder is fragmented: some of its files fit into one.
    """
    room: list[int] = []
    for size in sorted(sizes, reverse=True):
        at = next((i for i, free in enumerate(room) if free >= size), None)
        if at is None:
            room.append(max(target - size, 0))
        else:
            room[at] -= size
    return len(room)


def packed(fact: DataFrame, files: int) -> DataFrame:
    """A month's rows as at most ``files`` sorted ranges; the run id splits rows of one date, machine and shift.

    One file is one task either way, so its rows are read by that task and not shuffled to it.
    """
    if files == 1:
        return fact.coalesce(1).sortWithinPartitions(*FACT_SORT)
    return fact.repartitionByRange(files, *FACT_SORT, "production_id").sortWithinPartitions(*FACT_SORT)


def analyze(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """``ANALYZE TABLE`` then report (table_name, row_count, size_in_bytes) from the catalog."""
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    else:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Statistics")
    text = F.col("data_type")
    return stats.select(
        F.lit(table.split(".")[-1]).alias("table_name"),
        F.regexp_extract(text, r"(\d+) rows", 1).cast("long").alias("row_count"),
        F.regexp_extract(text, r"(\d+) bytes", 1).cast("long").alias("size_in_bytes"),
    )


def column_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """``ANALYZE TABLE … FOR COLUMNS``, then ``column_name, min_value, max_value, null_count, distinct_count`` of each.

    The planner uses them to estimate filters and joins where
    ``spark.sql.cbo.enabled`` is set; ``distinct_count`` is approximate.
    """
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    rows = []
    for column in columns:  # one catalog entry each
        seen = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}
        value = {k: None if seen.get(k) in (None, "NULL") else seen[k] for k in ("min", "max", "num_nulls", "distinct_count")}
        rows.append((column, value["min"], value["max"], int(value["num_nulls"] or 0), int(value["distinct_count"] or 0)))
    return spark.createDataFrame(
        rows, "column_name string, min_value string, max_value string, null_count long, distinct_count long")

"""Operators that need a global order without funnelling rows through one task.

``dense_key`` (surrogate keys 1..n in key order):

1. the rows are written once as Parquet in the cluster's shared folder (or are
   files already); a sample of the order column gives the bounds of ranges of about
   ROWS_PER_PARTITION rows each;
2. one narrow aggregate counts the rows of every range;
3. a row's key is the number of rows in the ranges before its own plus its
   ``row_number`` inside it.

The key depends on the written rows alone, not on the bounds, so it is left to the
reader's plan: rows are shuffled once, by the reader, and a reader that takes no key
shuffles none.

``running_sum`` (cumulative totals in a sort order) range-partitions and sorts the
rows, then ``checkpoint()`` into the shared folder, which fixes partition ids and row
positions for every later job and every retry after an executor loss; prefix
sums of the per-partition totals are joined to the rows by partition number.

No step holds more than one range in a task, whatever the table size.
"""

from __future__ import annotations

import uuid
from itertools import accumulate
from math import isqrt

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shopfloor.session import scratch_path

# Rows per range when the count is derived from the data: a task sorts one in memory.
ROWS_PER_PARTITION = 125_000
SAMPLED_PER_RANGE, SAMPLED_AT_MOST = 40, 1_000_000  # values that the bounds of ranges are taken from


def partitions(rows: int) -> int:
    """As many partitions as ``rows`` need, however many that is.

    An explicit partition count is neither split nor merged by AQE, so it has
    to follow the row count: a task sorts about ROWS_PER_PARTITION rows at any size.
    """
    return max(1, -(-rows // ROWS_PER_PARTITION))


def _partitions(num_partitions: int | None, rows: int) -> int:
    return num_partitions or partitions(rows)


def _written(df: DataFrame) -> tuple[DataFrame, int, str]:
    """A Parquet copy in the shared folder, its number of rows, observed during the write, and its path."""
    path = scratch_path(df.sparkSession, f"ordered-{uuid.uuid4().hex[:12]}")
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows.get["n"], path


def sorted_checkpoint(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partitioned, sorted and materialised copy of ``df`` (stable partition ids).

    The rows are written once to the shared folder first: counting them, the
    range sampling and the shuffle read these files, not the lineage, and no
    executor's disk holds the only copy.  The partition count follows the row
    count (see :func:`partitions`).
    """
    spark = df.sparkSession
    src, rows, path = _written(df)
    out = src.repartitionByRange(_partitions(num_partitions, rows), *order).sortWithinPartitions(*order)
    out = out.checkpoint(eager=True)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return out


def _offsets(totals: DataFrame, value: str) -> DataFrame:
    """``(_pid, _before)``: the total of all partitions in front; one row per partition, hence broadcast."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(totals.select("_pid", F.coalesce(F.sum(value).over(before), F.lit(0)).alias("_before")))


def _bounds(df: DataFrame, column: str, ranges: int, rows: int) -> list:
    """Ascending values that cut the column into about ``ranges`` ranges of equal size, from a sample."""
    if ranges < 2:
        return []
    wanted = min(SAMPLED_PER_RANGE * ranges, SAMPLED_AT_MOST)
    sample = df.select(column).where(F.col(column).isNotNull()).sample(min(1.0, wanted / max(rows, 1)), seed=42)
    cuts = sample.select(F.ntile(ranges).over(Window.orderBy(column)).alias("range"), column)
    return sorted({r[0] for r in cuts.groupBy("range").agg(F.min(column)).where("range > 1").select(f"min({column})").collect()})


def _range_of(value: Column, bounds: list) -> Column:
    """The number of bounds that are not above the value (none: 0): first among groups of bounds, then within one."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]

    def passed(among: Column) -> Column:
        return F.size(F.filter(among, lambda bound: bound <= value))

    group = passed(F.array(*[F.lit(g[-1]) for g in groups[:-1]])) if len(groups) > 1 else F.lit(0)
    return group * step + passed(F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group))


def dense_key(
    df: DataFrame,
    key_col: str,
    order_col: str,
    start: int = 0,
    num_partitions: int | None = None,
    key_type: str = "long",
    written: bool = False,
) -> DataFrame:
    """Add ``key_col`` = start + rank of ``order_col`` (ascending, nulls first) over ``df``.

    Rows that share a value are numbered by a hash of all their columns.
    ``written`` says that ``df`` is read from files, so that no copy of it is made.
    """
    staged, rows = (df, df.count()) if written else _written(df)[:2]
    bounds = _bounds(staged, order_col, _partitions(num_partitions, rows), rows)
    ranged = staged.withColumn("_range", _range_of(F.col(order_col), bounds))
    sizes = dict(ranged.groupBy("_range").count().collect())  # a row per range
    before = [0, *accumulate(sizes.get(i, 0) for i in range(len(bounds)))]
    within = Window.partitionBy("_range").orderBy(F.col(order_col).asc_nulls_first(), F.xxhash64(*staged.columns))
    key = F.get(F.array(*[F.lit(start + n).cast("long") for n in before]), F.col("_range")) + F.row_number().over(within)
    return ranged.withColumn(key_col, key.cast(key_type)).drop("_range")


def running_sum(
    df: DataFrame,
    value_col: str,
    order: list[Column],
    out_col: str,
    num_partitions: int | None = None,
    value_type: str = "decimal(38,2)",
) -> DataFrame:
    """``out_col`` = SUM(value_col) over all rows up to and including this one in ``order``.

    ``order`` must be a total order (add tie-breakers); sums are exact decimals.
    """
    staged = sorted_checkpoint(df.withColumn("_v", F.col(value_col).cast(value_type)), order, num_partitions)
    staged = staged.withColumn("_pid", F.spark_partition_id())
    totals = staged.groupBy("_pid").agg(F.sum("_v").alias("_s"))
    within = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = staged.withColumn("_sum", F.sum("_v").over(within)).join(_offsets(totals, "_s"), "_pid")
    return summed.withColumn(out_col, (F.col("_before") + F.col("_sum")).cast(value_type)).drop(
        "_v", "_pid", "_sum", "_before")

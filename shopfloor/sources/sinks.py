"""Parquet sinks of the processed zone.

The fact is written partitioned by (year, month).  Before writing it is
rebalanced on (year, month): adaptive execution merges small months and cuts
large ones by bytes, so each task writes into one or few partition folders and
a month holding a third of all rows still spreads over many tasks.  Files are
sorted so that Parquet row-group statistics skip well.  Row counts are taken
with ``observe`` during the write instead of a separate counting job.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.operators.joins import rebalanced
from shopfloor.session import scratch_path

FACT_PARTITIONS = ["year", "month"]


def write_parquet(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                  mode: str = "overwrite", dynamic: bool = False) -> None:
    """Overwrite (or append) ``df`` at ``path``; ``dynamic`` replaces only the partitions written."""
    # Always explicit: a session-wide "dynamic" default would otherwise turn a
    # full overwrite into a partial one and leave stale partitions behind.
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def cluster_fact(fact: DataFrame) -> DataFrame:
    return rebalanced(fact, "year", "month").sortWithinPartitions("year", "month", "machine_id", "production_date")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists; any other problem (permissions, storage) is raised."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of the data files in a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [f.getLen() for f in listed if f.isFile() and not f.getPath().getName().startswith(("_", "."))]


def write_fact(fact: DataFrame, path: str) -> int:
    """Write the lake fact partitioned by year/month, replacing the folder; returns the number of rows written (observed).

    Rows with a NULL date land in the default partition.  Batches are merged
    into a published zone by ``plans.lake``, never into a folder that readers use.
    """
    obs = Observation("fact_rows")
    observed = cluster_fact(fact).observe(obs, F.count(F.lit(1)).alias("rows"))
    write_parquet(observed, path, FACT_PARTITIONS)
    return int(obs.get["rows"])


def write_dims(dims: dict[str, DataFrame], base: str) -> None:
    """Every dimension in files of the advisory size (a small one is one file)."""
    for name, df in dims.items():
        write_parquet(rebalanced(df), f"{base.rstrip('/')}/{name}")


def read_fact(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Read the lake fact, optionally for [start, end] dates.

    A date predicate alone does not prune (year, month) folders, so the
    matching year/month bounds are added for partition pruning.
    """
    df = spark.read.schema(schemas.LAKE_FACT).parquet(path)
    if start is None and end is None:
        return df
    d = F.col("production_date")
    ym = F.col("year") * 100 + F.col("month")
    if start is not None:
        s = F.lit(start).cast("date")
        df = df.filter((ym >= F.year(s) * 100 + F.month(s)) & (d >= s))
    if end is not None:
        e = F.lit(end).cast("date")
        df = df.filter((ym <= F.year(e) * 100 + F.month(e)) & (d <= e))
    return df


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return scratch_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")


def stage(df: DataFrame) -> DataFrame:
    """A Parquet copy in the cluster's shared folder: it cuts the lineage, and readers take only the columns they use."""
    spark = df.sparkSession
    path = scratch_folder(spark, "stage")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def discard(*staged: DataFrame) -> None:
    """Remove the copies behind staged tables."""
    for df in staged:
        drop_folder(df.sparkSession, df._stage_path)

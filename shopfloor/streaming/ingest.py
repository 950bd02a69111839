"""Incremental conversion of newly arrived raw files into a columnar raw copy.

The raw zone receives text files (CSV / JSON) every day.  Scanning text is
row-oriented: every run re-parses every column of every file.  This stream
picks up only files it has not seen (the file source keeps the processed-file
log in the checkpoint), parses them once with the declared schema and appends
them as Parquet partitioned by the month of the production date.  The batch job then
reads the Parquet copy with column pruning and predicate pushdown.

``trigger(availableNow=True)`` processes everything available and stops, so
the same code runs as a scheduled batch step or as a long-running stream.
The checkpoint (in the cluster's shared folder) makes it exactly-once: a
restarted or retried run neither skips nor duplicates a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from shopfloor import schemas

PARTITION_COLUMN = "ingest_month"
UNDATED = "undated"  # folder of rows whose date text is no date
SPLITS_TOGETHER = 16  # input splits whose rows of one month meet in one task


def raw_stream(spark: SparkSession, path: str, table: str, fmt: str = "csv",
               max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.RAW_SCHEMAS[table])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "csv":
        return reader.option("header", "true").option("nullValue", "").option("mode", "PERMISSIVE").csv(path)
    if fmt == "json":
        return reader.option("mode", "PERMISSIVE").json(path)
    raise ValueError(f"unsupported raw format: {fmt}")


def by_month(stream: DataFrame) -> DataFrame:
    """Adds the month folder of each row; a month's rows of a few input splits meet before the write, so files stay few.

    A month, or the undated rows, of a large trigger go to as many tasks as the
    trigger has groups of splits, so no task grows with the trigger.
    """
    month = F.date_format(F.try_to_timestamp("production_date", F.lit("yyyy-MM-dd")), "yyyy-MM")
    group = F.floor(F.spark_partition_id() / F.lit(SPLITS_TOGETHER)).alias("_group")
    dealt = stream.select("*", F.coalesce(month, F.lit(UNDATED)).alias(PARTITION_COLUMN), group)
    return dealt.repartition(PARTITION_COLUMN, "_group").drop("_group")


def start_ingest(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    checkpoint_location: str,
    table: str,
    fmt: str = "csv",
    available_now: bool = True,
    processing_time: str = "5 minutes",
) -> StreamingQuery:
    """Start the file → Parquet stream for one raw table."""
    stream = raw_stream(spark, source_path, table, fmt)
    writer = (
        by_month(stream).writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_location)
        .partitionBy(PARTITION_COLUMN)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start(target_path)


def ingest_available(spark: SparkSession, raw_base: str, parquet_base: str, checkpoint_base: str,
                     fmt: str = "csv") -> dict[str, str]:
    """Convert every new raw file of the three tables; returns the Parquet folders."""
    out = {}
    for table in schemas.RAW_SCHEMAS:
        target = f"{parquet_base.rstrip('/')}/{table}"
        q = start_ingest(spark, f"{raw_base.rstrip('/')}/{table}", target,
                         f"{checkpoint_base.rstrip('/')}/{table}", table, fmt)
        q.awaitTermination()
        out[table] = target
    return out


def read_parquet_copy(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a converted table back with the declared column order."""
    cols = [f.name for f in schemas.RAW_SCHEMAS[table].fields]
    schema = StructType([*schemas.RAW_SCHEMAS[table].fields, StructField(PARTITION_COLUMN, StringType())])
    return spark.read.schema(schema).parquet(path).select(*cols)

"""Damaged raw records, kept apart instead of loaded with holes.

A PERMISSIVE scan turns a value that does not fit its column into NULL, and
nothing tells that row from one whose field was empty.  Here the text is parsed
once with a column for the damaged line; rows that parse and lines that do not
are written side by side as Parquet in the shared folder.  All later readers
(suites, fact, batches) take the first part, without parsing text again; the
second is the quarantine: the line as it came and the file it came from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopfloor import schemas

LINE, FILE, STATE = "_damaged_line", "_file", "_state"
KEPT, DAMAGED = "kept", "damaged"


@dataclass
class Split:
    """``kept`` has the raw schema; ``damaged`` is ``file, line``, one row per damaged record."""

    kept: DataFrame
    damaged: DataFrame


def split(spark: SparkSession, path: str | list[str], schema: StructType, out: str, fmt: str = "csv") -> Split:
    """Parse raw text once into ``out`` (a new folder); kept and damaged rows together are the records of the files.

    Damaged are records with a value that does not fit its column, with more or
    fewer fields than the schema, and, in JSON, lines that are no object.  A
    CSV file's header and blank lines are no records.  An empty field is NULL
    and no damage.  Files without records give two empty tables.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"no text format: {fmt}")
    fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
    checked = StructType([*fields, StructField(LINE, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}
    if fmt == "csv":
        parsed = (spark.read.schema(checked).options(**options).option("header", "true").option("nullValue", "").csv(path)
                  .select("*", F.col("_metadata.file_path").alias(FILE)))
    else:
        # Line by line: a scan of JSON files would make no row, or several, of a line that is an array.
        lines = spark.read.text(path).where(F.trim("value") != "").select(
            "value", F.col("_metadata.file_path").alias(FILE), F.from_json("value", checked, options).alias("r"))
        whole = F.col("value").rlike(r"^\s*\{") & F.col(f"r.{LINE}").isNull()
        parsed = lines.select(*[F.col("r")[c].alias(c) for c in schema.names], F.when(~whole, F.col("value")).alias(LINE), FILE)
    broken = F.col(LINE).isNotNull()
    # All fields are read: a scan pruned to some of them would only see damage in those.
    rows = parsed.withColumns({FILE: F.when(broken, F.col(FILE)), STATE: F.when(broken, DAMAGED).otherwise(KEPT)})
    rows.write.mode("errorifexists").partitionBy(STATE).parquet(out)
    return read(spark, out, schema)


def read(spark: SparkSession, out: str, schema: StructType) -> Split:
    """Both parts of an earlier :func:`split`; each reads its own folder only."""
    fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
    extra = [StructField(name, StringType(), True) for name in (LINE, FILE, STATE)]
    written = spark.read.schema(StructType([*fields, *extra])).parquet(out)
    return Split(
        written.where(F.col(STATE) == KEPT).select(*schema.names),
        written.where(F.col(STATE) == DAMAGED).select(F.col(FILE).alias("file"), F.col(LINE).alias("line")))


def split_zone(spark: SparkSession, base: str, out: str, fmt: str = "csv") -> dict[str, Split]:
    """The three raw tables below ``base``, split into ``out``."""
    return {name: split(spark, f"{base.rstrip('/')}/{name}", schema, f"{out.rstrip('/')}/{name}", fmt)
            for name, schema in schemas.RAW_SCHEMAS.items()}

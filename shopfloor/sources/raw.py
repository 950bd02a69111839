"""Raw-zone scans: delimited text and JSON with explicit schemas.

CSV binding is positional under the default ``enforceSchema=true`` — a file
with a reordered header silently shifts values.  ``enforce_header=True``
switches to ``enforceSchema=false`` so Spark checks header names against the
schema and fails on a mismatch instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shopfloor import schemas


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    enforce_header: bool = False,
) -> DataFrame:
    """Header row, empty field → NULL, malformed values → NULL (PERMISSIVE)."""
    reader = (
        spark.read.option("header", "true")
        .option("nullValue", "")
        .option("mode", "PERMISSIVE")
        .schema(schema)
    )
    if enforce_header:
        reader = reader.option("enforceSchema", "false")
    return reader.csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """JSON lines with the same schema; wrong-typed values become NULL."""
    return spark.read.option("mode", "PERMISSIVE").schema(schema).json(path)


def read_production(spark: SparkSession, path, fmt: str = "csv", **kw) -> DataFrame:
    return _read(spark, path, schemas.PRODUCTION, fmt, **kw)


def read_downtime(spark: SparkSession, path, fmt: str = "csv", **kw) -> DataFrame:
    return _read(spark, path, schemas.DOWNTIME, fmt, **kw)


def read_quality(spark: SparkSession, path, fmt: str = "csv", **kw) -> DataFrame:
    return _read(spark, path, schemas.QUALITY, fmt, **kw)


def _read(spark, path, schema, fmt, **kw):
    if fmt == "csv":
        return read_csv(spark, path, schema, **kw)
    if fmt == "json":
        return read_json(spark, path, schema)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unsupported raw format: {fmt}")


def read_raw_zone(spark: SparkSession, base: str, fmt: str = "csv", **kw) -> dict[str, DataFrame]:
    """``<base>/production``, ``<base>/downtime``, ``<base>/quality`` folders."""
    base = base.rstrip("/")
    return {
        "production": read_production(spark, f"{base}/production", fmt, **kw),
        "downtime": read_downtime(spark, f"{base}/downtime", fmt, **kw),
        "quality": read_quality(spark, f"{base}/quality", fmt, **kw),
    }

"""Helpers shared by the operators: tables in the shared folder, exact ranks, chunked text batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
# Arrow batches are cut into chunks of about this many text bytes (one longer
# text is a chunk of its own), so that a worker's arrays stay bounded.
CHUNK_BYTES = 1 << 20
TEXT_ROWS = 500  # rows of an Arrow batch of texts
RANGE_ROWS = 2_000_000  # narrow rows that a task sorts at most
LEAST_RANGE = 50_000  # and at least, where there are idle tasks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_watched: list[list[Scratch]] = []


@contextmanager
def scratch_removed():
    """Removes every scratch table made inside the block when it ends (what is lazy must be written by then)."""
    made: list[Scratch] = []
    _watched.append(made)
    try:
        yield
    finally:
        _watched.remove(made)
        for scratch in made:
            scratch.clear([])


class Scratch:
    """Intermediate tables as Parquet below the cluster's shared checkpoint folder.

    Writing one cuts the lineage: a lost executor rereads the files and never
    repeats the work before them.  :meth:`drop` removes tables that nothing
    reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")
        self._n = 0
        self.paths: list[str] = []
        for made in _watched:
            made.append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.base}/{name}-{self._n}"
        df.write.parquet(path)
        self.paths.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *dfs: DataFrame | None) -> None:
        self._delete([df._scratch_path for df in dfs if df is not None])

    def clear(self, keep: list[DataFrame]) -> None:
        """Remove all tables of this scratch but those."""
        kept = {df._scratch_path for df in keep}
        self._delete([path for path in self.paths if path not in kept])

    def _delete(self, paths: list[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in paths:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        self.paths = [path for path in self.paths if path not in set(paths)]


def uniform(*cols: Column, seed: int = 0) -> Column:
    """A reproducible uniform number in [0, 1) from the given columns."""
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def ranged(scratch: Scratch, df: DataFrame, order: list[Column]) -> DataFrame:
    """A written copy of narrow rows in range partitions of ``order``, with partition ``_part`` and place ``_place`` in it.

    ``df`` is a written table.  A number of its rows ends the order, so that it is
    total and no value, however common, is one task: a partition has about
    RANGE_ROWS rows, fewer while there are idle tasks.
    """
    n, at_once = df.count(), int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-n // RANGE_ROWS), min(at_once, n // LEAST_RANGE))
    order = [*order, F.col("_number").asc()]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = df.withColumn("_number", F.monotonically_increasing_id())
    return scratch.save(numbered.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_number")
                        .withColumn("_part", F.spark_partition_id()).withColumn("_place", place), "ranged")


def _before(scratch: Scratch, placed: DataFrame, group: list[str], value: Column) -> DataFrame:
    """``(*group, _part, _start, _first)``: the total of earlier partitions in the group, and its first place in this one."""
    parts = placed.groupBy(*group, "_part").agg(value.alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return scratch.save(parts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"), "starts")


def gapless_rank(scratch: Scratch, df: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps in ``order``, without one task per group.

    Reruns agree; full ties get distinct numbers.  ``df`` is read several times
    and should be a written table.  Null groups are a group.
    """
    placed = ranged(scratch, df, [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]])
    starts = _before(scratch, placed, [group], F.count("*")).select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"), "_start", "_first")
    joined = placed.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn(out, (F.col("_start") + F.col("_place") - F.col("_first")).cast("long")).drop(
        "_g", "_p", "_start", "_first", "_part", "_place")


def sorted_rank(scratch: Scratch, df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Number all rows from 0 without gaps in a sort order; ``df`` is a written table."""
    placed = ranged(scratch, df, order)
    starts = _before(scratch, placed, [], F.count("*")).select("_part", "_start")
    return placed.join(starts, "_part").withColumn(out, (F.col("_start") + F.col("_place")).cast("long")).drop(
        "_part", "_place", "_start")


def sums_before(scratch: Scratch, df: DataFrame, group: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """The sum of ``value`` over all earlier rows of the group in ``order``; groups are not null, ``df`` is a written table."""
    placed = ranged(scratch, df, [*[F.col(g).asc() for g in group], *order])
    starts = _before(scratch, placed, group, F.sum(value)).drop("_first")
    inside = Window.partitionBy("_part", *group).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(starts, ["_part", *group]).withColumn(out, F.col("_start") + F.col("_in")).drop(
        "_part", "_place", "_start", "_in")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = TEXT_ROWS):
    """Arrow batches of at most ``rows`` rows for what is written inside the block; the session's setting comes back after it.

    For tasks that hold a batch several times over.  All others keep the session's setting (64 MB a batch by default).
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    if before is None or not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def whole_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` of every row, for operators that work on texts in Python."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def text_chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their texts' bytes (null: none) and byte offsets, about a chunk each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        col = col.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        raw = col.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(col):
            end = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
            end = min(max(end, at + 1), len(col))
            yield batch.slice(at, end - at), data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
            at = end

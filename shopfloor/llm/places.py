"""Rows by the file and row number they are read from, so that decisions about texts need no copy and no shuffle of the texts.

A stage judges rows on narrow tables.  Each narrow row carries its place (file and
row number, as Parquet scans report them), and a decision comes back as bitmaps,
4 KB for 32,768 rows of a file.  The texts are scanned once more, beside the
bitmaps of their files; only the rows that stay leave the scan.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.common import Scratch

BITMAP_BYTES = 4096
BROADCAST_BYTES = 64 << 20


def _chunk() -> Column:
    return F.bitmap_bucket_number(F.col("row") + 1)


def _bit() -> Column:
    return F.bitmap_bit_position(F.col("row") + 1)


class Places:
    """The rows of a table with their places; a table that is not a plain scan of files is written first."""

    def __init__(self, scratch: Scratch, docs: DataFrame):
        self.scratch, self.columns = scratch, docs.columns
        try:
            self.docs = docs
            chunks = self.narrow().groupBy("file", _chunk().alias("chunk")).agg(
                F.count("*").alias("n"), F.bitmap_count(F.bitmap_construct_agg(_bit())).alias("bits"))
            # A place that comes twice (rows were multiplied after the scan) names no row.
            plain = not chunks.where("n <> bits").limit(1).count()
        except AnalysisException:
            plain = False
        self.needed: list[DataFrame] = []  # written tables that results are read from
        if not plain:
            self.docs = scratch.save(docs, "rows")
            self.needed.append(self.docs)

    def narrow(self, *cols: Column) -> DataFrame:
        """The given columns with each row's ``file`` and ``row``."""
        scan = self.docs.metadataColumn("_metadata")
        return self.docs.select(*cols, scan.getField("file_path").alias("file"), scan.getField("row_index").alias("row"))

    def _marked(self, docs: DataFrame, wanted: DataFrame, times: Column, most: int) -> DataFrame:
        """``docs`` (with ``file`` and ``row``) that are wanted, with ``times``, 1 to ``most``."""
        levels = [F.bitmap_construct_agg(F.when(times >= k, _bit())).alias(f"b{k}") for k in range(1, most + 1)]
        bitmaps = self.scratch.save(wanted.where(times >= 1).groupBy("file", _chunk().alias("chunk")).agg(*levels), "bitmaps")
        self.needed.append(bitmaps)
        small = bitmaps.count() * BITMAP_BYTES * most <= BROADCAST_BYTES
        bitmaps = F.broadcast(bitmaps) if small else bitmaps.hint("merge")

        def test(level: int) -> Column:
            byte = F.conv(F.hex(F.substring(F.col(f"b{level}"), (_bit() / 8).cast("int") + 1, F.lit(1))), 16, 10)
            return F.getbit(byte.cast("long"), (_bit() % 8).cast("int")).cast("int")

        joined = docs.withColumn("chunk", _chunk()).join(bitmaps, ["file", "chunk"])
        return joined.withColumn("times", sum(test(k) for k in range(1, most + 1))).where("times > 0")

    def keep(self, wanted: DataFrame) -> DataFrame:
        """The rows, all columns, whose places ``wanted(file, row)`` holds."""
        docs = self.narrow(F.struct(*self.columns).alias("doc"))
        return self._marked(docs, wanted, F.lit(1), 1).select("doc.*")

    def repeat(self, wanted: DataFrame, most: int) -> DataFrame:
        """Each row, all columns, as often as ``wanted(file, row, times)`` says, ``most`` times at most."""
        docs = self.narrow(F.struct(*self.columns).alias("doc"))
        times = self._marked(docs, wanted, F.col("times"), most)
        return times.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("doc.*")

    def attach(self, wanted: DataFrame, *cols: Column) -> DataFrame:
        """``wanted(file, row, ...)`` with columns of its rows; only rows that are wanted meet it."""
        docs = self._marked(self.narrow(F.struct(*cols).alias("doc")), wanted, F.lit(1), 1)
        return docs.select("file", "row", "doc").join(wanted, ["file", "row"]).drop("file", "row").select("*", "doc.*").drop("doc")

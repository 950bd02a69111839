"""Operator 4: mixing sources to target weights by capped water-filling, in DataFrame functions only.

The water level is found by scalar aggregates over the table of sources: sources
whose share is above their largest number of epochs are clamped there, and the
rest of the budget is shared again by weight until none is above.  A source's
target is then met by whole repetitions of all its documents and by a seeded
sample for the fraction: documents in a hash order, until their words reach
the rest.  The order is cut into range partitions of narrow rows, each place being
unique, so no source and no repeated id, however hot, is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import WORD, Scratch, sums_before, table
from shopfloor.llm.places import Places

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"


def targets(scratch: Scratch, sized: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` for every source (null is one, ordered last)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source here: the numbering sorts names, not documents.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    sources = scratch.save(sums.withColumn("weight", weight), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level = share * total, 0.0
    while True:
        cap = F.lit(float(max_epochs)) * F.col("source_size")
        above = F.col("weight") * F.lit(level) >= cap
        row = sources.agg(F.sum(F.when(above, cap).otherwise(0.0)).alias("clamped"),
                          F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        new = (budget - row["clamped"]) / row["open"]
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level),
                                                F.lit(float(max_epochs)) * F.col("source_size")))


def sized(id_col: Column, text_col: Column, source_col: Column, seed: str = SEED) -> list[Column]:
    """Columns ``id, source, size, draw`` of documents, for :func:`with_copies`."""
    text_id = F.coalesce(id_col.cast("string"), F.lit(""))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text_id)), 1, 15), 16, 10).cast("long")
    words = F.regexp_count(F.coalesce(text_col.cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    return [id_col.alias("id"), source_col.cast("string").alias("source"), words.alias("size"), draw.alias("draw")]


def with_copies(scratch: Scratch, rows: DataFrame, weights=WEIGHTS, share: float = SHARE,
                max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A written table of :func:`sized` columns (and any others) with ``source_size, target, copies``."""
    aims = targets(scratch, rows, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = scratch.save(aims.select(
        F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_none"), "source_size", "target",
        whole.cast("int").alias("_whole")).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")),
        "aims")
    keyed = rows.withColumns({"_s": F.coalesce("source", F.lit("")), "_none": F.col("source").isNull()})
    at = sums_before(scratch, keyed, ["_s", "_none"], [F.col("draw"), F.col("id"), F.col("size")], "size", "_at")
    placed = at.join(aims, ["_s", "_none"])
    copies = F.col("_whole") + F.when(2 * F.col("_at") + F.col("size") <= 2 * F.col("_rest"), 1).otherwise(0)
    copies = F.when(F.col("_whole") >= max_epochs, F.lit(max_epochs)).otherwise(copies)
    return placed.withColumn("copies", copies.cast("int")).drop("_s", "_none", "_whole", "_rest", "_at")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``id, source, size, source_size, target, copies, taken`` for every row of ``docs``.

    ``copies`` is how often the mix holds the document, ``taken`` its words
    there.  Sizes are words; a null text has none.  A null source is a source;
    a null id is hashed as an empty one.  Rows that repeat an id are documents
    of their own, of which the sample takes any by size.  The sample ends at
    the document that brings the source nearest its target.  Other columns are
    not read; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.save(docs.select(*sized(F.col(id_col), F.col(text_col), F.col(source_col), seed)), "sizes")
    return with_copies(scratch, rows, weights, share, max_epochs).select(
        "id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed_rows(places: Places, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows themselves, all columns, each as often as the mix holds it."""
    scratch = places.scratch
    rows = scratch.save(places.narrow(*sized(F.col(id_col), F.col(text_col), F.col(source_col))), "sizes")
    out = places.repeat(with_copies(scratch, rows).select("file", "row", F.col("copies").alias("times")), MAX_EPOCHS)
    scratch.clear(places.needed)
    return out


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")

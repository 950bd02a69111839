"""Operator 1: near-duplicate documents by one-permutation MinHash.

Every text is hashed once into one permutation cut into ``bands * rows`` bins;
empty bins copy from filled ones by optimal densification (each empty bin walks
its own fixed random sequence of bins until it meets a filled one).  Bands of
``rows`` bins are bucket keys.  Buckets give star-shaped candidate edges, and
every candidate is confirmed on the two full shingle sets.

Nothing is capped.  Documents with equal sets are one class before any bucket
is built, so copies never meet in pairs.  A star loses links between two of its
leaves; :mod:`buckets` therefore goes on with buckets whose members are still in
different components, until every pair of a bucket is confirmed, refused by a
proven bound on its overlap, or already in one component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.buckets import bucket_components, bucket_members, one_node
from shopfloor.llm.common import Scratch, arrow_batches, table, text_chunks
from shopfloor.llm.places import Places
from shopfloor.llm.wordhash import U, mix, shingles

SHINGLE = 5
SIMILARITY = 75  # per cent
BANDS, ROWS = 32, 4  # a pair at 0.75 shares no bucket with a chance of 5e-6


def signatures(sets: np.ndarray, doc: np.ndarray, n_docs: int, bins: int) -> np.ndarray:
    """One-permutation signatures (documents x bins) with optimal densification; empty sets give zeros."""
    out = np.zeros((n_docs, bins), U)
    filled = np.zeros((n_docs, bins), bool)
    if not len(sets):
        return out
    where = ((sets >> U(40)) * U(bins) >> U(24)).astype(np.int64)
    first = np.ones(len(sets), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (where[1:] != where[:-1])
    out[doc[first], where[first]] = sets[first]
    filled[doc[first], where[first]] = True
    row, col = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        walk = np.arange(attempt * bins, (attempt + 1) * bins, dtype=U) * U(0x9E3779B97F4A7C15)
        donor = (mix(walk) % U(bins)).astype(np.int64)[col]
        found = filled[row, donor]
        out[row[found], col[found]] = out[row[found], donor[found]]
        row, col = row[~found], col[~found]
    return out


def bands_of(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.zeros((len(signature), bands), U)
    for r in range(rows):
        key = mix(key * U(0x9E3779B97F4A7C15) + signature[:, r::rows][:, :bands] + U(r + 1))
    return mix(key + np.arange(bands, dtype=U) * U(0xC2B2AE3D27D4EB4F)).view(np.int64)


def _sketch(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches, "text"):
            n = batch.num_rows
            sets, doc = shingles(data, offsets, size)
            count = np.bincount(doc, minlength=n)
            keys = np.zeros((2, n), U)
            if len(sets):
                at = np.flatnonzero(np.diff(doc, prepend=-1))
                for k, salt in enumerate((0x8CB92BA72F3D8DD7, 0x2545F4914F6CDD1D)):
                    keys[k, doc[at]] = np.add.reduceat(mix(sets ^ U(salt)), at)
            key = bands_of(signatures(sets, doc, n, bands * rows), bands, rows)
            some = count > 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(some) * bands]), pa.int32()), pa.array(key[some].ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.drop_columns(["text"]).columns, pa.array(count.astype(np.int64)), pa.array(keys[0].view(np.int64)),
                 pa.array(keys[1].view(np.int64)), lists], names=["id", "file", "row", "n", "k1", "k2", "bands"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches, "text"):
            sets, doc = shingles(data, offsets, size)
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["rep", "s"])
    return run


def near_duplicate_rows(places: Places, id_col: Column, text_col: Column, shingle: int = SHINGLE,
                        similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                        merge_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(id, file, row, node, n, k1, k2)`` of every row, and ``(k1, k2, id, node)``: each linked set's first row.

    Every row is a document of its own, numbered by ``node``.  A set is named by
    the row of its component that is first by ``(id, node)``; the ids are of any
    type that has an order.  With ``merge_ids`` rows with one id belong together.
    Rows with a null id or without words have no set.
    """
    scratch = places.scratch
    texts = places.narrow(id_col.alias("id"), text_col.cast("string").alias("text")).select("id", "file", "row", "text")
    kind = texts.schema["id"].dataType.simpleString()
    with arrow_batches(scratch.spark):
        sketch = scratch.save(texts.mapInArrow(_sketch(shingle, bands, rows), (
            f"id {kind}, file string, row long, n long, k1 long, k2 long, bands array<long>"))
            .withColumn("node", F.monotonically_increasing_id()), "sketch")
    linkable = sketch.where("n > 0 AND id IS NOT NULL")
    # One class per distinct set, named by its first row.
    first = F.min(F.struct("id", "node")).alias("first")
    classes = scratch.save(linkable.groupBy("k1", "k2", "n").agg(first).select(
        "k1", "k2", "n", F.col("first.id").alias("id"), F.col("first.node").alias("node")), "classes")
    reps = sketch.select("node", "n", "bands").join(classes.select("node"), "node", "left_semi")
    keyed = scratch.save(reps.select(F.col("node").alias("rep"), "n", F.explode("bands").alias("key")), "keyed")
    members = bucket_members(scratch, keyed)
    scratch.drop(keyed)
    ids = scratch.save(members.select("rep").distinct(), "ids")
    wanted = scratch.save(sketch.select("file", "row", F.col("node").alias("rep")).join(ids, "rep", "left_semi"), "wanted")
    with arrow_batches(scratch.spark):
        full = scratch.save(places.attach(wanted, text_col.cast("string").alias("text")).select("rep", "text")
                            .mapInArrow(_sets(shingle), "rep long, s array<long>"), "sets")
    scratch.drop(ids, wanted)
    known = None
    if merge_ids:
        span = [F.min("k1").alias("a1"), F.max("k1").alias("z1"), F.min("k2").alias("a2"), F.max("k2").alias("z2")]
        several = linkable.groupBy("id").agg(*span).where("a1 < z1 OR a2 < z2").select("id")
        known = scratch.save(one_node(linkable.select("id", "k1", "k2").join(several, "id").join(
            classes.select("k1", "k2", "node"), ["k1", "k2"]).select("id", "node")), "one_id")

    def compared(pairs: DataFrame) -> DataFrame:
        """Both set sizes together and the shingles in common of pairs (a, b)."""
        at_b = pairs.join(full.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b")
        both = at_b.join(full.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
        return both.select("a", "b", (F.size("sa") + F.size("sb")).cast("long").alias("sum"),
                           F.size(F.array_intersect("sa", "sb")).cast("long").alias("both"))

    def similar(shared: Column, total: Column) -> Column:
        return F.lit(100) * shared >= F.lit(similarity) * (total - shared)

    def confirmed(pairs: DataFrame) -> DataFrame:
        return compared(pairs).where(similar(F.col("both"), F.col("sum"))).select("a", "b")

    def sizes_fit() -> Column:
        return F.lit(100) * F.least("n", "x_n") >= F.lit(similarity) * F.greatest("n", "x_n")

    def refine(rest: DataFrame) -> tuple[DataFrame, list[str], Callable[[], Column], DataFrame]:
        """Upper bounds of the overlap, from shingles that no other open set has and from the overlap with a hub.

        A set's shingles are ``lone`` where no other set of an open bucket has
        them.  Each bucket's hub, the set with the smallest share of those, is
        compared with all members; then two members can share at most the
        smaller part inside the hub plus the smaller shared part outside it.
        """
        some = full.join(rest.select("rep").distinct(), "rep", "left_semi")
        lone = (some.select("rep", F.explode("s").alias("x")).groupBy("x")
                .agg(F.count("*").alias("c"), F.min("rep").alias("rep")).where("c = 1")
                .groupBy("rep").agg(F.count("*").alias("lone")))
        members = scratch.save(rest.drop("c").join(lone, "rep", "left").withColumn("lone", F.coalesce("lone", F.lit(0))), "members")
        hubs = members.groupBy("key").agg(F.min(F.struct((F.col("lone") / F.col("n")).alias("share"), "rep")).alias("h"))
        with_hub = scratch.save(members.join(hubs.select("key", F.col("h.rep").alias("hub")), "key"), "hubs")
        named = with_hub.withColumn("a", F.least("rep", "hub")).withColumn("b", F.greatest("rep", "hub"))
        counted = scratch.save(compared(named.where("a < b").select("a", "b").distinct()), "counted")
        out = named.join(counted.select("a", "b", F.col("both").alias("in_hub")), ["a", "b"], "left").withColumn("in_hub", F.coalesce("in_hub", "n"))

        def possible() -> Column:
            most = F.least("in_hub", "x_in_hub") + F.least(
                F.col("n") - F.col("lone") - F.col("in_hub"), F.col("x_n") - F.col("x_lone") - F.col("x_in_hub"))
            return sizes_fit() & similar(most, F.col("n") + F.col("x_n"))

        return (scratch.save(out.select("key", "rep", "size", "n", "lone", "in_hub"), "members"),
                ["n", "lone", "in_hub"], possible,
                counted.where(similar(F.col("both"), F.col("sum"))).select("a", "b"))

    labels = bucket_components(scratch, members, ["n"], sizes_fit, confirmed, refine, known)
    named = classes.join(labels.select(F.col("node"), "component"), "node", "left").select(
        "k1", "k2", "id", "node", F.coalesce("component", "node").alias("component"))
    named = scratch.save(named, "components")
    least = named.groupBy("component").agg(F.min(F.struct("id", "node")).alias("first"))
    found = scratch.save(named.select("k1", "k2", "component").join(least, "component").select(
        "k1", "k2", F.col("first.id").alias("id"), F.col("first.node").alias("node")), "found")
    scratch.drop(full, members, classes, labels, named)
    return sketch.drop("bands"), found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(id, n, component)`` for every row of ``docs``.

    * Null, empty or wordless texts have ``n`` = 0 and are linked with nothing.
    * A text with fewer than ``shingle`` words has one shingle, its whole word sequence.
    * Rows that repeat an id are in one component, whatever their texts: links of any of them count for the id.
    * Rows with a null id are returned with a null component and link nothing.
    * Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    places = Places(Scratch(docs.sparkSession, "minhash"), docs.select(F.col(id_col).cast("long").alias("id"),
                                                                       F.col(text_col).alias("text")))
    every, found = near_duplicate_rows(places, F.col("id"), F.col("text"), shingle, similarity, bands, rows, merge_ids=True)
    linked = every.where("n > 0 AND id IS NOT NULL").select("id", "n", "k1", "k2").join(
        found.select("k1", "k2", F.col("id").alias("component")), ["k1", "k2"]).select("id", "n", "component")
    # Rows without words belong to the component of their id's other rows, if there are any.
    bare = every.where("n = 0 OR id IS NULL").select("id", "n")
    others = linked.join(bare.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("component").alias("_other")).withColumnRenamed("id", "_id")
    alone = bare.join(others, F.col("id") == F.col("_id"), "left").select(
        "id", "n", F.coalesce("_other", "id").alias("component"))
    return linked.unionByName(alone)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))

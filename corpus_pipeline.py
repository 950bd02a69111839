"""Corpus pipeline: language, quality, near duplicates, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and calls one operator of
``shopfloor.llm`` with its production parameters on all rows its predecessor
kept.  All stages but the last return the columns of ``documents``.  Between
stages the rows are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import langid, minhash, mixing, packing, quality_rules
from shopfloor.llm.common import Scratch, scratch_removed, table
from shopfloor.llm.places import Places

#: Texts whose best language is less likely than this are rejected (four languages start at 0.25).
LEAST_LANGUAGE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects null and empty texts, texts without a letter, and texts of no clear language.

    Ids may be null or repeated; each row is judged by its text alone.  Without
    labelled rows nothing is learned and every text is rejected; an empty table stays empty.
    """
    model = langid.train(docs, langid.remainder("doc_id", 4) != 2)
    return langid.keep_identified(docs, model, least=LEAST_LANGUAGE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the base test or any rule of the cascade refuses; rows are judged one by one.

    A null or empty text has no words and is rejected; ids may be null or
    repeated; an empty table stays empty.
    """
    whole = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return quality_rules.judge(whole, "row", "text").where("kept").select("id.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the one with the smallest id (no id comes last), among its rows by a hash.

    Every row is a document of its own, whatever its id, which may be null or
    repeated.  Null, empty and wordless texts belong to no group and stay.  An
    empty table stays empty.  Texts are read in place and never copied or shuffled
    to decide which rows stay.
    """
    places = Places(Scratch(spark, "near"), docs)
    others = [F.col(c) for c, kind in docs.dtypes if c != "doc_id" and "map<" not in kind]
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(*others).alias("hash"))
    every, found = minhash.near_duplicate_rows(places, order, F.col("text"))
    first = every.join(found.select("node").distinct(), "node", "left_semi")
    kept = places.keep(first.unionByName(every.where("n = 0")).select("file", "row"))
    places.scratch.clear(places.needed)
    return kept


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix holds it (0, 1 or 2 times); rows that repeat an id are documents of their own.

    A null source is a source, a null id is hashed as an empty one, a null text
    has no words.  An empty table stays empty.
    """
    return mixing.mixed_rows(Places(Scratch(spark, "mixture"), docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, as operator 7 packs them.

    Every row is packed on its own: a repeated id gives each row its pieces, a
    null id is kept, a null or empty text is the end id alone.  Other columns are
    not read; an empty table has no pieces.
    """
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packed),
]

#: Language scores, components of confirmed links and packed sequences have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch_removed():  # what the stage wrote for itself goes with its end
            made = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.drop(last)
        docs = last = made
    return STAGES[-1][1](spark, docs, sf_dir)

"""Operator 12: importance resampling towards a target distribution.

A text's UTF-8 bytes go through a 256-byte table that lower-cases A-Z and blanks
separators; ``bytes.split`` yields the words.  The CRC-32 of an n-gram is the
CRC-32 of its last word, seeded with that of the n-gram before it, so every
n-gram costs one call over one word.  Counters add up the buckets of a task and
Spark adds up the tasks; a table of gains, one per bucket, then weighs every text.

Documents are drawn by weight plus Gumbel noise that a hash of the id gives, and
ranked over all tasks in range partitions of narrow rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.common import Scratch, arrow_batches, sorted_rank, table

NGRAM = 3
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = "42"
PIECE = 1 << 20  # bytes of a text that are split at once; a piece ends between words

WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))


def features(text: bytes, longest: int = NGRAM) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and CRC-32 of the n-grams that end in them, piece by piece of the text."""
    clean = text.translate(WORD_BYTES)
    last: list[int | None] = [None] * longest  # the n-grams that end in the word before, by length
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        words = clean[at:end].split()
        at = end
        if not words:
            continue
        grams = list(map(crc32, words))
        out, later = [grams], [b" " + w for w in words]
        for n in range(1, longest):
            shorter = grams[:-1] if last[n - 1] is None else [last[n - 1], *grams[:-1]]
            if grams:
                last[n - 1] = grams[-1]
            grams = list(map(crc32, later[len(later) - len(shorter):], shorter))  # a text's first words end no longer one
            out.append(grams)
        yield len(words), np.array([g for part in out for g in part], np.uint32)


def _count(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                for _, grams in features(text.as_py() or b"", longest):
                    counts.update((grams % np.uint32(buckets)).tolist())
        if counts:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(counts.keys(), pa.int32()),
                                              "n": pa.array(counts.values(), pa.int64())})
    return run


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; the driver gets one row per bucket."""
    with arrow_batches(docs.sparkSession):
        counted = docs.select(F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(
            _count(longest, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in counted:
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: 1000 times the log of the smoothed ratio, floored."""
    n = float(len(source))
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(gain: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = np.uint32(len(gain))
        for batch in batches:
            words, total, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, text in enumerate(batch.column("text")):
                for n, grams in features(text.as_py() or b"", longest):
                    words[i] += n
                    total[i] += len(grams)
                    weight[i] += gain[grams % buckets].sum()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words), pa.array(total), pa.array(weight)],
                                             names=["id", "n_words", "n_features", "weight"])
    return run


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", longest: int = NGRAM, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` for every row of ``docs``; ``rank`` from 1 where drawn.

    ``percent`` of the rows with at least ``least_words`` words are drawn.  A null
    or empty text has no features and the weight 0.  A null id is hashed as an
    empty one and comes last among ties; rows that repeat an id are rows of
    their own with the same noise.  Other columns are not read.  An empty table
    gives an empty result, an empty target plain smoothing.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resample")
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    weighed = texts.mapInArrow(_weigh(gain, longest), f"id {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    with arrow_batches(spark):
        rows = scratch.save(weighed.withColumn("score", F.col("weight") + noise), "weights")
    able = rows.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features").asc()]
    ranked = sorted_rank(scratch, able, order, "rank").withColumn(
        "rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    others = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")

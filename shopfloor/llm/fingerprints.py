"""Operator 13: document fingerprints by one-permutation MinHash with packed low-order bits.

Every shingle of a text is hashed once; the hash names a bin and the smallest hash
of each bin stays.  Empty bins copy from filled ones by optimal densification.
Of each bin the lowest ``BITS`` bits are stored, packed, and shown in hex.  Two
unequal bins agree in these bits by chance once in ``2 ** BITS``, so the share of
equal bins is corrected by that before it is a likeness.

:func:`fingerprints` needs no shuffle.  :func:`neighbour_edits` compares every
document with its successor in an order and with an edited copy of itself, whose
end is the successor's beginning.  For this each text moves once, into range
partitions of that order; a partition streams through its task, and only the two
documents at its ends, which wait for a neighbour of another task, are written with
their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import Scratch, arrow_batches, table, text_chunks, whole_texts
from shopfloor.llm.minhash import SHINGLE, signatures
from shopfloor.llm.wordhash import U, mix, shingles

BINS, BITS = 512, 4
PART_BYTES = 32 << 20  # text of a range partition


def pack(signature: np.ndarray, filled: np.ndarray, bits: int = BITS) -> list[bytes]:
    """The low bits of each bin, most significant first; no bytes without shingles."""
    low = mix(signature) & U((1 << bits) - 1)
    spread = ((low[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=U)) & U(1)).astype(np.uint8)
    packed = np.packbits(spread.reshape(len(low), -1), axis=1)
    return [row.tobytes() if some else b"" for row, some in zip(packed, filled)]


def of_texts(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> list[bytes]:
    n = len(offsets) - 1
    sets, doc = shingles(data, offsets, size)
    return pack(signatures(sets, doc, n, bins), np.bincount(doc, minlength=n) > 0, bits)


def likeness(a: list[bytes], b: list[bytes], bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """Estimated share of common shingles, 0 to 1; two texts without words are alike, one without is unlike any other."""
    out = np.array([float(x == y) for x, y in zip(a, b)])
    both = [i for i, (x, y) in enumerate(zip(a, b)) if x and y]
    if both:
        x, y = (np.unpackbits(np.frombuffer(b"".join(s[i] for i in both), np.uint8)
                              .reshape(len(both), -1), axis=1)[:, :bins * bits] for s in (a, b))
        equal = (x == y).reshape(len(both), bins, bits).all(axis=2).mean(axis=1)
        chance = 0.5 ** bits
        out[both] = np.clip((equal - chance) / (1 - chance), 0, 1)
    return out


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _fingerprints(size: int, bins: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(of_texts(data, offsets, size, bins, bits), pa.binary())],
                                             names=["id", "fingerprint"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``(id, fingerprint)`` of every row.

    Words and shingles are those of operator 1.  Equal texts, and texts with
    equal sets of shingles, have equal fingerprints; null, empty and wordless
    texts have the empty one.  Null and repeated ids are kept as they are, other
    columns are not read, an empty table gives an empty result.
    """
    texts = whole_texts(docs, id_col, text_col)
    made = texts.mapInArrow(_fingerprints(size, bins, bits),
                            f"id {texts.schema['id'].dataType.simpleString()}, fingerprint binary")
    return made.select("id", in_hex("fingerprint"))


def edited(text: str, successor: str) -> str:
    """The text with the last third of its code points replaced by the successor's first as many."""
    cut = len(text) // 3
    return text[:len(text) - cut] + successor[:cut]


# Bytes until the end: text in hex would take twice the room in the written rows.
RESULT = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
IN_BYTES = NAMES[1:4]


def in_hex(name: str) -> Column:
    return F.lower(F.hex(name)).alias(name)


class Judge:
    """Results of rows ``(id, text, successor's text)``."""

    def __init__(self, size: int, bins: int, bits: int):
        self.made = lambda data: of_texts(*_joined(data), size, bins, bits)
        self.alike = lambda a, b: likeness(a, b, bins, bits)

    def columns(self, texts: list[str], successors: list[str], own: list[bytes], following: list[bytes]) -> list[pa.Array]:
        changed = [edited(t, s).encode() for t, s in zip(texts, successors)]
        other = self.made(changed)
        return [pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(c).digest() for c in changed], pa.binary()), pa.array(own, pa.binary()),
                pa.array(other, pa.binary()), pa.array(self.alike(own, other)), pa.array(self.alike(own, following))]


FIRST, LAST = 1, 2  # ends of a partition; a row can be both


def _chain(size: int, bins: int, bits: int):
    """Rows in order, each judged with the one after it; a partition's first and last row carry their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(size, bins, bits)
        kind = held = part = None

        def ends(ids: pa.Array, number: int, end: int, text: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [ids, pa.array([number], pa.int32()), pa.array([end], pa.int32()), pa.array([text], pa.string()),
                 *[pa.nulls(1, pa.binary() if c in IN_BYTES else pa.int64() if c == "n_chars" else pa.float64())
                   for c in NAMES]], names=["id", "part", "end", "text", *NAMES])

        for batch, data, offsets in text_chunks(batches, "text"):
            kind = batch.column("id").type
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            own = of_texts(data, offsets, size, bins, bits)
            ids = batch.column("id")
            if held is None:
                part = batch.column("part")[0].as_py()
                yield ends(ids.slice(0, 1), part, FIRST, texts[0])
            else:
                ids = pa.concat_arrays([held[0], ids])
                texts, own = [held[1], *texts], [held[2], *own]
            if len(texts) > 1:
                done = len(texts) - 1
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(0, done), pa.array([part] * done, pa.int32()), pa.array([0] * done, pa.int32()),
                     pa.nulls(done, pa.string()), *judge.columns(texts[:-1], texts[1:], own[:-1], own[1:])],
                    names=["id", "part", "end", "text", *NAMES])
            held = (pa.array(ids.slice(len(ids) - 1, 1).to_pylist(), kind), texts[-1], own[-1])
        if held is not None:
            yield ends(held[0], part, LAST, held[1])
    return run


def _close(size: int, bins: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(size, bins, bits)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                text, successor = row.column("text")[0].as_py(), row.column("successor")[0].as_py()
                own = judge.made([text.encode(), successor.encode()])
                yield pa.RecordBatch.from_arrays(
                    [row.column("id"), *judge.columns([text], [successor], own[:1], own[1:])], names=["id", *NAMES])
    return run


def neighbour_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``id`` and the columns of ``RESULT``, bytes in lowercase hex, for every row.

    Successors follow in descending id, null ids last; the last row's is the
    first.  Rows with one id are ordered by a hash of their texts.  A null text
    is empty; a single row is its own successor.  Other columns are not read,
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "edits")
    texts = whole_texts(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    kind = texts.schema["id"].dataType.simpleString()
    length = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # The last key is only for rows alike in all others, so that no value, however common, is one task.
    order = [F.col("id").desc_nulls_last(), F.col("hash"), F.col("number")]
    spread = texts.withColumn("hash", F.xxhash64("text")).withColumn("number", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(max(1, -(-length // PART_BYTES)), *order).sortWithinPartitions(*order)
    chained = ranged.select("id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _chain(size, bins, bits), f"id {kind}, part int, end int, text string, {RESULT}")
    with arrow_batches(spark):
        rows = scratch.save(chained, "rows")
    # One row per partition: its last document waits for the first of the next one, the very last for the very first.
    starts = rows.where(F.col("end") == FIRST).select("part", F.col("text").alias("successor"))
    parts = starts.select("part")
    following = F.lead("part").over(Window.orderBy("part"))
    lowest = F.min("part").over(Window.orderBy("part"))
    pairs = parts.select("part", F.coalesce(following, lowest).alias("_next"))
    waiting = rows.where(F.col("end") == LAST).select("id", "part", "text").join(pairs, "part").join(
        starts.withColumnRenamed("part", "_next"), "_next").select("id", "text", "successor")
    with arrow_batches(spark, 8):
        closed = scratch.save(waiting.mapInArrow(_close(size, bins, bits), f"id {kind}, {RESULT}"), "ends")
    every = rows.where(F.col("end") == 0).select("id", *NAMES).unionByName(closed)
    return every.select("id", *[in_hex(c) if c in IN_BYTES else F.col(c) for c in NAMES])


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_edits(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")

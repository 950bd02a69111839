"""Operator 7: hierarchical multi-length packing of documents into training windows.

One pass tokenises the texts.  A document's full windows of the longest
context size are sequences of their own; what is left of it goes, uncut, to
the tier of the smallest context size that holds it.  The plan needs only how
many pieces there are of each length (at most one row per length, whatever the
input), so it is made on the driver: long windows first take one piece of
their tier and fill their gap with the longest pieces of shorter tiers that
fit; then each shorter tier is packed the same way in windows of its own size.
A window that nothing fills exactly grows to the next context size and goes on
filling.  Windows of one make-up are one pattern with a multiplicity.

Pieces are numbered within their length (distributed, without gaps), and the
number alone says which window of which pattern a piece belongs to.  Sequences
of every tier are dealt in turn over step groups, so that each group holds as
many of each tier as any other, give or take one.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from shopfloor.llm.common import Scratch, arrow_batches, gapless_rank, table, whole_texts
from shopfloor.llm.tokens import TOKENIZER, byte_symbols

TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_TOKENS = 64 * 2048


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes, equal to those of the vocabulary file's own library.

    The file's vocabulary is given to a faster library as byte strings with
    their ranks (an id is a rank here); the tests hold both against each other.
    Strings of added tokens inside a text are those tokens, as the file has it.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in enumerate(byte_symbols())}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): rank for token, rank in spec["model"]["vocab"].items()
                 if token not in added}
        self.library = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                         special_tokens=added)

    def encode(self, text: str) -> bytes:
        return self.library.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes() if text else b""


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _cut(path: str, window: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            which, start, length, crc, total, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = e.encode(text.as_py() or "") + end
                n = len(ids) // 4
                for at in range(0, n, window):
                    part = ids[4 * at:4 * min(at + window, n)]
                    which.append(i)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    kept.append(part if with_ids else None)
            columns = [batch.column(0).take(pa.array(which, pa.int64())), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(total, pa.int64())]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(kept, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def plan(counts: dict[int, int], tiers: tuple[int, ...] = TIERS) -> list[tuple[tuple[int, ...], int, int]]:
    """Patterns ``(lengths, context size, how many)`` that use every piece of ``counts`` exactly once."""
    top = tiers[-1]
    left = {n: c for n, c in counts.items() if c > 0}
    lower = list(range(top + 1))  # lower[n]: no length above it and up to n has pieces left

    def longest(n: int) -> int:
        path = []
        while n > 0 and not left.get(n):
            path.append(n)
            n = min(lower[n], n - 1)
        for p in path:
            lower[p] = n
        return n

    out = []
    for size in reversed(tiers):
        floor = max([t for t in tiers if t < size], default=0)
        for n in range(size, floor, -1):
            while left.get(n):
                made, room = {n: 1}, size
                left[n] -= 1
                gap = room - n
                while gap or room < top:
                    fit = longest(gap) if gap else 0
                    if fit:
                        made[fit] = made.get(fit, 0) + 1
                        left[fit] -= 1
                        gap -= fit
                    elif gap and room < top:
                        larger = min(t for t in tiers if t > room)
                        gap, room = gap + larger - room, larger
                    else:
                        break
                # Every further window of this make-up at once, until one of its lengths runs out.
                more = min(left[k] // v for k, v in made.items())
                for k, v in made.items():
                    left[k] -= more * v
                out.append((tuple(k for k, v in sorted(made.items(), reverse=True) for _ in range(v)), room, 1 + more))
    return out


def layout(patterns: list[tuple[tuple[int, ...], int, int]], step_tokens: int) -> dict[str, np.ndarray]:
    """For each run of equal slots: its length, first piece number, first sequence, offset, tier and step group."""
    groups = max(1, -(-sum(size * times for _, size, times in patterns) // step_tokens))
    rows, first, used, in_tier, turned = [], 0, {}, {}, 0
    for made, size, times in sorted(patterns, key=lambda p: (-p[1], p[0])):
        dealt = in_tier.setdefault(size, turned)
        offset = 0
        for n in made:
            rows.append((n, used.get(n, 0), first, offset, size, dealt % groups))
            used[n] = used.get(n, 0) + times
            offset += n
        in_tier[size] = dealt + times
        turned = dealt + times  # the next tier goes on where this one stopped
        first += times
    rows.sort()
    table_ = np.array(rows or [(0, 0, 0, 0, 0, 0)], np.int64)
    names = ("length", "number", "sequence", "offset", "tier", "group")
    return dict(zip(names, table_.T)) | {"groups": np.array([groups])}


def _place(slots: dict[str, np.ndarray]):
    keys = (slots["length"] << 44) | slots["number"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("number").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << 44) | number, side="right") - 1
            nth = number - slots["number"][at]
            made = {"sequence_id": slots["sequence"][at] + nth, "offset": slots["offset"][at],
                    "tier": slots["tier"][at], "step_group": (slots["group"][at] + nth) % slots["groups"][0]}
            keep = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array(v) for v in made.values()],
                                             names=keep + list(made))
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS,
         end_id: int = END_ID, step_tokens: int = STEP_TOKENS, tokenizer: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group``.

    ``tier`` is the context size of the piece's sequence.  A null or empty text
    is the end id alone.  Rows that repeat an id are packed each on their own, a
    null id is kept.  ``with_ids`` adds the pieces' ids as bytes.  Other columns
    are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    path = str(tokenizer or public_tokenizers.path(TOKENIZER))
    kind = f"id {docs.schema[id_col].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    kind += ", ids binary" if with_ids else ""
    with arrow_batches(spark):
        pieces = scratch.save(whole_texts(docs, id_col, text_col).mapInArrow(
            _cut(path, tiers[-1], end_id, with_ids), kind), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # a row per length
    slots = layout(plan(counts, tiers), step_tokens)
    numbered = gapless_rank(scratch, pieces, "length", ["id", "start", "ids_crc32", "doc_tokens"], "number")
    return numbered.mapInArrow(_place(slots), kind + ", sequence_id long, offset long, tier long, step_group long")


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")

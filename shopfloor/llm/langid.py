"""Operator 8: language identification, known words first, then backoff to character n-grams.

The model is fitted on a bounded sample of the labelled texts of each language
(``FIT_ROWS`` different texts in a hash order, ``FIT_BYTES`` bytes): counts of words per
language and counts of character n-grams of those words.  All bounds are a language's
own, so a rare language is learned from what it has.  A word of the model scores by its log frequency in each
language.  Any other word backs off: its longest n-grams score where the model
knows them, and a place whose n-gram is unknown falls back to the next
shorter one, each step at a penalty that is the same for all languages.  The
text's score is the softmax of the summed, length-damped evidence.

Scoring runs in tasks on whole texts, vectorised over code points.  The model
is bounded by its parameters (``MAX_WORDS``, ``MAX_GRAMS`` of each language) and travels
with the task closure.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import CHUNK_BYTES, Scratch, table, uniform, whole_texts
from shopfloor.llm.wordhash import U, mix

FIT_ROWS = 1000  # different texts of a language
FIT_BYTES = 4 << 20  # and their UTF-8 bytes together
MAX_WORDS = 20_000  # of a language, kept by count
MAX_GRAMS = 60_000
SIZES = (5, 4, 3, 2, 1)
UNDETERMINED = "und"
LONG = 64  # longer runs of letters are hashed one by one
_EDGE = 1  # code point that stands for a word's edge


@dataclass
class Model:
    langs: list[str]
    word_keys: np.ndarray  # sorted hashes
    word_logs: np.ndarray  # (words, langs) float32
    gram_keys: dict[int, np.ndarray]
    gram_logs: dict[int, np.ndarray]


_kinds: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """For every code point: 2 for a letter, 1 for a mark (it continues a word), 0 for all others."""
    if not _kinds:
        value = {"L": 2, "M": 1}
        _kinds.append(np.array([value.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)],
                               np.uint8))
    return _kinds[0]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, a line feed after each, and the texts' places."""
    joined = "\n".join(t.lower().replace("\n", " ") for t in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.flatnonzero(points == 10)


def split_words(points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and text of every run of letters and marks."""
    inside = kinds()[points] > 0
    change = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    return start, end, np.searchsorted(ends, start)


def _gram_keys(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n code points from each place on (places near the end wrap and are never used)."""
    key = np.full(len(points), n, U)
    for k in range(n):
        key = key * U(0x9E3779B97F4A7C15) + np.roll(points, -k) + U(1)
    return mix(key)


def word_keys(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    length = end - start
    key = np.zeros(len(start), U)
    left = np.flatnonzero(length <= LONG)
    for k in range(int(length[left].max(initial=0))):
        left = left[length[left] > k]
        key[left] = key[left] * U(0x9E3779B97F4A7C15) + points[start[left] + k] + U(1)
    for i in np.flatnonzero(length > LONG).tolist():
        key[i] = int.from_bytes(blake2b(points[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(key + length.astype(U) * U(0xC2B2AE3D27D4EB4F))


def padded(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words one after the other with an edge before and after each, and each place's word and room to its end."""
    length = end - start + 2
    stop = np.cumsum(length)
    owner = np.repeat(np.arange(len(start)), length)
    offset = np.arange(int(stop[-1]) if len(stop) else 0) - np.repeat(stop - length, length)
    edge = (offset == 0) | (offset == length[owner] - 1)
    source = np.clip(start[owner] + offset - 1, 0, max(len(points) - 1, 0))
    return np.where(edge, np.uint32(_EDGE), points[source]).astype(np.uint32), owner, length[owner] - offset


def _log_table(counts: dict[str, Counter], langs: list[str], most: int) -> tuple[np.ndarray, np.ndarray]:
    kept = {k for c in counts.values() for k, _ in sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:most]}
    keys = np.array(sorted(kept), U)
    rows = np.array([[counts[g].get(int(k), 0) for g in langs] for k in keys], np.float64).reshape(len(keys), len(langs))
    sums = np.array([max(sum(counts[g].values()), 1) for g in langs], np.float64)
    return keys, np.log((rows + 0.5) / (sums + 0.5 * max(len(keys), 1))).astype(np.float32)


def fit(rows: list[tuple[str, str]], max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """A model from (text, lang) rows."""
    langs = sorted({g for _, g in rows})
    words: dict[str, Counter] = {g: Counter() for g in langs}
    grams = {n: {g: Counter() for g in langs} for n in SIZES}
    for g in langs:
        texts = [t for t, h in rows if h == g]
        for at in range(0, len(texts), 200):
            points, ends = code_points(texts[at:at + 200])
            start, end, _ = split_words(points, ends)
            if not len(start):
                continue
            keys, first, count = np.unique(word_keys(points, start, end), return_index=True, return_counts=True)
            words[g].update(dict(zip(keys.tolist(), count.tolist())))
            flat, _, room = padded(points, start, end)  # n-grams weighted by their words' counts
            for n in SIZES:
                k, c = np.unique(_gram_keys(flat, n)[room >= n], return_counts=True)
                grams[n][g].update(dict(zip(k.tolist(), c.tolist())))
    wk, wl = _log_table(words, langs, max_words)
    tables = {n: _log_table(grams[n], langs, max_grams // len(SIZES)) for n in SIZES}
    return Model(langs, wk, wl, {n: t[0] for n, t in tables.items()}, {n: t[1] for n, t in tables.items()})


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return (keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)), at


def score(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language (index), its probability, and whether the text has a letter, for each text."""
    n, m = len(texts), len(model.langs)
    points, ends = code_points(texts)
    start, end, doc = split_words(points, ends)
    evidence = np.zeros((n, max(m, 1)))
    count = np.bincount(doc, minlength=n).astype(float)
    if m and len(start):
        unique, first, back = np.unique(word_keys(points, start, end), return_index=True, return_inverse=True)
        known, at = _find(model.word_keys, unique)
        logs = np.zeros((len(unique), m), np.float32)
        logs[known] = model.word_logs[at[known]]
        unseen = np.flatnonzero(~known)
        if len(unseen):
            flat, owner, room = padded(points, start[first[unseen]], end[first[unseen]])
            open_ = np.ones(len(flat), bool)
            gram = np.zeros((len(unseen), m))
            for size in SIZES:
                place = np.flatnonzero(open_ & (room >= size))
                hit, g = _find(model.gram_keys[size], _gram_keys(flat, size)[place])
                place, g = place[hit], g[hit]
                for j in range(m):
                    gram[:, j] += np.bincount(owner[place], model.gram_logs[size][g, j], len(unseen))
                open_[place] = False
            logs[unseen] = gram / np.maximum(np.bincount(owner, minlength=len(unseen)), 1)[:, None] * 2.0
        for j in range(m):
            evidence[:, j] = np.bincount(doc, logs[back, j], n)
    evidence /= np.sqrt(np.maximum(count, 1))[:, None]
    evidence -= evidence.max(axis=1, keepdims=True)
    p = np.exp(evidence)
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    letters = np.concatenate([[0], np.cumsum(kinds()[points] == 2)])
    starts = np.concatenate([[0], ends[:-1] + 1])
    return best, p[np.arange(n), best], letters[ends] > letters[starts]


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*model.langs, UNDETERMINED]
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            at = 0
            while at < len(texts):
                end, room = at + 1, CHUNK_BYTES - len(texts[at])
                while end < len(texts) and len(texts[end]) <= room:
                    room -= len(texts[end])
                    end += 1
                best, p, some = score(model, texts[at:end])
                some &= bool(model.langs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at),
                     pa.array([names[b] if s else UNDETERMINED for b, s in zip(best.tolist(), some.tolist())]),
                     pa.array(np.where(some, p, 0.0))], names=["id", "lang_pred", "score"])
                at = end
    return run


def train(docs: DataFrame, fold, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> Model:
    """Fit on at most ``fit_rows`` different labelled texts of the fold a language, the first in a hash order.

    Of these, the first whose bytes together stay within ``fit_bytes`` are learned
    whole; a longer text is passed over, never cut.  Copies count once, null texts
    not at all.  ``id_col`` is not read: the order is of the texts.  Counts a language
    narrow the hash range first, so that tasks send little more than the sample.
    """
    text = F.col(text_col).cast("string")
    rows = docs.where(fold & F.col(lang_col).isNotNull() & text.isNotNull()).select(
        F.col(lang_col).cast("string").alias("g"), text.alias("t"), F.xxhash64(text, F.lit(8)).alias("h"))
    # Narrow rows choose the sample; small written tables let the planner see their size, so no text is shuffled for it.
    scratch = Scratch(docs.sparkSession, "languages")
    narrow = rows.select("g", "h", F.octet_length("t").alias("b"))
    count = scratch.save(narrow.groupBy("g").agg(F.count("*").alias("n")), "counts")
    near = narrow.join(count, "g").where((uniform("h") * F.col("n") < 3.0 * fit_rows) & (F.col("b") <= fit_bytes))
    order = Window.partitionBy("g").orderBy(uniform("h"), "h")
    first = near.select("g", "h", "b").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= fit_rows)
    first = first.withColumn("sum", F.sum("b").over(order)).where(F.col("sum") <= fit_bytes)
    first = scratch.save(first.select("g", "h"), "sample")
    found = rows.join(first, ["g", "h"]).groupBy("g", "h").agg(F.first("t").alias("t")).orderBy("g", "h").collect()
    scratch.clear([])
    return fit([(r["t"], r["g"]) for r in found])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` for every row.

    Null texts and texts without a letter, and all texts under a model without
    languages, are ``und`` with score 0.  Null and repeated ids are scored row
    by row; other columns are not read.  An empty table gives an empty result.
    """
    return whole_texts(docs, id_col, text_col).mapInArrow(
        _scorer(model), f"id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")


def remainder(id_col: str, k: int):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % k


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, remainder("doc_id", 4) != 2)
    return identify(docs, model).select(F.col("id").alias("doc_id"), (remainder("id", 4) == 2).alias("held_out"),
                                        "lang_pred", "score")


def _keeper(model: Model, text_col: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_all = _scorer(model)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            pair = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(at)], names=["id", "text"])
            for found in score_all([pair]):
                good = [i for i, lang, p in zip(*(c.to_pylist() for c in found.columns))
                        if lang != UNDETERMINED and p >= least]
                yield batch.take(pa.array(good, pa.int64()))
    return run


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with at least the given score."""
    return docs.mapInArrow(_keeper(model, text_col, least), docs.schema)

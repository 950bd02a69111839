"""Operator 11: hard negatives by a BOND vertical scan.

Vectors are kept by columns, one array per dimension.  An anchor reads the
columns in the order of its own components, largest magnitude first.  After
every few columns each candidate has a partial score; the least and the most that
the unread columns can add follow from their minima and maxima.  Candidates
whose bounds can no longer matter leave the anchor's bitmap, and the scan goes on
over the others until their scores are exact.

Two scans are made.  The first keeps each anchor's best rows of its own label (the
positives).  Their scores fix windows of scores, and the second keeps the best
rows of other labels inside each window (the negatives).  A row's components are
whole numbers, so every sum and bound is exact.

All rows are dealt to stripes of a bounded size; a task holds one stripe's columns
and the anchors, a stated share of the rows, stream past it.  There are as many
stripes as memory and the cluster's parallelism ask for, so the anchors are
copied that often and not once per block of rows.  A stripe answers with the
best few rows of each anchor; Spark ranks these few over all stripes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import Scratch, arrow_batches, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
ANCHOR_EVERY = 50
STRIPE_BYTES = 64 << 20  # columns that a task holds
STRIPE_ROWS = 4096  # rows a stripe has at least, as long as memory allows
COLUMNS_AT_ONCE = 8
BATCH_ROWS = 2048
EXACT = float(1 << 53)  # whole numbers below this are exact in doubles


def whole(x: np.ndarray) -> np.ndarray:
    """Python integers of whole doubles, for scores too large for exact doubles."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def kth(x: np.ndarray, k: int):
    """The k-th largest value."""
    return np.partition(x, len(x) - k)[len(x) - k] if x.dtype != object else sorted(x)[-k]


def scan(columns: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, bitmap: np.ndarray,
         keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the candidates (``bitmap``) that no bound rules out.

    ``keep`` gets lower and upper bounds of the scores of what is left and says
    what stays; at the end both are the score itself.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    if (np.abs(anchor) * np.maximum(np.abs(low), np.abs(high))).sum() >= EXACT:
        columns, low, high, anchor = (whole(x) for x in (columns, low, high, anchor))
    ends = np.stack([anchor * low, anchor * high])[:, order]
    zero = ends[:1, :0].sum(axis=1)
    least = np.concatenate([np.cumsum(ends.min(axis=0)[::-1])[::-1], zero]) if len(order) else zero
    most = np.concatenate([np.cumsum(ends.max(axis=0)[::-1])[::-1], zero]) if len(order) else zero
    alive = np.flatnonzero(bitmap)
    score = np.zeros(len(alive), columns.dtype)
    at = 0
    while len(alive):
        dims = order[at:at + COLUMNS_AT_ONCE]
        if len(dims):
            part = columns[dims] if len(alive) == columns.shape[1] else columns[np.ix_(dims, alive)]
            score = score + anchor[dims] @ part
        at += len(dims)
        stays = keep(score + least[at], score + most[at])
        if not stays.all():
            bitmap[alive[~stays]] = False
            alive, score = alive[stays], score[stays]
        if at >= len(order):
            break
    return alive, score


def best(k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Keeps what can be among the ``k`` highest scores."""
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= kth(lower, k) if len(lower) > k else np.ones(len(lower), bool)
    return keep


def best_inside(windows: list[tuple[int, int]], k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Keeps what can be among the ``k`` highest scores inside any of the windows."""
    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lower), bool)
        for low, high in windows:
            may = (upper >= low) & (lower <= high)
            sure = lower[(lower >= low) & (upper <= high)]
            out |= may & (upper >= kth(sure, k)) if len(sure) > k else may
        return out
    return keep


def first(places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the ``k`` highest scores, ties by place, without sorting all."""
    if len(scores) > k:
        limit = kth(scores, k)
        above = np.flatnonzero(scores > limit)
        rows = np.concatenate([above, np.flatnonzero(scores == limit)[:k - len(above)]])
    else:
        rows = np.arange(len(scores))
    return rows


class Stripe:
    """The columns of a stripe's vectors of one length, ordered by label and then by id (nulls last)."""

    def __init__(self, keys: np.ndarray, ids: pa.Array, labels: np.ndarray, matrix: np.ndarray):
        nulls = ids.is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((ids.fill_null(0).to_numpy(zero_copy_only=False), nulls, labels))
        self.ids, self.keys, self.labels = ids.take(pa.array(order)), keys[order], labels[order]
        self.columns = np.ascontiguousarray(matrix[order].T)
        self.ties = np.empty(len(order), np.int64)  # places in the order of ids alone
        by_id = np.lexsort((np.arange(len(order)), self.ids.fill_null(0).to_numpy(zero_copy_only=False), nulls[order]))
        self.ties[by_id] = np.arange(len(order))
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def same_label(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right")))

    def positives(self, key: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        part = self.same_label(label)
        columns = self.columns[:, part]
        if not columns.shape[1]:
            return np.zeros(0, np.int64), np.zeros(0)
        places, scores = scan(columns, columns.min(axis=1), columns.max(axis=1), anchor, self.keys[part] != key, best(k))
        rows = first(places, scores, k)
        return places[rows] + part.start, scores[rows]

    def negatives(self, label: int, anchor: np.ndarray, windows: list[tuple[int, int]],
                  k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        bitmap = np.ones(len(self.keys), bool)
        bitmap[self.same_label(label)] = False
        places, scores = scan(self.columns, self.low, self.high, anchor, bitmap, best_inside(windows, k))
        by_id = np.argsort(self.ties[places], kind="stable")
        places, scores = places[by_id], scores[by_id]
        out = []
        for low, high in windows:
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            rows = inside[first(places[inside], scores[inside], k)]
            out.append((places[rows], scores[rows]))
        return out


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each vector length and their whole components (floor of SCALE times each)."""
    lists = batch.column("v")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    starts = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        yield rows, flat[starts[rows][:, None] + np.arange(dim)]


def _hold(parts: list[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]) -> dict[int, Stripe]:
    out = {}
    for dim in {m.shape[1] for *_, m in parts}:
        mine = [p for p in parts if p[3].shape[1] == dim]
        out[dim] = Stripe(np.concatenate([p[0] for p in mine]), pa.concat_arrays([p[1] for p in mine]),
                          np.concatenate([p[2] for p in mine]), np.concatenate([p[3] for p in mine]))
    return out


def _search(answer: Callable[[Stripe, int, int, np.ndarray, list[int]], list[tuple[int, np.ndarray, np.ndarray]]]):
    """Rows of a stripe first, then the anchors that are compared with them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripe, parts, held = None, [], None
        for whole_batch in batches:
            numbers, kinds = whole_batch.column("stripe").to_numpy(), whole_batch.column("anchor").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), whole_batch.num_rows]):
                if a == b:
                    continue
                batch = whole_batch.slice(a, b - a)
                if numbers[a] != stripe:
                    stripe, parts, held = numbers[a], [], None
                keys, labels = batch.column("key").to_numpy(), batch.column("label").to_numpy()
                if not kinds[a]:
                    for rows, matrix in _vectors(batch):
                        parts.append((keys[rows], batch.column("id").take(pa.array(rows)), labels[rows], matrix))
                    continue
                if held is None:
                    held, parts = _hold(parts), []
                found = []
                for rows, matrix in _vectors(batch):
                    if matrix.shape[1] not in held:
                        continue
                    mine, scores = held[matrix.shape[1]], batch.column("scores").take(pa.array(rows)).to_pylist()
                    for row, vector, known in zip(rows.tolist(), matrix, scores):
                        for at, places, values in answer(mine, int(keys[row]), int(labels[row]), vector, known):
                            if len(places):
                                found.append((np.full(len(places), keys[row]), np.full(len(places), at, np.int64),
                                              mine.ids.take(pa.array(places)), [int(v) for v in values]))
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found])),
                        pa.concat_arrays([f[2] for f in found]), pa.array([v for f in found for v in f[3]], pa.int64())],
                        names=["anchor", "at", "id", "score"])
    return run


FOUND = "anchor long, at long, id long, score long"


def _positives(k: int):
    return _search(lambda rows, key, label, anchor, known: [(0, *rows.positives(key, label, anchor, k))])


def _negatives(k: int, low: int, high: int):
    def answer(rows: Stripe, key: int, label: int, anchor: np.ndarray, known: list[int]):
        windows = [(-(-low * s // 100), high * s // 100) for s in known]
        return [(s, *found) for s, found in zip(known, rows.negatives(label, anchor, windows, k))]
    return _search(answer)


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str | Column = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the rows' own columns.  For each anchor row
    and each of its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of another label whose score lies between ``low`` and
    ``high`` per cent of the positive's.  Higher scores come first, ties by
    smaller id, null ids last.

    * A null label, a null vector, or a null or non-finite component: the row takes no part.
    * Only vectors of the same length are compared; empty vectors have the score 0.
    * Rows that repeat an id, or all values, are rows of their own (a copy of the anchor is another row).
    * A negative positive score has an empty window; a score that no long holds raises an error.
    * Labels are whole numbers.  Other columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    v = F.col(vector_col).cast("array<double>")
    good = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                          F.when(good, v).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = rows.where("label IS NOT NULL AND v IS NOT NULL").withColumn("key", F.monotonically_increasing_id())
    rows = scratch.save(rows, "rows")
    size = rows.agg(F.count("*").alias("n"), F.sum(8 * F.size("v")).alias("bytes")).first()
    at_once = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stripes = max(1, -(-(size["bytes"] or 0) // STRIPE_BYTES), min(at_once, -(-size["n"] // STRIPE_ROWS)))

    def search(anchors: DataFrame, task, name: str) -> DataFrame:
        """What the task finds for ``anchors(key, label, v, scores)`` in every stripe."""
        dealt = rows.select(F.pmod(F.xxhash64("key"), F.lit(stripes)).cast("int").alias("stripe"),
                            F.lit(False).alias("anchor"), "key", "id", "label", "v",
                            F.lit(None).cast("array<long>").alias("scores"))
        asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"),
                               F.lit(True).alias("anchor"), "key", F.lit(None).cast("long").alias("id"), "label", "v", "scores")
        both = dealt.unionByName(asked).repartition(stripes, "stripe").sortWithinPartitions("stripe", "anchor")
        with arrow_batches(spark, BATCH_ROWS):
            return scratch.save(both.mapInArrow(task, FOUND), name)

    anchors = rows.where("is_anchor")
    best_first = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    found = search(anchors.withColumn("scores", F.array().cast("array<long>")), _positives(positives), "positives")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*best_first))
    chosen = scratch.save(found.withColumn("place", place).where(F.col("place") <= positives)
                          .select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "chosen")
    windows = chosen.where("positive_score >= 0").groupBy(F.col("anchor").alias("key")).agg(
        F.collect_set("positive_score").alias("scores"))  # at most one per positive
    found = search(anchors.join(windows, "key"), _negatives(negatives, low, high), "negatives")
    rank = F.row_number().over(Window.partitionBy("anchor", "at").orderBy(*best_first))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor", F.col("at").alias("positive_score"), "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    named = anchors.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    return chosen.join(ranked, ["anchor", "positive_score"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % ANCHOR_EVERY == 0, label_col=moved)

"""Operator 6: quality classifier, a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded, learned filters run over windows of
``WIDTH`` bytes that overlap by half, and windows are grouped into chunks that
cover the whole text and overlap each other.  A chunk keeps each filter's
largest response; a text keeps the largest and the mean over its chunks, and
one logistic unit combines them into a probability.

Training is plain back-propagation with Adam on at most ``FIT_ROWS`` labelled
rows on the driver; the model has a few thousand numbers.  Scoring runs in
tasks on whole texts; a chunk of texts bounds each task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.common import table, text_chunks, uniform, whole_texts
from shopfloor.llm.langid import remainder

FIT_ROWS = 2000
FIT_BYTES = 32 << 20  # UTF-8 bytes of the fitted texts together
WIDTH, STRIDE = 8, 4
PLACES = 64  # windows in a chunk
FILTERS, DEPTH = 24, 4
STEPS, BATCH, RATE, SEED = 900, 32, 0.01, 7  # batches learned from, whatever the number of rows

Model = dict[str, np.ndarray]


def layout(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes plus one (0: nothing), each padded to whole chunks, and each text's first chunk."""
    step = PLACES * STRIDE
    length = np.diff(offsets)
    chunks = (length + (WIDTH - STRIDE)) // step + 1
    first = np.concatenate([[0], np.cumsum(chunks)])
    out = np.zeros(int(first[-1]) * step + WIDTH, np.int16)
    at = np.arange(len(data)) + np.repeat(first[:-1] * step - offsets[:-1], length)
    out[at] = data.astype(np.int16) + 1
    return out, first


def windows(model: Model, symbols: np.ndarray) -> np.ndarray:
    """Embedded windows, one row per place."""
    n = (len(symbols) - WIDTH) // STRIDE
    x = model["embed"][symbols].reshape(-1)
    view = np.lib.stride_tricks.as_strided(
        x, (n, WIDTH * DEPTH), (STRIDE * DEPTH * x.itemsize, x.itemsize), writeable=False)
    return np.ascontiguousarray(view)


def chunk_responses(model: Model, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows and each place's filter responses (chunks x places x filters), not below 0."""
    x = windows(model, symbols)
    r = x @ model["filters"]
    r += model["bias"]
    np.maximum(r, 0, out=r)
    r = r.reshape(-1, PLACES, FILTERS)
    r[first[1:] - 1, -1] = 0  # this window reaches into the next text
    return x, r


def features(peaks: np.ndarray, first: np.ndarray) -> np.ndarray:
    most = np.maximum.reduceat(peaks, first[:-1], axis=0)
    mean = np.add.reduceat(peaks, first[:-1], axis=0) / np.diff(first)[:, None]
    return np.concatenate([most, mean], axis=1)


def probability(model: Model, feats: np.ndarray) -> np.ndarray:
    z = feats.astype(np.float64) @ model["out"] + model["out_bias"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def predict(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    symbols, first = layout(data, offsets)
    peaks = []  # 4096 chunks are embedded at once
    for a in range(0, int(first[-1]), 4096):
        b = min(a + 4096, int(first[-1]))
        inner = first[(first > a) & (first <= b)] - a
        part = symbols[a * PLACES * STRIDE:b * PLACES * STRIDE + WIDTH]
        _, r = chunk_responses(model, part, np.concatenate([[0], inner]))
        peaks.append(r.max(axis=1))
    return probability(model, features(np.concatenate(peaks), first))


def initial(seed: int = SEED) -> Model:
    rng = np.random.default_rng(seed)
    return {"embed": rng.normal(0, 0.5, (257, DEPTH)).astype(np.float32),
            "filters": rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32), "out": np.zeros(2 * FILTERS), "out_bias": np.zeros(1)}


def gradients(model: Model, symbols: np.ndarray, first: np.ndarray, y: np.ndarray) -> Model:
    x, r = chunk_responses(model, symbols, first)
    best = r.argmax(axis=1)
    peaks = np.take_along_axis(r, best[:, None], axis=1)[:, 0]
    f = features(peaks, first)
    dz = (probability(model, f) - y) / len(y)
    g = {"out": f.T @ dz, "out_bias": np.array([dz.sum()])}
    owner = np.repeat(np.arange(len(y)), np.diff(first))
    df = dz[:, None] * model["out"][None, :]
    share = df[owner, FILTERS:] / np.diff(first)[owner][:, None]
    top = peaks == f[owner, :FILTERS]
    ties = np.add.reduceat(top, first[:-1], axis=0)[owner]
    dp = (share + np.where(top, df[owner, :FILTERS] / ties, 0)) * (peaks > 0)
    place = best + np.arange(len(best))[:, None] * PLACES
    g["filters"] = np.stack([dp[:, k] @ x[place[:, k]] for k in range(FILTERS)], axis=1)
    g["bias"] = dp.sum(axis=0)
    dx = (dp[:, :, None] * model["filters"].T[None]).reshape(-1, WIDTH, DEPTH)
    seen = symbols[(place.reshape(-1) * STRIDE)[:, None] + np.arange(WIDTH)].ravel()
    g["embed"] = np.stack([np.bincount(seen, dx[:, :, d].ravel(), 257) for d in range(DEPTH)], axis=1)
    return g


def fit(rows: list[tuple[str, int]], steps: int = STEPS, seed: int = SEED) -> Model:
    """A model from (text, label) rows; without rows, one that gives 0.5."""
    model = initial(seed)
    rng = np.random.default_rng(seed)
    rows = [(np.frombuffer(t.encode(), np.uint8), y) for t, y in rows]
    m = {k: np.zeros_like(v, dtype=np.float64) for k, v in model.items()}
    s = {k: np.zeros_like(v, dtype=np.float64) for k, v in model.items()}
    step, epochs = 0, -(-steps // max(1, -(-len(rows) // BATCH)))
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = [rows[i] for i in order[at:at + BATCH]]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t, _ in chosen])])
            symbols, first = layout(np.concatenate([t for t, _ in chosen]), offsets)
            g = gradients(model, symbols, first, np.array([y for _, y in chosen], float))
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for k in model:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                change = rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
                model[k] = (model[k] - change).astype(model[k].dtype)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", fold=None, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> Model:
    """Fit on at most ``fit_rows`` labelled rows of the fold and ``fit_bytes`` bytes, the first ids in a hash order.

    Sizes are read first, so the driver gets no more texts than that; a text beyond
    ``fit_bytes`` is passed over, never cut.

    Unlabelled rows, null ids and null texts are not learned from; of
    contradicting labels of one id the smallest counts.  The sampled ids are at
    most ``fit_rows`` rows, a fixed bound, so they are broadcast.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if fold is not None:
        known = known.where(fold)
    share = 1.5 * fit_rows / max(known.count(), 1)
    ids = (known.where(uniform(F.col(id_col)) < share).groupBy(F.col(id_col).alias("_id"))
           .agg(F.min(label_col).cast("int").alias("_y")).withColumn("_h", uniform(F.col("_id")))
           .orderBy("_h", "_id").limit(fit_rows))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    rows = texts.join(F.broadcast(ids), "_id").withColumn("_b", F.octet_length("_t"))
    rows = rows.where(F.col("_b") <= fit_bytes)
    order = ["_h", "_id", F.xxhash64("_t")]
    sizes = [r["_b"] for r in rows.orderBy(*order).limit(fit_rows).select("_b").collect()]
    within = int(np.searchsorted(np.cumsum(sizes), fit_bytes, side="right"))
    rows = rows.orderBy(*order).limit(within).select("_t", "_y").collect() if within else []
    return fit([(r["_t"], r["_y"]) for r in rows])


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predict(model, data, offsets))],
                                             names=["id", "score"])
    return run


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` for every row; a null text scores as an empty one; ids may be null or repeated.

    Other columns are not read; an empty table gives an empty result.
    """
    return whole_texts(docs, id_col, text_col).mapInArrow(
        _scorer(model), f"id {docs.schema[id_col].dataType.simpleString()}, score double")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), fold=remainder("doc_id", 3) != 1)
    return classify(docs, model).select(
        F.col("id").alias("doc_id"), (remainder("id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))

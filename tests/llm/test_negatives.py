from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "key", "v", "stripe", "anchor", "scores", "score", "rank", "is_anchor"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def brute(rows, anchors, positives=5, negatives_=3):
    good = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
            if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    last = 1 << 70
    for a, (i, v, y) in enumerate(good):
        if i is None or not anchors(i):
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), last if j is None else j, j, z)
                  for b, (j, w, z) in enumerate(good) if a != b and len(w) == len(v)]
        scored.sort(key=lambda r: r[:2])
        for s, _, j, _ in [r for r in scored if r[3] == y][:positives]:
            fits = [r for r in scored if r[3] != y and 50 * -s <= 100 * -r[0] <= 95 * -s][:negatives_]
            out += [(i, j, n + 1, r[2], -s, -r[0]) for n, r in enumerate(fits)]
    return sorted(out, key=repr)


def found(df, **kw):
    return sorted([tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, **kw).collect()], key=repr)


def awkward_rows():
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(6)], rng.randrange(3)) for i in range(90)]
    inf, nan = float("inf"), float("nan")
    rows += [(100, None, 1), (105, [1.0] * 6, None), (110, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (115, [nan] * 6, 1),
             (120, [inf] + [0.0] * 5, 2), (125, [], 1), (126, [], 1), (127, [], 2), (130, [0.0] * 6, 1),
             (135, [1.0, 2.0], 0), (136, [1.0, 2.0], 0), (137, [1.0, 1.2], 1), (140, [-1.0] * 6, 7),
             (10, rows[10][1], rows[10][2]), (10, rows[11][1], 2), (None, rows[12][1], 0), (None, rows[12][1], 1)]
    return rows + [(200 + i, [0.5] * 6, 0 if i % 2 else 1) for i in range(30)]  # one common vector


def test_awkward_rows_match_brute_force(spark):
    rows = awkward_rows()
    assert found(frame(spark, rows)) == brute(rows, lambda i: i % 5 == 0)
    assert found(frame(spark, rows), positives=1, negatives=50) == brute(rows, lambda i: i % 5 == 0, 1, 50)


def test_several_stripes_match_one(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(20, 16))
    rows = [(i, (base[i % 20] + 0.2 * rng.normal(size=16)).tolist(), int(i % 20 % 4)) for i in range(400)]
    monkeypatch.setattr(negatives, "STRIPE_BYTES", 16 * 8 * 30)
    monkeypatch.setattr(negatives, "BATCH_ROWS", 7)
    assert found(frame(spark, rows)) == brute(rows, lambda i: i % 5 == 0)


def test_many_labels_and_large_components(spark):
    rows = [(i, [float(i % 9 - 4) * 5e8, 2.0 ** 20, float(i)], i // 2) for i in range(60)]
    rows = [(i, [x / 256 for x in v], y) for i, v, y in rows]
    assert found(frame(spark, rows)) == brute(rows, lambda i: i % 5 == 0)
    with pytest.raises(Exception, match="(?i)overflow|too large|too big"):
        found(frame(spark, [(0, [1e200], 0), (1, [1e200], 0), (2, [0.9e200], 1)]))


def test_empty_table(spark):
    assert found(frame(spark, [])) == []


def test_bounds_drop_candidates_before_the_last_column():
    rng = np.random.default_rng(6)
    columns = np.floor(256 * rng.normal(size=(64, 3000)) * np.exp(-np.arange(64) / 4)[:, None])
    anchor = np.floor(256 * rng.normal(size=64) * np.exp(-np.arange(64) / 4))
    seen = []

    def keep(lower, upper):
        seen.append(len(lower))
        return negatives.best(5)(lower, upper)

    places, scores = negatives.scan(columns, columns.min(axis=1), columns.max(axis=1), anchor, np.ones(3000, bool), keep)
    exact = anchor @ columns
    assert set(negatives.first(places, scores, 5).tolist()) <= set(range(len(places)))
    assert sorted(scores[negatives.first(places, scores, 5)]) == sorted(exact)[-5:]
    assert len(seen) == 8 and seen[-1] < 300 and seen == sorted(seen, reverse=True)

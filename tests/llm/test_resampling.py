from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from helpers import LOWER, SCHEMA, awkward, awkward_rows, empty, prose
from pyspark.sql import functions as F

from shopfloor.llm import resampling

ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    w = ALNUM.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(gram):
    return zlib.crc32(gram.encode()) % 10000


def brute(rows, target):
    s, t = (Counter(bucket(g) for text in texts for g in grams(text)[1]) for texts in ([r[1] for r in rows], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for r in rows:
        words, found = grams(r[1])
        name = "42:" + ("" if r[0] is None else str(r[0]))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((r[0], len(words), len(found), weight, score))
    able = sorted([r for r in out if r[1] >= 20], key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able[:5 * len(able) // 100]


def check(found, rows, target):
    every, drawn = brute(rows, target)
    got = [tuple(r[c] for c in ("id", "n_words", "n_features", "weight", "score")) for r in found]
    assert sorted(got, key=repr) == sorted(every, key=repr)
    ranked = sorted([r for r in found if r["rank"] is not None], key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["id"], r["score"]) for r in ranked] == [(r[0], r[4]) for r in drawn]


def test_awkward_rows_match_brute_force(spark, monkeypatch):
    rows = awkward_rows() + [(1000 + i, prose(i % 60, 25), "en", "s", 1) for i in range(150)]
    rows += [(None, prose(3, 30), "en", "s", 1)] * 40 + [(7000, prose(3, 30), "en", "s", 1)] * 3
    rows += [(8000, "A1-b2_C3 é\x7fÉ x' " * 9, "en", "s", 1), (8001, "a", None, None, None), (8002, "a b", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "n_words", "weight", "score", "rank", "key", "bucket", "n", "_part"):
        df = df.withColumn(name, F.lit("clash"))
    target = spark.createDataFrame([(prose(1, 60),), (None,), ("",), (prose(70, 30),)], "text string")
    check(resampling.resample(df.repartition(3), target).collect(), rows, [prose(1, 60), prose(70, 30)])
    monkeypatch.setattr(resampling, "PIECE", 3)  # texts are split piece by piece; ranks come from several range partitions
    monkeypatch.setattr("shopfloor.llm.common.RANGE_ROWS", 40)
    assert [g for t in ("a b c d e f", " a ", "") for n, p in resampling.features(t.encode()) for g in p] != []
    for text in ("a b c d e f g", "  aa  bb", "one", "é è à ù", prose(2, 50)):
        got = sorted(int(g) for _, part in resampling.features(text.encode()) for g in part)
        assert got == sorted(zlib.crc32(g.encode()) for g in grams(text)[1])
    found = resampling.resample(df, target, percent=5).collect()
    check(found, rows, [prose(1, 60), prose(70, 30)])


def test_empty_tables(spark):
    nothing = empty(spark)
    assert resampling.resample(nothing, nothing).collect() == []
    rows = resampling.resample(awkward(spark), nothing).collect()
    check(rows, awkward_rows(), [])


def test_target_like_documents_are_drawn_first(spark):
    rows = [(i, prose(i, 200), "en", "s", 1) for i in range(190)] + [(500 + i, prose(999, 200), "en", "s", 1) for i in range(10)]
    target = spark.createDataFrame([(prose(999, 200),)] * 30, "text string")
    found = resampling.resample(spark.createDataFrame(rows, SCHEMA), target).where("rank IS NOT NULL").collect()
    assert len(found) == 10 and {r["id"] for r in found} == set(range(500, 510))

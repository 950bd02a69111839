from __future__ import annotations

import hashlib

import numpy as np
import pytest
from helpers import SCHEMA, awkward, awkward_rows, empty, prose, shingle_set
from pyspark.sql import functions as F

from shopfloor.llm import fingerprints as fp
from shopfloor.llm.wordhash import shingles


def mix(x: int) -> int:
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x = (x ^ x >> 27) * 0x94D049BB133111EB % (1 << 64)
    return x ^ x >> 31


def plain(text: str, bins=fp.BINS, bits=fp.BITS) -> str:
    """One shingle and one bin at a time."""
    data = np.frombuffer(text.encode(), np.uint8)
    hashes = [int(h) for h in shingles(data, np.array([0, len(data)]), 5)[0]]
    if not hashes:
        return ""
    kept: dict[int, int] = {}
    for h in hashes:
        at = (h >> 40) * bins >> 24
        kept[at] = min(kept.get(at, h), h)
    out = []
    for at in range(bins):
        attempt, donor = 0, at
        while donor not in kept:
            attempt += 1
            donor = mix((attempt * bins + at) * 0x9E3779B97F4A7C15 % (1 << 64)) % bins
        out.append(mix(kept[donor]) % (1 << bits))
    return f"{sum(v << bits * (bins - 1 - i) for i, v in enumerate(out)):0{bins * bits // 4}x}"


def alike(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    equal = np.mean([x == y for x, y in zip(a, b)])  # four bits are one hex digit
    return float(np.clip((equal - 1 / 16) / (15 / 16), 0, 1))


def expected(rows):
    rows = [(i, t or "") for i, t, *_ in rows]
    ids = {i for i, _ in rows}
    assert len(ids) == len(rows), "order of equal ids is not fixed here"
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for at, (i, text) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        cut = len(text) // 3
        changed = text[:len(text) - cut] + after[:cut]
        a, b = plain(text), plain(changed)
        out[i] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, alike(a, b), alike(a, plain(after)))
    return out


def distinct_ids():
    seen = {}
    for r in awkward_rows():
        seen.setdefault(r[0], r)
    return list(seen.values())


@pytest.mark.parametrize("part_bytes", [1 << 25, 2000])
def test_awkward_rows_match_brute_force(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(fp, "PART_BYTES", part_bytes)
    monkeypatch.setattr("shopfloor.llm.common.TEXT_ROWS", 3)
    rows = distinct_ids()
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "part", "end", "hash", "number", "successor", "_next", "fingerprint"):
        df = df.withColumn(name, F.lit("clash"))
    want = expected(rows)
    out = fp.neighbour_edits(df.repartition(3)).collect()
    assert len(out) == len(rows)
    for r in out:
        got = (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"])
        assert got[:4] == want[r["id"]][:4]
        assert got[4:] == pytest.approx(want[r["id"]][4:])


def test_repeated_rows_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(fp, "PART_BYTES", 500)
    rows = [(None, prose(1, 60), "en", "s", 1)] * 30 + [(4, prose(2, 60), "en", "s", 1)] * 5 + [(4, prose(3, 60), "en", "s", 1)] * 5
    out = fp.neighbour_edits(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(out) == 40
    assert sum(r["near_next"] == 1.0 for r in out) == 29 + 4 + 4  # all but the last of each kind
    own = {prose(k, 60): plain(prose(k, 60)) for k in (1, 2, 3)}
    assert {r["fingerprint"] for r in out} == set(own.values())
    again = fp.neighbour_edits(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_one_row_and_no_row(spark):
    assert fp.neighbour_edits(empty(spark)).collect() == []
    (row,) = fp.neighbour_edits(spark.createDataFrame([(3, "abc def", None, None, None)], SCHEMA)).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest() and row["near_next"] == 1.0
    (row,) = fp.neighbour_edits(spark.createDataFrame([(3, None, None, None, None)], SCHEMA)).collect()
    assert (row["n_chars"], row["fingerprint"], row["near_edited"], row["near_next"]) == (0, "", 1.0, 1.0)


def test_fingerprints_of_all_rows(spark):
    out = fp.fingerprints(awkward(spark)).collect()
    want = [(r[0], plain(r[1] or "")) for r in awkward_rows()]
    assert sorted([(r["id"], r["fingerprint"]) for r in out], key=repr) == sorted(want, key=repr)


def test_likeness_is_unbiased():
    errors = []
    for k in range(150):
        words = prose(k, 300).split(" ")
        cut = 20 + 2 * k % 260
        a, b = " ".join(words), " ".join(words[:cut] + prose(1000 + k, 300 - cut).split(" "))
        true = len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b))
        (x,), (y,) = (fp.of_texts(*fp._joined([t.encode()])) for t in (a, b))
        errors.append(fp.likeness([x], [y])[0] - true)
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.12

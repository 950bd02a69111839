from __future__ import annotations

import numpy as np

from helpers import components
from shopfloor.llm import embedding

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string"


def rows_of(vectors):
    return [(i, [float(x) for x in v] if v is not None else None, 0, "clash", "clash") for i, v in vectors]


def brute(vectors, least=0.9):
    good = {i: np.array(v, np.float32).astype(float) for i, v in vectors if v is not None and len(v)
            and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: 0 for i, _ in vectors}
    edges = []
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]):
                x, y = good[a], good[b]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    edges.append((a, b))
                    links[a] += 1
                    links[b] += 1
    return links, components([i for i, _ in vectors], edges)


def check(spark, vectors):
    df = spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(2)
    out = embedding.near_vectors(df).collect()
    links, comp = brute(vectors)
    assert {r["id"]: (r["links"], r["component"]) for r in out} == {i: (links[i], comp[i]) for i in comp}


def test_clusters_copies_and_odd_lengths(spark):
    rng = np.random.default_rng(0)
    vectors = []
    for c in range(6):
        centre = rng.normal(size=24)
        vectors += [(1000 * c + k, centre + 0.15 * rng.normal(size=24)) for k in range(25)]
    vectors += [(9000 + k, vectors[3][1]) for k in range(30)]  # copies
    vectors += [(9100 + k, 3.5 * vectors[3][1]) for k in range(3)]  # same direction
    vectors += [(9200 + k, rng.normal(size=5)) for k in range(20)]
    check(spark, vectors)


def test_bad_vectors_link_with_nothing(spark):
    check(spark, [(1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
                  (6, [1e-30, 1e-30]), (7, [1e30, 1e30]), (8, [1.0, 1.0]), (9, [1.0]), (10, [2.0]), (11, [-2.0])])


def test_null_components_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, None], 0, "", ""), (2, [1.0, None], 0, "", ""), (None, [1.0, 2.0], 0, "", ""),
                                (3, [1.0, 2.0], 0, "", "")], SCHEMA)
    out = sorted(embedding.near_vectors(df).collect(), key=str)
    assert {(r["id"], r["links"], r["component"]) for r in out} == {(1, 0, 1), (2, 0, 2), (None, 0, None), (3, 0, 3)}
    assert embedding.near_vectors(df.where("vec_id > 99")).collect() == []


def test_hadamard_keeps_length_and_inverts():
    x = np.random.default_rng(1).normal(size=(3, 16))
    y = embedding.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(embedding.hadamard(y), x)


def test_recall_at_the_threshold():
    """Pairs at cosine 0.9 exactly meet in some bucket."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(400, 64))
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    met = np.zeros(400, bool)
    for t in range(embedding.TABLES):
        a, b = embedding.probe_keys(x, t, 3), embedding.probe_keys(y, t, 3)
        met |= (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
    assert met.mean() > 0.99


def test_tables_grow_with_hashes_and_dimension():
    """Fresh pairs at cosine 0.9, wide and with three hashes a key: eight tables would miss about 1.4 %."""
    rng = np.random.default_rng(5)
    x, z = rng.normal(size=(2, 500, 1024))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    tables = embedding.table_count(1024, 3)
    met = np.zeros(500, bool)
    for t in range(tables):
        a, b = embedding.probe_keys(x, t, 3), embedding.probe_keys(y, t, 3)
        met |= (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
    assert tables > embedding.TABLES and met.all()
    assert embedding.table_count(64, 2) <= embedding.table_count(64, 4) < tables


def test_block_counts_equal_one_block(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=8)
    vectors = [(k, centre + 0.2 * rng.normal(size=8)) for k in range(90)]
    monkeypatch.setattr(embedding, "BLOCK", 16)
    check(spark, vectors)


def test_rows_of_one_id_and_many_stripes(spark, monkeypatch):
    """Different vectors under one id are one component; counts are exact however a component is cut."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3, 16))
    rows = [(100 + i, (base[i % 3] + 0.12 * rng.normal(size=16)).tolist()) for i in range(90)]
    rows += [(7, rows[0][1]), (7, rows[1][1]), (7, rows[1][1]), (8, None), (150, None), (9, (-base[0]).tolist())]
    monkeypatch.setattr(embedding, "STRIPE_BYTES", 8 * 16 * 10)
    monkeypatch.setattr(embedding, "BLOCK", 4)
    df = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(3)
    out = embedding.near_vectors(df).collect()
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None]
    edges = [(i, j) for a, (i, x) in enumerate(good) for j, y in good[a + 1:]
             if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9]
    links = [sum(x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9 for _, y in good) - 1 for _, x in good]
    comp = components({i for i, _ in rows}, edges)
    assert comp[100] == comp[101] == comp[7] == 7
    want = sorted([(i, n, comp[i]) for (i, _), n in zip(good, links)] + [(8, 0, 8), (150, 0, comp[150])])
    assert sorted((r["id"], r["links"], r["component"]) for r in out) == want

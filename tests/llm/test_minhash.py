from __future__ import annotations

import itertools

import numpy as np

from helpers import awkward, awkward_rows, components, empty, prose, shingle_set
from shopfloor.llm import minhash
from shopfloor.llm.common import Scratch
from shopfloor.llm.graph import connected_components
from shopfloor.llm.wordhash import shingles


def brute(rows, similarity=75):
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(r[0], shingle_set(r[1]))
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    return sets, components(sets, links)


def test_awkward_rows_match_brute_force(spark):
    out = minhash.near_duplicates(awkward(spark)).collect()
    sets, comp = brute(awkward_rows())
    assert len(out) == len(awkward_rows())
    for r in out:
        if r["id"] is None:
            assert r["component"] is None
        else:
            assert (r["n"], r["component"]) == (len(sets[r["id"]]), comp[r["id"]])


def test_empty_table(spark):
    assert minhash.near_duplicates(empty(spark)).collect() == []


def test_chain_and_star_leaves_are_linked(spark):
    """Leaves that the hub of their bucket does not reach, and chains, end in one component."""
    words = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(24):  # neighbours differ by a little, the ends by a lot
        rows.append((100 - k, " ".join(words[k * 3:] + [f"n{i}" for i in range(k * 3)]), "en", "s", 1))
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    _, comp = brute(rows)
    assert len(set(comp.values())) < len(rows)
    assert {r["id"]: r["component"] for r in out.collect()} == comp


def test_many_variants_of_one_text(spark):
    """A large group of near copies, some too far from all others: exact, by every kind of round."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for k in range(150):
        text = list(base)
        for at in rng.choice(60, rng.integers(0, 7), replace=False):
            text[at] = f"x{rng.integers(40)}"
        rows.append((1000 - k, " ".join(text), "en", "s", 1))
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    _, comp = brute(rows)
    assert {r["id"]: r["component"] for r in out.collect()} == comp


def test_densified_bins_come_from_filled_ones():
    sets = np.sort(np.random.default_rng(0).integers(0, 2**63, 3).astype(np.uint64))
    sig = minhash.signatures(sets, np.zeros(3, np.int64), 2, 128)
    assert set(sig[0].tolist()) == set(sets.tolist())
    assert not sig[1].any()


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 100).astype(np.uint64)
        y = np.concatenate([x[:86], rng.integers(0, 2**63, 14).astype(np.uint64)])
        pair = [np.sort(x), np.sort(y)]
        sig = minhash.signatures(np.concatenate(pair), np.repeat([0, 1], 100), 2, 128)
        agree.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(agree) - 86 / 114) < 0.03


def test_shingles_do_not_depend_on_the_block(monkeypatch):
    data = "Ein Satz\nmit  WÖRTERN und\tmehr Wörtern als zuvor hier ".encode() * 50
    raw, offsets = np.frombuffer(data, np.uint8), np.array([0, 10, len(data) // 2, len(data)])
    whole = shingles(raw, offsets, 5)
    monkeypatch.setattr("shopfloor.llm.wordhash.BLOCK", 64)
    cut = shingles(raw, offsets, 5)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200, 300)] + [(7, i) for i in range(8, 60)] + [(5, 5), (None, 3), (8, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    out = {r["node"]: r["component"] for r in connected_components(Scratch(spark, "t"), df).collect()}
    assert out == {i: 200 for i in range(200, 301)} | {i: 7 for i in range(7, 60)}


def test_rows_of_one_id_with_different_texts_are_one_component(spark):
    a, b, c = (prose(60 + i, 40) for i in range(3))
    rows = [(3, a), (5, a), (5, b), (9, b + " end"), (7, c), (7, ""), (11, c), (11, a + " x"), (12, None), (12, " "),
            (13, prose(90, 30)), (13, prose(91, 30)), (14, prose(91, 30)), (2, prose(92, 30)), (2, prose(93, 30)),
            (None, a), (None, b)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    links = [(i, j) for (i, x), (j, y) in itertools.combinations(sets, 2) if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    comp = components({i for i, _ in sets}, links)
    assert len(out) == len(rows) and comp[9] == 3 and comp[11] == 3
    assert all(r["component"] == (None if r["id"] is None else comp[r["id"]]) for r in out)

from __future__ import annotations

import math
import os
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from conftest import SF_SMALL
from pyspark.sql import functions as F

from helpers import SCHEMA, awkward, awkward_rows, empty, prose
from shopfloor.llm import classifier, langid, registry, sharding
from shopfloor.llm.common import Scratch, gapless_rank

DE, EN = "der und nicht die über straße hören schön", "the and with from this that have house"


def sentence(words: str, seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(words.split(" "), n))


def test_language_known_words_and_backoff():
    model = langid.fit([(sentence(DE, i, 30), "de") for i in range(20)] + [(sentence(EN, i, 30), "en") for i in range(20)])
    texts = ["Der hören über", "this house", "überhörenschön", "thathouse withthis", "12 34", "", "ÜBER", "\u0301 \u0308"]
    best, p, some = langid.score(model, texts)
    assert [model.langs[b] for b in best[:4]] == ["de", "en", "de", "en"]
    assert some.tolist() == [True, True, True, True, False, False, True, False]
    assert ((p >= 0) & (p <= 1)).all()
    alone = [langid.score(model, [t])[1][0] for t in texts]
    assert np.allclose(alone, p)


def plain_scores(rows, texts):
    """The definition with dictionaries: words, else the longest known n-gram at every place of the word."""
    def words(text):
        kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
        return kept.split()

    langs = sorted({g for _, g in rows})
    word = {g: Counter(w for t, h in rows if h == g for w in words(t)) for g in langs}
    gram = {n: {g: Counter(p[i:i + n] for t, h in rows if h == g for w in words(t) for p in [f"^{w}^"]
                           for i in range(len(p) - n + 1)) for g in langs} for n in (5, 4, 3, 2, 1)}

    def logs(counts, key):
        keys = len(set().union(*counts.values()))
        return [math.log((counts[g][key] + 0.5) / (sum(counts[g].values()) + 0.5 * keys)) for g in langs]

    out = []
    for text in texts:
        found = words(text)
        evidence = np.zeros(len(langs))
        for w in found:
            if any(word[g][w] for g in langs):
                evidence += logs(word, w)
                continue
            p, backed = f"^{w}^", np.zeros(len(langs))
            for i in range(len(p)):
                for n in (5, 4, 3, 2, 1):
                    if i + n <= len(p) and any(gram[n][g][p[i:i + n]] for g in langs):
                        backed += logs(gram[n], p[i:i + n])
                        break
            evidence += 2 * backed / len(p)
        odds = np.exp((evidence - evidence.max()) / math.sqrt(max(len(found), 1)))
        out.append((int(odds.argmax()), odds.max() / odds.sum()))
    return out


def test_language_scores_match_brute_force():
    rows = [(sentence(DE, i, 12), "de") for i in range(6)] + [(sentence(EN, i, 12), "en") for i in range(6)]
    rows += [("le chat est là, l\u2019été", "fr")]
    texts = ["Der hören über", "this house", "überhörenschön", "thathouse withthis chats", "x", "été 12 was-not!", "ÜBER\nand",
             sentence(DE + " " + EN, 5, 400), "lä̀ chatte", "zzz qqq", "a" * 100]
    best, p, _ = langid.score(langid.fit(rows), texts)
    for (b, q), c, r in zip(plain_scores(rows, texts), best, p):
        assert r == pytest.approx(q, rel=1e-3) and (b == c or r < 0.51)


def test_a_rare_language_is_learned(spark):
    """One row in 4,000, among many copies and null ids, with small bounds."""
    rows = [(i if i % 3 else None, sentence(EN, i % 1500, 20), "en") for i in range(4000)]
    rows += [(9001, sentence(DE, 1, 60), "de"), (9002, "x " * 5000, "de"), (9003, None, "de"), (9004, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.train(docs, F.lit(True), fit_rows=50, fit_bytes=6000)
    assert model.langs == ["de", "en"]
    best, p, _ = langid.score(model, ["die straße hören", "the house with"])
    assert [model.langs[b] for b in best] == ["de", "en"]
    again = langid.train(docs.repartition(2), F.lit(True), fit_rows=50, fit_bytes=6000)
    assert (model.word_keys == again.word_keys).all() and (model.word_logs == again.word_logs).all()
    small = langid.fit([(r[1], r[2]) for r in rows[:500] + rows[4000:4001]], max_words=3, max_grams=10)
    assert len(small.word_keys) == 6  # three words of each language


def test_language_of_awkward_rows(spark):
    model = langid.fit([(sentence(DE, 1, 50), "de"), (sentence(EN, 1, 50), "en")])
    out = langid.identify(awkward(spark), model).collect()
    assert len(out) == len(awkward_rows())
    for r in out:
        assert r["lang_pred"] in ("de", "en", "und") and 0 <= r["score"] <= 1
        if r["id"] in (6, 7, 8, 32):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert langid.identify(empty(spark), model).collect() == []
    nothing = langid.fit([])
    assert {r["lang_pred"] for r in langid.identify(awkward(spark), nothing).collect()} == {"und"}
    kept = langid.keep_identified(awkward(spark), model).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(r["id"] for r in out if r["lang_pred"] != "und")


def test_long_words_are_hashed_one_by_one():
    model = langid.fit([("x" * 5000 + " der", "de"), ("the " + "y" * 5000, "en")])
    assert model.langs[langid.score(model, ["y" * 5000])[0][0]] == "en"


@pytest.mark.skipif(not os.path.exists(SF_SMALL.replace("0.001", "0.01")), reason="needs the test tables")
def test_held_out_accuracy(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = registry.queries()["op8_language_id"](spark, sf).collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = registry.queries()["op6_quality_classifier"](spark, sf).collect()
    held = [r for r in out if r["held_out"] and r["doc_id"] in label]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.93


def bytes_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def test_classifier_score_is_of_the_whole_text_alone():
    model = classifier.fit([(prose(i, 50), 1) for i in range(30)] + [("#$ " * 60, 0)] * 30, steps=60)
    texts = [prose(99, 3000), "", "a", "x" * 251, "x" * 252, "x" * 253, prose(98, 40) + " " + "#$ " * 900, "é" * 300]
    together = classifier.predict(model, *bytes_of(texts))
    alone = np.concatenate([classifier.predict(model, *bytes_of([t])) for t in texts])
    assert np.allclose(together, alone, atol=1e-6)
    assert together[0] > 0.5 and together[6] < together[0]  # junk far behind the start counts
    assert ((together >= 0) & (together <= 1)).all()


def test_gradients_match_differences():
    model = classifier.initial(3)
    model = {k: v.astype(np.float64) for k, v in model.items()}
    model["out"] = np.random.default_rng(0).normal(size=model["out"].shape)
    texts, y = ["hello world " * 60, "#### bad", "ok"], np.array([1.0, 0.0, 1.0])
    symbols, first = classifier.layout(*bytes_of(texts))

    def loss(m):
        _, r = classifier.chunk_responses(m, symbols, first)
        p = classifier.probability(m, classifier.features(r.max(axis=1), first))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g = classifier.gradients(model, symbols, first, y)
    rng = np.random.default_rng(1)
    for name in model:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in model[name].shape) if name != "embed" else (
                ord("o") + 1, int(rng.integers(0, classifier.DEPTH)))
            moved = {k: v.copy() for k, v in model.items()}
            moved[name][at] += 1e-6
            assert (loss(moved) - loss(model)) / 1e-6 == pytest.approx(g[name][at], abs=1e-4)


def test_classifier_awkward_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (32, 0, 0), (32, 1, 0), (None, 1, 0), (999, 1, 0), (2, None, 0)],
                                   "doc_id long, quality int, id int")
    model = classifier.train(awkward(spark), labels)
    out = classifier.classify(awkward(spark), model).collect()
    assert len(out) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert classifier.classify(empty(spark), model).collect() == []
    blank = classifier.train(empty(spark), labels.limit(0))
    assert {r["score"] for r in classifier.classify(awkward(spark), blank).collect()} == {0.5}


def check_shards(out, rows, shards=8):
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, load = defaultdict(list), Counter()
    for r in out:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
    return load


def test_sharding_keeps_copies_together_and_sizes_even(spark):
    rows = [(i, prose(i, 20 + i % 30)) for i in range(900)]
    rows += [(2000 + i, prose(5000 + i % 60, 25)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard_documents(df.repartition(3)).collect()
    load = check_shards(out, rows)
    assert max(load.values()) < 1.02 * sum(load.values()) / 8 and min(load.values()) > 0.98 * sum(load.values()) / 8
    where = defaultdict(set)
    text = dict(rows)
    for r in out:
        where[text[r["id"]]].add(r["shard"])
    assert max(map(len, where.values())) == 1
    again = sharding.shard_documents(df.repartition(2)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_sharding_splits_a_group_that_exceeds_shards(spark):
    rows = [(i, "the same text over and over") for i in range(1500)] + [(5000 + i, prose(i, 4)) for i in range(1200)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    load = check_shards(out, rows)
    assert max(load.values()) < 1.05 * sum(load.values()) / 8
    held = Counter(r["shard"] for r in out if r["id"] < 5000)
    assert len(held) < 8  # filled shard by shard, not spread evenly


def split_groups(out, rows):
    """Shards and rows of every text that several rows hold, and the bytes of every shard."""
    text, where = dict(rows), defaultdict(Counter)
    for r in out:
        where[text[r["id"]]][r["shard"]] += 1
    return {t: (len(c), sum(c.values())) for t, c in where.items() if sum(c.values()) > 1}, check_shards(out, rows)


@pytest.mark.parametrize("hot", [0, 1000])
def test_sharding_cuts_no_pair_and_spreads_a_hot_group_over_few_shards(spark, hot):
    rows = [(i, f"pair {i // 2:06d}") for i in range(1600)] + [(10000 + i, f"lone {i:06d}") for i in range(400)]
    rows += [(20000 + i, "hot  000000") for i in range(hot)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    groups, load = split_groups(out, rows)
    assert {n for n, size in groups.values() if size == 2} == {1}
    assert max(load.values()) < 1.02 * sum(load.values()) / 8 and min(load.values()) > 0.98 * sum(load.values()) / 8
    if hot:
        assert groups["hot  000000"] == (3, hot)  # 2.7 shards


def test_admission_exchanges_between_full_shards():
    swap = np.array([[0.0, 40], [40, 0]])
    assert (sharding.admitted_shares(swap, np.zeros(2))[swap > 0] == 1).all()  # without room, what leaves is room
    wanted = np.array([[0.0, 40, 0], [40, 0, 10], [0, 30, 0]])
    share = sharding.admitted_shares(wanted, np.zeros(3))
    flow = share * wanted
    assert (flow.sum(axis=0) <= flow.sum(axis=1) + 1e-6).all() and flow[0, 1] > 0
    assert (sharding.admitted_shares(wanted, np.full(3, 99.0))[wanted > 0] == 1).all()


def test_propagation_joins_copies_without_room_or_lone_texts(spark):
    """99 % of the bytes are linked: every shard starts nearly full."""
    rows = [(i, f"copy {i // 5:06d}") for i in range(3500)] + [(10000 + i, f"lone {i:06d}") for i in range(35)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    groups, load = split_groups(out, rows)
    assert {n for n, _ in groups.values()} == {1}
    assert max(load.values()) < 1.02 * sum(load.values()) / 8 and min(load.values()) > 0.98 * sum(load.values()) / 8


def test_sharding_awkward_and_empty(spark):
    out = sharding.shard_documents(awkward(spark)).collect()
    check_shards(out, [(r[0], r[1]) for r in awkward_rows()])
    assert sharding.shard_documents(empty(spark)).collect() == []


def test_gapless_rank_with_a_hot_null_group_and_ties(spark):
    scratch = Scratch(spark, "t")
    df = scratch.save(spark.createDataFrame([(None, 1)] * 200 + [("a", i) for i in range(50)] + [("b", 1)],
                                            "g string, x long").repartition(4), "in")
    seen = defaultdict(list)
    for r in gapless_rank(scratch, df, "g", ["x"], "no").collect():
        seen[r["g"]].append(r["no"])
    assert {g: sorted(v) == list(range(len(v))) for g, v in seen.items()} == {None: True, "a": True, "b": True}


@pytest.mark.parametrize("make", [awkward, empty])
def test_every_stage_takes_awkward_and_empty_documents(spark, make):
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    for name, stage in corpus_pipeline.STAGES:
        docs = make(spark)
        out = stage(spark, docs, SF_SMALL)
        if name != "packing":
            assert out.columns == docs.columns
            rows = [tuple(r[c] for c in names) for r in out.collect()]
            assert set(rows) <= set(awkward_rows())
            if name != "mixture":
                assert not Counter(rows) - Counter(awkward_rows())
        else:
            out.collect()


def test_near_duplicates_judges_rows_not_ids(spark):
    a, b, c, d = (prose(700 + i, 40) for i in range(4))
    rows = [(3, a, "en", "x", 1), (5, a, "en", "x", 1), (5, b, "en", "x", 1),  # one id, a copy and a unique text
            (7, c, "en", "x", 1), (7, d, "en", "y", 1), (9, d, "en", "x", 1),
            (None, a, "en", "x", 1), (None, prose(800, 40), "en", "x", 1), (None, prose(800, 40) + " end", "en", "x", 1),
            (8, None, "en", "x", 0), (8, "", "en", "x", 0)]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()
    kept = Counter((r["doc_id"], r["text"]) for r in out)
    loose = {k for k in kept if k[0] is None}
    assert len(loose) == 1 and loose.pop()[1].startswith(prose(800, 40))
    assert {k: n for k, n in kept.items() if k[0] is not None} == {
        (3, a): 1, (5, b): 1, (7, c): 1, (7, d): 1, (8, None): 1, (8, ""): 1}


def test_mixture_takes_whole_rows_near_the_target(spark, tmp_path):
    """Rows of one id with different texts, many null ids and one repeated row: exact totals, from files and from memory."""
    rows = [(1, "a b c", "en", "x", 1)] * 3 + [(1, "d e f g h i j", "en", "x", 1), (2, "d e f g", "en", "x", 1)]
    rows += [(None, f"w{i} " * (1 + i % 5), "en", "x", i) for i in range(100)] + [(None, "k l", "en", None, 1)] * 60
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs.write.parquet(str(tmp_path / "docs"))
    words = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in ("x", None)}
    total = 1.5 * sum(words.values())
    aims = {"x": min(2 * words["x"], total * 5 / 7), None: min(2 * words[None], total * 2 / 7)}
    aims = {s: min(2 * words[s], total - aims[o] if aims[o] == 2 * words[o] else a) for (s, a), o in zip(aims.items(), (None, "x"))}
    for given in (docs, spark.read.parquet(str(tmp_path / "docs"))):
        out = corpus_pipeline.mixture(spark, given, "").collect()
        taken = Counter(r["source"] for r in out for _ in r["text"].split())
        assert all(abs(taken[s] - aims[s]) <= 3.5 for s in aims), (taken, aims)
        times = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in out)
        assert all(n <= 2 * rows.count((*k[:2], "en", s, k[2])) for k, n in times.items()
                   for s in ["x" if k[1] != "k l" else None])


def test_places_come_from_files_without_a_copy(spark, tmp_path):
    from shopfloor.llm.places import Places
    df = spark.range(100_000).withColumn("file", F.lit("clash")).withColumn("_metadata", F.lit(1))
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    for docs in (read, read.select("id", "file").where("id > 5")):
        places = Places(Scratch(spark, "t"), docs)
        assert not places.needed and places.docs is docs
        wanted = places.narrow(F.col("id")).where("id % 3 = 0 OR id = 99999")
        assert sorted(r["id"] for r in places.keep(wanted).collect()) == sorted(
            r["id"] for r in docs.collect() if r["id"] % 3 == 0 or r["id"] == 99999)
        assert {r["i"] - r["id"] for r in places.attach(wanted, F.col("id").alias("i")).collect()} == {0}
        twice = places.repeat(places.narrow(F.col("id")).selectExpr("file", "row", "id % 3 AS times"), 2).groupBy("id").count()
        assert {r["id"] % 3 - r["count"] for r in twice.collect()} == {0}
    doubled = read.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))
    assert Places(Scratch(spark, "t"), doubled).needed  # a place would name two rows
    assert Places(Scratch(spark, "t"), spark.range(5)).needed


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="needs the test tables")
def test_pipeline_end_to_end(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    ids = {r["doc_id"] for r in rows}
    assert ids and ids <= set(docs)
    starts = defaultdict(Counter)
    for r in rows:
        starts[r["doc_id"]][r["start"]] += 1
    assert all(len(set(c.values())) == 1 for c in starts.values())  # whole copies of every document

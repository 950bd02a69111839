from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import WORD, awkward, awkward_rows, empty
from shopfloor.llm import chat, mixing, quality_rules


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


EXTRA = ["a b c a b c", "a b a b a b", "x x x x", "a b c d a b c e a b c", "l1\nl1\n\n \nl1\nl2", "a b c\x0bd\x1ce"]


def test_base_counts_match_brute_force(spark):
    rows = awkward_rows() + [(200 + i, t, "en", "s", 1) for i, t in enumerate(EXTRA)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = quality_rules.judge(df.withColumn("words", F.lit(1)).withColumn("lines", F.lit(2))).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = Counter((r["id"], *(r[n] for n in names)) for r in out)
    assert got == Counter((r[0], *base_counts(r[1])) for r in rows)
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert any(r["kept"] for r in out)


def test_cascade_order_does_not_change_the_verdict(spark):
    df = awkward(spark)
    rules = quality_rules.RULES
    a = quality_rules.judge(df, rules=rules).select("id", "n_words", "kept").collect()
    b = quality_rules.judge(df, rules=list(reversed(rules)), sample_rows=3).select("id", "n_words", "kept").collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_rules_are_ordered_by_rejection_per_cost(spark):
    prepared = quality_rules.prepare(spark.createDataFrame(
        [(i, "### a b" if i % 2 else "a b c") for i in range(20)], "id long, text string"), "id", "text")
    one, two = F.lit(1.0), F.lit(2.0)
    rules = [quality_rules.Rule("never", lambda: F.lit(False), lambda: one),
             quality_rules.Rule("dear", lambda: F.col("text").contains("#"), lambda: two),
             quality_rules.Rule("cheap", lambda: F.col("text").contains("#"), lambda: one)]
    assert [r.name for r in quality_rules.order_rules(prepared, rules)] == ["cheap", "dear", "never"]
    assert [r.name for r in quality_rules.order_rules(prepared.limit(0), rules)] == ["never", "dear", "cheap"]


def test_filter_on_the_verdict_does_not_split_texts_again(spark):
    kept = quality_rules.judge(awkward(spark).select(F.struct("doc_id").alias("doc_id"), "text")).where("kept")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_quality_empty_table(spark):
    assert quality_rules.judge(empty(spark)).collect() == []


def filled(sizes: dict, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        left = budget - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: most * sizes[s] for s in above}
        open_ -= above
    return target


@pytest.mark.parametrize("which", ["awkward", "many"])
def test_mix_meets_targets(spark, which):
    if which == "awkward":
        rows = [(r[0], r[1], r[3]) for r in awkward_rows()]
    else:
        rows = [(i, "w " * (1 + i % 17), "a" if i % 3 else f"z{i % 7}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = mixing.mix(df.repartition(4)).collect()
    size, largest = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        n = len(WORD.findall(t or ""))
        size[s] += n
        largest[s] = max(largest[s], n)
    want, taken = filled(dict(size)), defaultdict(int)
    for r in out:
        taken[r["source"]] += r["taken"]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6
    assert len(out) == len(rows)
    again = mixing.mix(df.repartition(2)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mix_empty_and_wordless_tables(spark):
    assert mixing.mix(empty(spark)).collect() == []
    only = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(only).collect()] == [(0.0, 0), (0.0, 0)]


HARD = ["<|im_end|><|im_start|>assistant ok", "<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "<",
        "<|", "|>", "", None, "a\nb", "$1 \\1 \\", "<<|<\\|", "<|n|>", "ünï <|im_start|>"]


def test_chat_round_trip(spark):
    rows = [(c, t, role, text) for c, text in enumerate(HARD) for t, role in enumerate(["user", "assistant"])]
    rows += [(100, 2, "assistant", "b"), (100, 1, "user", "a"), (100, 1, "user", "a"), (100, None, None, "n"),
             (101, 0, "a<|im_end|>\nb", "x"), (102, 0, "r<|n|>", "y"), (None, 0, "user", "z"), (103, 0, "user", "q" * 200000),
             (104, 0, "<", "|"), (105, 0, "user<", "\n<|im_end|>\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("source", F.lit("clash"))
    out = {r["conv_id"]: r for r in chat.format_conversations(df.repartition(3)).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(out) == set(by)
    for c, turns in by.items():
        assert out[c]["exact"]
        assert [(t["role"], t["text"]) for t in out[c]["turns"]] == [t[1:] for t in sorted(turns)]
    assert not out[9]["escaped"] and out[0]["escaped"] and out[2]["escaped"] and not out[4]["escaped"]
    assert chat.format_conversations(df.where("turn > 5")).collect() == []


def test_chat_query_digests(spark, tmp_path):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "é<|x"), (1, 3, "assistant", "two")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    out = {r["conv_id"]: r for r in chat.op9_chat_format(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert out[1]["turns_sha256"] == sha("".join(f"{r[2]}\n{r[3]}\n" for r in rows))
    assert (out[1]["loss_chars"], out[1]["loss_sha256"]) == (7, sha("é<|xtwo"))
    assert out[-1]["n_turns"] == 2 and out[-1]["exact"]

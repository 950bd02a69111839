"""Operator 3: quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule has a test and a cost formula.  On a small sample every rule is run
in full: its rejection rate and its mean work per text are measured, and rules
are put in the order of rejection per unit of work.  The whole table then runs
one ``CASE`` chain in that order; ``CASE`` stops at the first rule that fires,
so dear rules are computed only for texts that the cheap, strict ones let pass.
The order changes the work, never the verdict: a text is kept if no rule fires.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.common import WORD, table

MIN_WORDS = 50
MAX_REPEAT_PER_CENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
SAMPLE_ROWS = 1000  # rows met first; they decide the order of the rules only


@dataclass(frozen=True)
class Rule:
    """``fails`` and ``cost`` (characters or items touched) as expressions over text, words and lines."""

    name: str
    fails: Callable[[], Column]
    cost: Callable[[], Column]


def _total(items: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda acc, x: acc + value(x))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``, also inside inner lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_chars() -> Column:
    return F.char_length(F.translate("text", SPACES, "")).cast("long")


def n_words() -> Column:
    return F.size("words").cast("long")


def n_symbols() -> Column:
    return (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long")


def n_dup_lines() -> Column:
    return (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")


def n_repeat_words() -> Column:
    """Words inside 3-word windows that the text has twice or more.

    Window hashes (64 bits within one text) without a repeat end the work;
    otherwise (hash, place) pairs are sorted, places with an equal neighbour
    are windows found again, and each covers three words up to the next one.
    """
    hashes = F.slice(F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))),
                     F.lit(1), F.greatest(F.size("words") - 2, F.lit(0)))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = _let(pairs, lambda p: F.sort_array(F.transform(
            F.filter(p, lambda e, i: (e["h"] == F.get(p, i - 1)["h"]) | (e["h"] == F.get(p, i + 1)["h"])),
            lambda e: e["i"])))
        spans = _let(again, lambda p: F.transform(
            p, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - at, F.lit(3)))))
        return _total(spans, lambda x: x.cast("long"))

    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(covered(h)))


def _ratio(part: Column, whole: Column, limit: float) -> Column:
    return part > F.lit(limit) * whole


def _count(pattern: str) -> Column:
    return F.char_length("text") - F.char_length(F.regexp_replace("text", pattern, ""))


CHARS = lambda: F.char_length("text").cast("double")

#: The verdict's rules; all limits are generous, so that plain prose of any language passes.
RULES = [
    Rule("symbols", lambda: _ratio(n_symbols(), n_words(), 0.1), lambda: CHARS()),
    Rule("word_length", lambda: (word_chars() < 2 * n_words()) | (word_chars() > 15 * n_words()), lambda: CHARS()),
    Rule("capitals", lambda: _ratio(_count("[A-Z]"), word_chars(), 0.3), lambda: 3 * CHARS()),
    Rule("digits", lambda: _ratio(_count("[0-9]"), word_chars(), 0.3), lambda: 3 * CHARS()),
    Rule("exclamations", lambda: _ratio(_count("[!?]"), n_words(), 0.5), lambda: 3 * CHARS()),
    Rule("repeated_lines", lambda: _ratio(2 * n_dup_lines(), F.size("lines"), 1.0), lambda: 4.0 * F.size("lines")),
    Rule("repeated_words", lambda: _ratio(n_repeat_words(), n_words(), MAX_REPEAT_PER_CENT / 100.0),
         lambda: 20.0 * F.size("words")),
]


def prepare(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, words, lines`` (lines with a word); a null text is an empty one.

    The arrays come out of a generator of one row: neither a filter nor a
    projection above can then be rewritten to split the text again per word.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    parts = F.struct(
        F.col("text"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", F.inline(F.array(parts)))


def order_rules(prepared: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per cost on the first ``sample_rows`` rows; ties and an empty sample keep the given order."""
    seen = prepared.select(*[F.struct(r.fails().alias("f"), r.cost().alias("c")).alias(f"r{i}")
                             for i, r in enumerate(rules)]).take(sample_rows)
    value = {}
    for i, rule in enumerate(rules):
        rejected = sum(1 for row in seen if row[i]["f"])
        work = sum(row[i]["c"] or 0.0 for row in seen)
        value[rule.name] = rejected / work if work else 0.0
    return sorted(rules, key=lambda r: -value[r.name])


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that fires, or null."""
    chain = None
    for r in rules:
        chain = (F if chain is None else chain).when(r.fails(), F.lit(r.name))
    return chain


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    A null or wordless text has no words and fails the base test.  Rows with a
    null or repeated id are judged one by one; other columns are not read; an
    empty table gives an empty result.
    """
    prepared = prepare(docs, id_col, text_col)
    ordered = order_rules(prepared, rules or RULES, sample_rows)
    base = prepared.select(
        "id", "text", "words", "lines", n_words().alias("n_words"), word_chars().alias("word_chars"),
        n_symbols().alias("n_symbols"), n_dup_lines().alias("n_dup_lines"), n_repeat_words().alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PER_CENT * F.col("n_words"))
    known = [r for r in ordered if r.name != "repeated_words"] if rules is None else ordered  # part of the base
    return base.withColumn("base_failed", failed).select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(known).isNull()).alias("kept"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")

"""Small documents with every awkward case, and plain Python versions of the definitions."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgéü") for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    base = prose(1, 80)
    words = base.split(" ")
    near = " ".join(words[:40] + ["changed"] + words[41:])
    far = " ".join(words[:40] + prose(9, 40).split(" "))
    rows = [(i, prose(100 + i, 20 + 7 * i), "en", f"s{i % 3}", 1) for i in range(10, 22)]
    return rows + [
        (1, base, "en", "s0", 1), (2, base, "en", "s1", 1), (3, near, "en", "s0", 1), (4, far, "en", "s0", 1),
        (5, base.upper().replace("É", "é").replace("Ü", "ü"), "en", None, None),
        (6, None, "en", "s1", 0), (7, "", None, "s2", 0), (8, " \t\n ", "en", "s2", 3), (9, "one two", "en", None, 7),
        (30, "one two", "en", "s1", 7), (31, "one two three", "en", "s1", 7), (32, "###", "en", "s1", 3),
        (40, prose(5, 6000), "en", "s0", 1), (41, prose(5, 6000) + " end", "en", "s2", 1),
        (50, near, "en", "s0", 1), (50, near, "en", "s0", 1),  # a repeated row
        (None, base, "en", "s0", 1), (None, None, None, None, None),
        (60, "x" * 5000, "en", "s0", 1), (61, "a\nb\n\na\n b\tb\r\nc  d", "en", "s0", 1),
        (62, "日本語 テキスト です　と  nbsp <|endoftext|> don't", "en", "s0", 1),
    ]


def awkward(spark):
    """The rows with extra columns whose names clash with those that operators use inside."""
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    for name in ("id", "size", "n", "words", "lines", "component", "rep", "key", "slice", "draw", "start", "length",
                 "group", "shard", "row", "u", "source_size", "number", "label"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def components(nodes, links) -> dict:
    parent = {x: x for x in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in nodes}

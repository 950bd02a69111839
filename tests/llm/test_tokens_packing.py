from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import awkward, awkward_rows, empty, prose
from shopfloor.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
MERGER, ENCODER = tokens.Merger(PATH), packing.Encoder(PATH)

TEXTS = ["", " ", "  a b", "a  b c", "x ", "a\n\nb", "a \n b", "\ta b", "a b　c d", "don't we'll I'M it's", "'s 's",
         "<|endoftext|>a <|endoftext|>\n", "日本語 テスト 123 45a", "\x1c a \x85b c", "a\r\nb", "👩‍👩‍👧 ok", "ab" * 900, "1 2 3", "\x00 \x01",
         " \n \n", "a\n", "\na", "é è́ ß", "a b c"]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_counts_and_ids_equal_the_library(text):
    assert MERGER.count(text) == len(library_ids(text))
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library_ids(text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab éz \n\t'sS1９ $|<> ́日"), max_size=40))
def test_counts_and_ids_equal_the_library_on_any_text(text):
    assert MERGER.count(text) == len(library_ids(text))
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library_ids(text)


def test_small_caches_give_the_same():
    m = tokens.Merger(PATH)
    m.one._limit = m.lead._limit = m.bare._limit = 5
    text = prose(3, 300)
    assert m.count(text) == len(library_ids(text))
    assert len(m.lead) <= 5


def test_count_tokens_on_awkward_rows(spark):
    out = sorted((str(r["id"]), r["n_bytes"], r["n_tokens"], r["over_limit"])
                 for r in tokens.count_tokens(awkward(spark)).collect())
    want = []
    for r in awkward_rows():
        n = len(library_ids(r[1] or ""))
        want.append((str(r[0]), len((r[1] or "").encode()), n, n > 512))
    assert out == sorted(want)
    assert tokens.count_tokens(empty(spark)).collect() == []


def check_packing(rows, docs):
    """Every id lies in exactly one piece, sequences are gapless and short enough, step groups even."""
    ids = defaultdict(list)
    for doc_id, text in docs:
        ids[doc_id].append(library_ids(text or "") + [1])
    total = sum(len(x) for v in ids.values() for x in v)
    assert sum(r["length"] for r in rows) == total
    sequences = defaultdict(list)
    for r in rows:
        part = [x[r["start"]:r["start"] + r["length"]] for x in ids[r["id"]] if len(x) == r["doc_tokens"]]
        assert r["ids_crc32"] in {zlib.crc32(np.array(p, "<u4").tobytes()) for p in part}
        sequences[r["sequence_id"]].append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    groups = defaultdict(lambda: defaultdict(int))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= pieces[0]["tier"] and len({(r["tier"], r["step_group"]) for r in pieces}) == 1
        groups[pieces[0]["tier"]][pieces[0]["step_group"]] += 1
        if at & (at - 1):
            padding += 2048 - at
    return sequences, groups, padding, total


def test_pack_awkward_rows(spark):
    rows = packing.pack(awkward(spark)).collect()
    check_packing(rows, [(r[0], r[1]) for r in awkward_rows()])
    assert packing.pack(empty(spark)).collect() == []


def test_pack_has_little_padding_and_even_groups(spark):
    rng = np.random.default_rng(0)
    docs = [(i, prose(i, int(n))) for i, n in enumerate(rng.lognormal(4, 1.2, 600))]
    docs += [(1000 + i, prose(7, 100)) for i in range(300)]  # a third of the rows have one length
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.pack(df.repartition(3), step_tokens=8192).collect()
    _, groups, padding, total = check_packing(rows, docs)
    assert padding < 0.02 * total
    n = max(max(g) for g in groups.values()) + 1
    for tier in groups.values():
        assert max(tier.values()) - min(tier.get(k, 0) for k in range(n)) <= 1
    again = packing.pack(df.repartition(2), step_tokens=8192).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_pack_keeps_ids_on_request(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    got = {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.pack(df, with_ids=True).collect()}
    assert got == {1: library_ids("one two three") + [1], 2: [1]}


@given(st.dictionaries(st.integers(1, 2048), st.integers(1, 50), max_size=40))
def test_plan_uses_every_piece_once(counts):
    used = defaultdict(int)
    for made, size, times in packing.plan(dict(counts)):
        assert times > 0 and sum(made) <= size
        for n in made:
            used[n] += times
    assert dict(used) == counts

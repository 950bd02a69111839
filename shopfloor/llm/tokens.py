"""Operator 5: token counts by byte-pair merging with a heap and a linked list.

The vocabulary file of a public byte-level tokenizer (a path, never copied)
gives the merge ranks.  A pre-token's bytes form a doubly linked list; adjacent
pairs with a rank wait in a heap.  The lowest-ranked pair is popped again and
again: a stale entry is skipped, a live one merges its two nodes and pushes the
pairs with the new neighbours.  The count is the number of initial symbols
minus the number of merges; no identifiers are produced.

Texts are cut at single spaces and line feeds, where the tokenizer's own
pattern always starts a new pre-token, and the counts of pieces are remembered
in a cache with a fixed number of entries.  Texts in which such a cut is not
safe (other or repeated white space around it) are matched as a whole.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from shopfloor.llm.common import table, whole_texts

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CACHE = 400_000
# Fixed value: the published pre-token pattern of byte-level tokenizers.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_UNSAFE = -(1 << 40)


def byte_symbols() -> list[str]:
    """The vocabulary's character for each byte: printable Latin-1 stays, the others follow from 256 on."""
    stays = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(stays)]
    out = {b: chr(b) for b in stays} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [out[b] for b in range(256)]


class PieceCache(dict):
    """A dictionary that computes what is missing and holds at most two generations of ``limit`` entries."""

    def __init__(self, make, limit: int = CACHE):
        super().__init__()
        self._make, self._limit, self._old = make, limit, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


class Merger:
    """Counts tokens as the vocabulary file's library does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.first = [vocab[c] for c in byte_symbols()]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        self.added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.cut = regex.compile("|".join(regex.escape(t) for t in self.added)) if self.added else None
        self.pretokens = regex.compile(PATTERN).findall
        self.one = PieceCache(self.merge)
        self.lead = PieceCache(lambda piece: self.piece(" " + piece, piece))
        self.bare = PieceCache(lambda piece: self.piece(piece, piece))

    def merge(self, pretoken: str) -> int:
        """Tokens of one pre-token."""
        symbols = [self.first[b] for b in pretoken.encode("utf-8", "surrogatepass")]
        n = len(symbols)
        rank = self.rank
        heap = []
        for i in range(n - 1):
            found = rank.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if symbols[i] == a else n
            if j >= n or symbols[j] != b:
                continue  # one of its nodes has merged since
            merges += 1
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = rank.get((new, symbols[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, new, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = rank.get((symbols[h], new))
                if found:
                    heapq.heappush(heap, (found[0], h, symbols[h], new, found[1]))
        return n - merges

    def piece(self, text: str, piece: str) -> int:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return _UNSAFE
        return sum(map(self.one.__getitem__, self.pretokens(text)))

    def plain(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        total = 0
        lines = text.split("\n")
        for line in lines:
            head, *rest = line.split(" ")
            total += self.bare[head] + sum(map(self.lead.__getitem__, rest))
        if total < 0:
            return sum(map(self.one.__getitem__, self.pretokens(text)))
        return total + (len(lines) - 1) * self.one["\n"]

    def count(self, text: str) -> int:
        """Tokens of a text; the strings of added tokens are one token each, as the library has it."""
        if not text:
            return 0
        if self.cut is None or not any(t in text for t in self.added):
            return self.plain(text)
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(self.plain(p) for p in parts if p)


@lru_cache(maxsize=4)
def merger(path: str) -> Merger:
    return Merger(path)


def _counter(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            n = pa.array([m.count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"])
    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for every row.

    A null or empty text has no bytes and no tokens.  Null and repeated ids are
    counted row by row; other columns are not read; an empty table gives an
    empty result.  ``tokenizer`` is the path of the vocabulary file.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    return whole_texts(docs, id_col, text_col).mapInArrow(
        _counter(str(path), limit),
        f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")

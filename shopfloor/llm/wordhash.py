"""Vectorised word and shingle hashes of whole texts (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

U = np.uint64
BLOCK = 1 << 20  # bytes hashed at once; a block ends between words


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(256, dtype=U) * U(0xD1342543DE82EF95) + U(0x632BE59BD9B4E019))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUE = _BYTE[LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the base (``up``) or of its inverse modulo 2**64 (``down``)."""
    if len(_powers[kind]) < n:
        b = BASE if kind == "up" else pow(BASE, -1, 1 << 64)
        steps = np.full(max(n, BLOCK), b, U)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word, A-Z lower-cased; documents end words."""
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    in_word = ~_SPACE[data]
    starts = in_word.copy()
    starts[1:] &= ~in_word[:-1]
    starts[inner] |= in_word[inner]
    ends = in_word.copy()
    ends[:-1] &= ~in_word[1:]
    ends[inner - 1] |= in_word[inner - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    out = np.empty(len(s), U)
    at = 0
    while at < len(s):
        stop = max(int(np.searchsorted(e, s[at] + BLOCK, side="right")), at + 1)
        a, b = s[at], e[stop - 1]
        sums = np.cumsum(_VALUE[data[a:b]] * _power("up", b - a))
        lo, hi = s[at:stop] - a, e[at:stop] - a
        part = sums[hi - 1] - np.where(lo > 0, sums[lo - 1], U(0))
        out[at:stop] = part * _power("down", b - a)[lo] + (hi - lo).astype(U)
        at = stop
    return mix(out), np.searchsorted(offsets, s, side="right") - 1


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each document, and their documents.

    A document with fewer words than ``size`` has its whole sequence as one
    shingle; one without words has none.
    """
    h, doc = words(data, offsets)
    n_docs = len(offsets) - 1
    if not len(h):
        return h, doc
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(count)])
    rolled = np.zeros(len(h), U)
    for k in range(size):
        m = len(h) - k
        if m > 0:
            rolled[:m] += h[k:] * U((BASE * (2 * k + 3) ** 5 | 1) % (1 << 64))
    left = first[doc + 1] - np.arange(len(h))
    whole = mix(rolled[left >= size] + U(size))
    whole_doc = doc[left >= size]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        lone = np.array([_sequence(h[first[d]:first[d + 1]]) for d in short], U)
        whole, whole_doc = np.concatenate([whole, lone]), np.concatenate([whole_doc, short])
        order = np.argsort(whole_doc, kind="stable")
        whole, whole_doc = whole[order], whole_doc[order]
    bounds = np.searchsorted(whole_doc, np.arange(n_docs + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            whole[a:b].sort()
    keep = np.ones(len(whole), bool)
    keep[1:] = (whole[1:] != whole[:-1]) | (whole_doc[1:] != whole_doc[:-1])
    return whole[keep], whole_doc[keep]


def _sequence(h: np.ndarray) -> int:
    total = sum(int(x) * ((BASE * (2 * k + 3) ** 5 | 1)) for k, x in enumerate(h)) + len(h)
    return int(mix(np.array([total % (1 << 64)], U))[0])

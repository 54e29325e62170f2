"""Tokens and three-word runs of texts, hashed a batch at a time with numpy.

A *run* is three consecutive tokens; a text of one or two tokens is a single run. Runs become
64-bit hashes: the hash of a token is looked up once per distinct token and worker, and the three
are mixed with vector arithmetic, so no run is ever built as a string.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import xxhash

#: Token characters: word characters and the whole Devanagari block, danda included.
TOKEN = re.compile("[\\wऀ-ॿ]+")
_MEMO_LIMIT = 1_000_000
_memo: dict[str, int] = {}
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def _hash(token: str) -> int:
    if len(_memo) >= _MEMO_LIMIT:
        _memo.clear()
    h = _memo[token] = xxhash.xxh64_intdigest(token)
    return h


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * _A
    h = h ^ (h >> np.uint64(29))
    h = h * _B
    return h ^ (h >> np.uint64(32))


def run_sets(texts: Sequence[str], width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of every text: ``(owner, run)``, sorted by owner, then by run.

    A text without tokens has no runs. ``owner`` is the text's place in ``texts``.
    """
    get = _memo.get
    flat: list[int] = []
    lengths = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = TOKEN.findall(text.lower()) if text else []
        lengths[i] = len(words)
        for w in words:
            h = get(w)
            flat.append(_hash(w) if h is None else h)
    words_ = np.array(flat, np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(words_)) - starts[owner]
    size = lengths[owner]
    whole = (place + width <= size) | ((size < width) & (place == 0))
    run = np.full(len(words_), np.uint64(0x51), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            there = place + k < size
            next_ = np.zeros(len(words_), np.uint64)
            next_[: len(words_) - k] = words_[k:]
            run = np.where(there, mix((run + next_ + _C) * _A), run)
    owner, run = owner[whole], run[whole]
    order = np.lexsort((run, owner))
    owner, run = owner[order], run[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], run[new]


def set_keys(n: int, owner: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit key of each text's run set, as two signed halves, and the set's size."""
    size = np.bincount(owner, minlength=n)
    first = np.cumsum(size) - size
    some = np.flatnonzero(size)
    halves = []
    with np.errstate(over="ignore"):
        for salt in (_B, _C):
            sums = np.zeros(n, np.uint64)
            if len(run):
                sums[some] = np.add.reduceat(mix(run ^ salt), first[some])
            halves.append(sums.view(np.int64))
    return halves[0], halves[1], size

"""Hashes of words and of word shingles, a slice of texts at a time in numpy.

A word's hash is a polynomial over random values of its bytes, from prefix sums over the
slice; a shingle's hash mixes those of its words. Both are 64 bits, equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np

from .char_lm import mix
from .common import SLICE_BYTES, slices

_BASE = 0x9E3779B97F4A7C15 | 1
_WORDS = [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes; powers of the base and of its inverse for the positions of a slice."""
    n = SLICE_BYTES + 1
    powers, inverse = np.full(n, _BASE, dtype=np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    powers[0] = inverse[0] = 1
    return mix(np.arange(1, 257, dtype=np.uint64)), np.cumprod(powers), np.cumprod(inverse)


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of SLICE_BYTES bytes at most."""
    letters = np.frombuffer(data, dtype=np.uint8)
    blank = np.concatenate([[True], _SPACE[letters], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edges[::2], edges[1::2]
    value, power, inverse = _tables()
    total = np.concatenate([[np.uint64(0)], np.cumsum(value[letters] * power[: len(letters)])])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)), start


def _long_hashes(data: bytes) -> np.ndarray:
    """Of one text of any length, in pieces cut at blanks; a word too long for a piece is
    hashed from its own pieces."""
    out, at = [], 0
    while at < len(data):
        piece = data[at : at + SLICE_BYTES]
        if len(piece) == SLICE_BYTES:
            cut = max(piece.rfind(c) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
            if cut < 0:  # one word to the end of the piece and beyond
                ends = [i for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (i := data.find(c, at)) >= 0]
                end = min(ends, default=len(data))
                parts = np.concatenate([_hashes(data[i : min(i + SLICE_BYTES, end)])[0] for i in range(at, end, SLICE_BYTES)])
                out.append(mix(np.array([np.bitwise_xor.reduce(mix(parts + np.arange(len(parts), dtype=np.uint64)))])))
                at = end
                continue
            piece = piece[: cut + 1]
        out.append(_hashes(piece)[0])
        at += len(piece)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def word_hashes(texts: Sequence[bytes | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words in order) for every row; A-Z count as a-z, words are runs
    of anything but ASCII space."""
    for part in slices(texts, SLICE_BYTES // 2):
        group = [(texts[i] or b"").lower() for i in part]
        if sum(map(len, group)) + len(group) > SLICE_BYTES:
            for i, t in zip(part, group):
                yield i, _long_hashes(t)
            continue
        hashes, start = _hashes(b" ".join(group))
        first = np.cumsum([0] + [len(t) + 1 for t in group])
        cut = np.searchsorted(start, first)
        for k, i in enumerate(part):
            yield i, hashes[cut[k] : cut[k + 1]]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` successive words; fewer words are one shingle."""
    if not len(words):
        return words
    n = max(len(words) - size + 1, 1)
    out = np.full(n, min(len(words), size), dtype=np.uint64)
    for k in range(min(len(words), size)):
        out += words[k : k + n] * np.uint64(_WORDS[k])
    return np.unique(mix(out))

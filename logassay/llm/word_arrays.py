"""Words of many texts as arrays: bounds, 64-bit fingerprints and runs of words.

Texts are UTF-8 bytes. Both word rules of this folder exclude only ASCII
characters, so a byte belongs to a word exactly when its character does.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PIECE = 1 << 18
_random = np.random.default_rng(20240229)
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
PLACE_VALUES = _random.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 2**64)


def _table(outside: list[int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[outside] = False
    return table


# Words of anything but ASCII white space; words of digits, letters and all beyond ASCII.
SPACED = _table([0x20, *range(0x09, 0x0E)])
LETTERED = _table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_forward, _backward = _powers(STEP, PIECE), _powers(BACK, PIECE)


def _need(n: int) -> None:
    global _forward, _backward
    if n > len(_forward):
        _forward, _backward = _powers(STEP, n), _powers(BACK, n)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of several texts in order; ``first[i]:first[i + 1]`` are those of text i."""

    buffer: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.buffer[self.start[i] : self.end[i]]


def split_words(texts: list[bytes], table: np.ndarray) -> Words:
    """Word bounds of all texts at once; the texts lie joined by line feeds, which no word holds."""
    buffer = b"\n".join(texts)
    inside = table[np.frombuffer(buffer, dtype=np.uint8)]
    edge = np.empty(len(inside) + 1, dtype=bool)
    if len(inside):
        edge[0], edge[-1] = inside[0], inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    else:
        edge[:] = False
    bounds = np.flatnonzero(edge)
    start, end = bounds[0::2], bounds[1::2]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_start = np.concatenate(([0], np.cumsum(sizes + 1)))
    return Words(buffer, start, end, np.searchsorted(start, text_start))


def fingerprints(words: Words) -> np.ndarray:
    """A 64-bit value for each word, equal for equal words.

    Differences of a running sum of weighted bytes; the sum runs over pieces of
    the buffer so that memory follows the piece (or the longest word), not the text.
    """
    out = np.empty(len(words.start), dtype=np.uint64)
    data = np.frombuffer(words.buffer, dtype=np.uint8)
    i = 0
    while i < len(out):
        base = words.start[i]
        j = max(i + 1, int(np.searchsorted(words.end, base + PIECE, side="right")))
        piece = data[base : words.end[j - 1]]
        _need(len(piece) + 1)
        total = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[piece] * _forward[: len(piece)], out=total[1:])
        s, e = words.start[i:j] - base, words.end[i:j] - base
        out[i:j] = (total[e] - total[s]) * _backward[s] + (e - s).astype(np.uint64) * PLACE_VALUES[0]
        i = j
    return mix(out)


def run_hashes(marks: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """A 64-bit value for each run of ``n`` marks, by the place of the run's first."""
    if len(marks) < n:
        return np.empty(0, dtype=np.uint64)
    size = len(marks) - n + 1
    out = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        out += marks[k : k + size] * PLACE_VALUES[(k + salt) % len(PLACE_VALUES)]
    return mix(out)

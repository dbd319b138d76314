"""Words of whole Arrow text columns as numpy arrays, without a Python object per word.

A word is a maximal run of characters other than space and U+0009 to U+000D. Words are hashed
to 64 bits from their bytes; two different words get equal hashes with a chance of about
2**-64 a pair.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    start = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)
    return mix(start) | U64(1)


BYTE_CODE = odd_constants(256, 11)
BASE = 0x9FB21C651E98DF25
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES)
        step = np.full(size, base, dtype=U64)
        step[0] = 1
        have = _powers[base] = np.multiply.accumulate(step)
    return have[:n]


def release() -> None:
    """Give back what a task leaves behind: workers are used again, and their sizes add up."""
    for base in [b for b, held in _powers.items() if len(held) > CHUNK_BYTES]:
        del _powers[base]
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where there is no such call
        ctypes.CDLL(None).malloc_trim(0)


@dataclass
class Words:
    """All words of some texts in order. ``first[i]:first[i + 1]`` are those of text i, and
    ``start`` and ``end`` their places in ``data``, the texts' bytes joined together."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool) -> np.ndarray:
        """A hash of each word's bytes, A-Z taken as a-z if ``lower``."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, U64)
        coded = BYTE_CODE[LOWER[self.data] if lower else self.data]
        sums = np.zeros(n + 1, U64)
        np.cumsum(coded * powers(BASE, n), out=sums[1:])
        raw = (sums[self.end] - sums[self.start]) * powers(BASE_INVERSE, n)[self.start]
        return mix(raw + (self.end - self.start).astype(U64) * U64(0x9E3779B97F4A7C15))

    def totals(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum of a figure of each byte over each text."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(per_byte, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def word_totals(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum of a figure of each byte over each word."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(per_byte, out=sums[1:])
        return sums[self.end] - sums[self.start]


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of whole texts of about ``size`` bytes with the place of their first; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
        yield at, column.slice(at, upto - at)
        at = upto


def split_words(column: pa.Array) -> Words:
    """Words of a run from ``text_chunks``."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(data)
    word = ~SEPARATOR[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[: n - 1] = word[:-1], word[1:]
    bounds = offsets[(offsets > 0) & (offsets < n)]
    before[bounds] = False
    after[bounds - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def window_hashes(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on; of no use for the last ``size - 1``."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for i, c in enumerate(odd_constants(size, seed)):
        total += mix(words[i : i + n] * c)
    return mix(total)

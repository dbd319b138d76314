"""Texts cut into super-windows, which bring equal windows of different texts together.

A window is a string of ``length`` bytes. Its anchor is the gram of ``gram(length)`` bytes in it
with the least hash, the first of equal ones, so equal windows have equal anchors at equal places.
Windows in a row that share their anchor's place make up a super-window: two windows can only be
equal in super-windows whose anchors are equal, and each is shipped once for all its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from stormgrid.llm.textvec import BASE, BYTE_CODE, U64, mix, odd_constants, text_chunks


def gram(length: int) -> int:
    """Longer grams are rarer by chance, shorter ones make fewer super-windows."""
    return max(1, length * 2 // 5)


def hashes_of(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all strings of the given sizes, by doubling: entry i is of the one from byte i on."""
    doubled, size = {1: BYTE_CODE[data]}, 1
    while size * 2 <= max(sizes):
        h = doubled[size]
        step = U64(pow(BASE, size, 1 << 64))
        doubled[size * 2] = h[: len(h) - size] * step + h[size:]
        size *= 2
    out = []
    for wanted in sizes:
        have, done = None, 0
        for power in sorted(doubled, reverse=True):
            if wanted - done >= power:
                part = doubled[power][done : len(data) - wanted + 1 + done]
                have = part.copy() if have is None else have * U64(pow(BASE, power, 1 << 64)) + part
                done += power
        out.append(mix(have))
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    have, size = values, 1
    while size * 2 <= width:
        have = np.minimum(have[: len(have) - size], have[size:])
        size *= 2
    rest = width - size
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


@dataclass
class SuperWindows:
    """Super-windows of some texts in order. ``windows`` is how many each holds, so it has
    ``length - 1 + windows`` bytes; ``start`` is its place in ``data``, the texts' bytes joined."""

    data: np.ndarray
    offsets: np.ndarray
    text: np.ndarray  # which text
    start: np.ndarray
    windows: np.ndarray
    key: np.ndarray  # int32, of the anchor
    digest: np.ndarray  # int64, of the whole super-window
    window_hash: np.ndarray  # uint64, of the window from each byte on
    grams: np.ndarray  # uint64, of the gram from each byte on

    def single(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Key and digest of single windows, from hashes that do not follow from each other."""
        size = gram(length)
        covered = np.zeros(len(at), U64)
        with np.errstate(over="ignore"):
            for i, c in enumerate(odd_constants(-(-length // size), 17)):
                covered += self.grams[at + min(i * size, length - size)] * c
        return mix(covered).view(np.int64).astype(np.int32), self.window_hash[at].view(np.int64)

    def taken(self, which: np.ndarray) -> SuperWindows:
        """Some of them, in any order and number."""
        picked = (c[which] for c in (self.text, self.start, self.windows, self.key, self.digest))
        return SuperWindows(self.data, self.offsets, *picked, self.window_hash, self.grams)

    def place(self) -> np.ndarray:
        return self.start - self.offsets[self.text]


def super_windows(run: pa.Array, length: int) -> SuperWindows:
    """Those of a run from ``text_chunks``; shorter texts have none."""
    offsets = np.frombuffer(run.buffers()[1], np.int64)[run.offset : run.offset + len(run) + 1]
    held = run.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    n, size = len(data) - length + 1, gram(length)
    if n <= 0:
        none = np.zeros(0, np.int64)
        blank = none.astype(U64)
        return SuperWindows(data, offsets, none, none, none, none.astype(np.int32), none, blank, blank)
    grams, whole = hashes_of(data, (size, length))
    # 32 bits of hash and the place in one number: the least is the first of the least grams
    packed = (grams >> U64(32) << U64(32)) | np.arange(len(grams), dtype=U64)
    anchor = (_least(packed, length - size + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    # windows that reach into the next text are none
    crossing = np.zeros(n + 1, np.int32)
    np.add.at(crossing, np.clip(offsets[1:] - length + 1, 0, n), 1)
    np.add.at(crossing, np.clip(offsets[1:], 0, n), -1)
    # a text shorter than a window only voids its own places
    short = np.flatnonzero(np.diff(offsets) < length)
    np.add.at(crossing, np.clip(offsets[1:][short] - length + 1, 0, n), -1)
    np.add.at(crossing, np.clip(offsets[:-1][short], 0, n), 1)
    valid = np.cumsum(crossing[:n]) == 0
    opens = valid.copy()
    opens[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    closes = valid.copy()
    closes[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
    start, last = np.flatnonzero(opens), np.flatnonzero(closes)
    windows = last - start + 1
    # first and last window cover a super-window, for it holds fewer windows than a window has bytes
    with np.errstate(over="ignore"):
        digest = mix(whole[start] * U64(0x9E3779B97F4A7C15) + mix(whole[last] + windows.astype(U64)))
    key = (grams[anchor[start]] & U64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
    text = np.searchsorted(offsets, start, side="right") - 1
    return SuperWindows(data, offsets, text, start, windows, key, digest.view(np.int64), whole, grams)


def text_runs(column: pa.Array, length: int):
    """(place of the first text, super-windows) for runs of whole texts."""
    for at, run in text_chunks(column):
        yield at, super_windows(run, length)

"""Rule statistics of whole texts, column by column of numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from stormgrid.llm.textvec import SEPARATOR, Words, split_words, text_chunks, window_hashes

WINDOW = 8
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
BYTES = np.arange(256)
UPPER = (BYTES >= 0x41) & (BYTES <= 0x5A)
DIGIT = (BYTES >= 0x30) & (BYTES <= 0x39)
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[ord(c) for c in ".,;:!?-'\""]] = True
EXCLAIM = BYTES == ord("!")
CHARACTER = (BYTES & 0xC0) != 0x80  # the first byte of a code point
BLANKS = " \t\n\x0b\x0c\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: Words, hashed: np.ndarray) -> np.ndarray:
    """For each word whether it lies in a window that its text has twice or more."""
    n = len(hashed)
    covered = np.zeros(n + 1, np.int64)
    windows = window_hashes(hashed, WINDOW, seed=8)
    if len(windows):
        text = np.repeat(np.arange(len(words.first) - 1), words.counts())
        whole = np.flatnonzero(text[: len(windows)] == text[WINDOW - 1 :])
        key = windows[whole]
        order = np.lexsort((key, text[whole]))
        same = (key[order][1:] == key[order][:-1]) & (text[whole][order][1:] == text[whole][order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = whole[order[twice]]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    return np.cumsum(covered[:n]) > 0


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them that an earlier line equals."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines), len(lines) - len(set(lines))


def statistics(run: pa.Array) -> dict[str, np.ndarray]:
    """Base counts and other totals of each text."""
    words = split_words(run)
    hashed = words.hashes(lower=False)
    repeats = repeated_words(words, hashed)
    data, first = words.data, words.first
    marks = np.r_[0, np.cumsum(repeats)]
    lines = np.array([duplicate_lines(t) for t in run.to_pylist()], np.int64).reshape(-1, 2)
    return {
        "n_words": words.counts().astype(np.int64),
        "word_chars": words.totals(CHARACTER[data] & ~SEPARATOR[data]),
        "n_symbols": words.totals(SYMBOL[data]),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": marks[first[1:]] - marks[first[:-1]],
        "n_lines": lines[:, 0],
        "n_upper": words.totals(UPPER[data]),
        "n_exclaim": words.totals(EXCLAIM[data]),
    }


__all__ = ["BASE", "repeated_words", "statistics", "text_chunks"]

"""Words of text columns as Arrow values, compared by their bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from stormgrid.llm.textvec import Words, split_words

# Terms are runs of letters, digits and everything beyond ASCII; only A-Z are lower-cased.
TERM_BYTES = np.full(256, 0x20, np.uint8)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    TERM_BYTES[_first : _last + 1] = np.arange(_first, _last + 1)
TERM_BYTES[0x41:0x5B] += 0x20


def spelt(words: Words) -> pa.Array:
    """The words' bytes, one value for each word."""
    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.start] += 1
    inside[words.end] -= 1
    letters = words.data[np.cumsum(inside[:-1]).astype(bool)]
    ends = np.concatenate([[0], np.cumsum(words.end - words.start)]).astype(np.int64)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(letters)]
    return pa.Array.from_buffers(pa.large_binary(), len(words.start), buffers)


def terms(run: pa.Array) -> Words:
    """Terms of a run from ``text_chunks``."""
    offsets = np.frombuffer(run.buffers()[1], np.int64)[run.offset : run.offset + len(run) + 1]
    held = run.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    buffers = [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(TERM_BYTES[data])]
    return split_words(pa.Array.from_buffers(pa.large_string(), len(run), buffers))

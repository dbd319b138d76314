"""Sets of distinct word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from stormgrid.llm.textvec import U64, mix, split_words, text_chunks, window_hashes

PARITY_BITS = 1024
PARITY_WORDS = PARITY_BITS // 64


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text its set, ascending as signed numbers. Texts of fewer words have their whole
    sequence as the one member, texts without words the empty set."""
    for _, run in text_chunks(column):
        words = split_words(run)
        hashed = words.hashes(lower=True)
        windows = window_hashes(hashed, size, seed=5).view(np.int64)
        for first, last in zip(words.first[:-1], words.first[1:]):
            if last - first >= size:
                yield np.unique(windows[first : last - size + 1])
            elif last > first:
                short = U64(last - first)
                for h in hashed[first:last]:
                    with np.errstate(over="ignore"):
                        short = mix(np.array([short * U64(0x9E3779B97F4A7C15) + h]))[0]
                yield np.array([short], U64).view(np.int64)
            else:
                yield np.zeros(0, np.int64)


def list_array(sets: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(sets) + 1, np.int32)
    np.cumsum([len(s) for s in sets], out=offsets[1:])
    values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def sketch_batches(size: int, k: int):
    """For mapInArrow over (doc_id, text): doc_id, n_shingles, a digest of the whole set and the
    k smallest members."""

    def run(batches):
        for batch in batches:
            counts, digests, lists = [], [], []
            for members in shingle_sets(batch.column(1), size):
                counts.append(len(members))
                digests.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                lists.append(members[:k])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    list_array(lists),
                ],
                names=["doc_id", "n_shingles", "digest", "sketch"],
            )

    return run


SKETCH_SCHEMA = "doc_id long, n_shingles long, digest binary, sketch array<long>"


def parity_bits(members: np.ndarray) -> np.ndarray:
    """A bitmap of the set: each member flips one of 1024 bits. The bits in which two bitmaps
    differ are never more than the members in which the sets differ."""
    at = members.view(U64) >> U64(64 - PARITY_BITS.bit_length() + 1)
    flipped = np.bincount(at.astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(flipped.astype(np.uint8)).view(np.int64)


def set_batches(size: int):
    """For mapInArrow over (doc_id, text): doc_id, the whole set and its parity bitmap."""

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), list_array(sets), list_array([parity_bits(s) for s in sets])],
                names=["doc_id", "members", "bits"],
            )

    return run


SET_SCHEMA = "doc_id long, members array<long>, bits array<long>"

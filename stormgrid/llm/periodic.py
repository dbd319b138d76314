"""Periodic runs of words by minimizers at several scales.

A run of smallest period q is at least four periods long here. Scale k, a power of two, looks for
q in (k/2, k]. In each window of k/2 grams of k words the gram with the least hash is the window's
minimizer. A window and the one q words on are alike inside a run, so their minimizers are equal
and q apart; a gram of k >= q words cannot come again sooner, for two periods of so long a
stretch leave a common divisor as its period. Equal minimizers next to each other at such a
distance are seeds, and a run that holds both windows, q + 3k/2 - 1 < 4q words, has one. Periods
of up to eight words are too short for this and are found by comparing the words at each lag.

A seed vouches for k + q equal words, so seeds lie in true repetitions of more than two periods;
those of one scale overlap little, and extending them all takes time in proportion to the text.
Grams are named by number, pair by pair of half as long ones, and words by their bytes: nothing
rests on hashes being free of collisions. Texts are worked on in turn, a megabyte at a time.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stormgrid.llm.textvec import U64, mix, split_words, text_chunks
from stormgrid.llm.words import spelt

PERIODS = 4  # whole periods in a run
LEAST_WORDS = 6
LAGS = 8  # periods found by direct comparison
SHORT = 16  # the first scale


def word_names(run: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For a run from ``text_chunks``: a number for each word, equal for equal words; the first word
    of each text, and one past the last; the distinct words by their numbers."""
    words = split_words(run)
    coded = spelt(words).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), words.first, coded.dictionary


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` values in a row, the first of equal ones."""
    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


def _named(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def _stretch(words: np.ndarray, begin: int, end: int, lag: int) -> tuple[int, int]:
    """The longest stretch of places around ``begin:end`` whose words equal those ``lag`` on."""
    size = max(64, end - begin)
    while True:
        upto = min(end + size, len(words) - lag)
        unlike = np.flatnonzero(words[end:upto] != words[end + lag : upto + lag])
        if len(unlike):
            end += int(unlike[0])
            break
        end = max(end, upto)
        if upto >= len(words) - lag:
            break
        size *= 2
    size = 64
    while begin:
        low = max(0, begin - size)
        unlike = np.flatnonzero(words[low:begin] != words[low + lag : begin + lag])
        if len(unlike):
            begin = low + int(unlike[-1]) + 1
            break
        begin, size = low, size * 2
    return begin, end


def _by_lag(words: np.ndarray, lag: int, least: int) -> np.ndarray:
    """(start, end, lag) of stretches of period ``lag`` and at least ``least`` words."""
    if len(words) < least:
        return np.zeros((0, 3), np.int64)
    same = words[:-lag] == words[lag:]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    begin, end = edge[::2], edge[1::2] + lag
    long = end - begin >= least
    return np.stack([begin[long], end[long], np.full(long.sum(), lag)], 1)


def _by_seeds(words: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """(start, end, period) of stretches found at scale k, whose grams have these names."""
    order = mix(names.astype(U64) + U64(k))
    chosen = np.unique(_sliding_least(order, k // 2)) if len(names) >= k // 2 else np.zeros(0, np.int64)
    chosen = chosen[np.argsort(names[chosen], kind="stable")]
    near = np.diff(chosen)
    pair = (names[chosen[1:]] == names[chosen[:-1]]) & (near > k // 2) & (near <= k)
    at, lag = chosen[:-1][pair], near[pair]
    by_lag = np.lexsort((at, lag))
    at, lag = at[by_lag], lag[by_lag]
    # seeds of one lag that touch belong together, and all between them is equal too
    opens = np.ones(len(at), bool)
    opens[1:] = (lag[1:] != lag[:-1]) | (at[1:] > at[:-1] + k)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(at)) - 1
    found = []
    for a, b, q in zip(at[first].tolist(), (at[last[: len(first)]] + k).tolist(), lag[first].tolist()):
        begin, end = _stretch(words, a, b, q)
        if end + q - begin >= PERIODS * q:
            found.append((begin, end + q, q))
    return np.array(found, np.int64).reshape(-1, 3)


def periodic_runs(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(text, start, length, period) of all runs, by text, start and period. ``words`` are the numbers
    of the words of texts that begin at ``first[:-1]``; places count from a text's own first word."""
    sizes = np.diff(first)
    # a number of its own after each text: nothing is equal across it
    text = np.repeat(np.arange(len(sizes)), sizes)
    spaced = np.empty(len(words) + len(sizes), np.int64)
    spaced[np.arange(len(words)) + text] = words
    breaks = first[1:] + np.arange(len(sizes))
    spaced[breaks] = -1 - np.arange(len(sizes))
    found = [_by_lag(spaced, q, max(LEAST_WORDS, PERIODS * q)) for q in range(1, LAGS + 1)]
    part, origin = spaced, np.arange(len(spaced))
    names, many, k, held = spaced + len(sizes), len(spaced) + len(sizes) + 1, 1, len(sizes)
    while True:
        k *= 2
        # a run of period over k / 2 is longer than 2 k; shorter texts take no further part
        long = sizes > 2 * max(k, SHORT)
        if not long.any():
            break
        if long.sum() < held:
            held = long.sum()
            keep = long[np.searchsorted(breaks, origin)]
            # grams within a text keep their names, and those across its end are unique
            names, part, origin = names[keep[: len(names)]], part[keep], origin[keep]
        names = _named(names[: -k // 2] * many + names[k // 2 :])
        if k >= SHORT:
            runs = _by_seeds(part, names, k)
            found.append(np.stack([origin[runs[:, 0]], origin[runs[:, 1] - 1] + 1, runs[:, 2]], 1))
    runs = np.unique(np.concatenate(found), axis=0)
    # a stretch that is a run of a shorter period has that one; rows of one stretch begin with it
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, 0] != runs[:-1, 0]) | (runs[1:, 1] != runs[:-1, 1])
    start, end, period = runs[new].T
    of = np.searchsorted(breaks, start)
    out = np.stack([of, start - first[of] - of, end - start, period], 1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def planted(words: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The report's input: a tenth of the documents get a run, by their id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    return words[np.where(place >= a, a + (place - a) % p, place)]


def _strongest(runs: np.ndarray) -> tuple:
    """(start, length, period, exponent_milli) of the run of most periods, in whole numbers."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def report_batches(plant: bool, texts: bool):
    """For mapInArrow over (doc_id, text): the figures of ``report``."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, part in text_chunks(batch.column(1)):
                words, first, distinct = word_names(part)
                mine = ids[at : at + len(part)]
                if plant:
                    words = np.concatenate([planted(words[a:b], i) for a, b, i in zip(first[:-1], first[1:], mine)])
                runs = periodic_runs(words, first)
                bounds = np.searchsorted(runs[:, 0], np.arange(len(part) + 1))
                rows, left = [], []
                for i, doc in enumerate(mine):
                    own = runs[bounds[i] : bounds[i + 1], 1:]
                    said = "".join(f"{s},{n},{q}\n" for s, n, q in own.tolist())
                    inside = np.zeros(first[i + 1] - first[i] + 1, np.int64)
                    np.add.at(inside, own[:, 0] + own[:, 2], 1)
                    np.add.at(inside, own[:, 0] + own[:, 1], -1)
                    kept = words[first[i] : first[i + 1]][np.cumsum(inside[:-1]) == 0]
                    left.append(b" ".join(distinct.take(pa.array(kept)).to_pylist()))
                    digests = [hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(left[-1]).hexdigest()]
                    rows.append((doc, len(own), *_strongest(own), *digests))
                columns = [pa.array(c, pa.int64() if n < 6 else pa.string()) for n, c in enumerate(zip(*rows))]
                names = COLUMNS
                if texts:
                    columns, names = [*columns, pa.array([t.decode() for t in left], pa.string())], [*COLUMNS, "collapsed"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def report(docs: DataFrame, plant: bool = False, texts: bool = False) -> DataFrame:
    """One row for each of (doc_id, text): number of runs, the strongest one, digests of all runs and
    of the text that is left when of each run only its first period stays, on demand with that
    text, its words apart by one blank.

    Null, empty and blank texts have no runs and no words. Rows that repeat a doc_id are judged
    each by itself, and a row without a doc_id like any other. ``plant`` first puts a run into a
    tenth of the documents, by their id.
    """
    schema = [f"{c} {'long' if n < 6 else 'string'}" for n, c in enumerate(COLUMNS)]
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(report_batches(plant, texts), ", ".join(schema + ["collapsed string"] * texts))

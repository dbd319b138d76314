"""Periodic runs against the definition, word by word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from stormgrid.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0d]+")


@pytest.fixture(autouse=True)
def importable(spark):
    queries.importable(spark)


def runs_by_definition(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            run = w[i : j + q]
            shorter = any(all(run[x] == run[x + d] for x in range(len(run) - d)) for d in range(1, q))
            if len(run) >= max(6, 4 * q) and not shorter:
                out.append((i, len(run), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def row_by_definition(i, text, plant=True):
    w = WORD.findall(text or "")
    h, n = (zlib.crc32(str(i).encode()) if i is not None else 1), len(w)
    if plant and h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (x - a) % p] if x >= a else w[x] for x in range(n)]
    runs = runs_by_definition(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    gone = {x for s, m, q in runs for x in range(s + q, s + m)}
    left = " ".join(x for at, x in enumerate(w) if at not in gone)
    said = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (said, left)]
    return (i, len(runs), *best, milli, *sha, left)


def random_words(rng, n):
    """Words of few kinds with repeated stretches of all periods and broken copies of them."""
    out = []
    while len(out) < n:
        unit = rng.choices(["a", "b", "ä", "B", "!"][: rng.randint(1, 5)], k=rng.choice([1, 2, 3, 5, 8, 9, 13, 16, 17, 30, 41]))
        out += (unit * rng.randint(1, 7))[: rng.randint(1, 200)]
        out += rng.choices(["a", "b", "c", "d"], k=rng.randint(0, 3))
    return out[:n]


def test_runs_by_definition():
    rng = random.Random(1)
    texts = [random_words(rng, rng.choice([0, 1, 5, 6, 7, 30, 90, 200, 400])) for _ in range(120)]
    texts += [["a"] * n for n in (5, 6, 100, 500)] + [["a", "b"] * 40, ["a"] * 16 + ["b"] + ["a"] * 16]
    # a word without any cube, Thue and Morse's, and one with runs of many periods, Fibonacci's
    texts.append(["ab"[bin(i).count("1") % 2] for i in range(600)])
    a, b = ["a"], ["a", "b"]
    while len(b) < 500:
        a, b = b, b + a
    texts.append(b)
    column = pa.array([" ".join(t) for t in texts], pa.large_string())
    words, first, _ = periodic.word_names(column)
    got = periodic.periodic_runs(words, first)
    for i, t in enumerate(texts):
        assert [tuple(r) for r in got[got[:, 0] == i][:, 1:].tolist()] == runs_by_definition(t), i


def test_long_periods():
    """Each scale finds the runs just long enough, at any place, and not those a word shorter."""
    rng = random.Random(2)
    for q in (9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 100, 127, 129, 255, 256, 257, 400, 1000, 3000):
        unit = [f"u{x}" for x in range(q)]
        for length in (4 * q - 1, 4 * q, 4 * q + 1, 6 * q + 3):
            lead = rng.randint(0, 50)
            w = [f"x{x}" for x in range(lead)] + (unit * 7)[:length] + ["end"]
            words = np.unique(np.array(w), return_inverse=True)[1].astype(np.int64)
            got = periodic.periodic_runs(words, np.array([0, len(w)]))
            assert got.tolist() == ([[0, lead, length, q]] if length >= 4 * q else []), (q, length)


def test_report(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(random_words(rng, rng.randint(0, 120)))) for i in range(150)]
    rows += [(3, None), (3, ""), (None, "a " * 9), (None, None), (7, " \n"), (8, "ab " * 30), (8, "ab " * 30)]
    rows += [(500, "ä" * 30_000), (501, "Hi hi " * 20)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, start long, period int")
    got = sorted(map(tuple, periodic.report(docs, plant=True, texts=True).collect()), key=str)
    assert got == sorted((row_by_definition(i, t) for i, t in rows), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    assert periodic.report(docs.limit(0)).collect() == []


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [(i, t) for i, t in rows if len(t or "") < 2500]
    got = {r[0]: tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for i, t in short:
        assert got[i] == row_by_definition(i, t)[:-1]


def test_very_long_text(spark):
    """A text of a million words, a quarter of them one run."""
    unit = [f"w{x}" for x in range(20_000)]
    text = " ".join([f"v{x}" for x in range(300_000)] + unit * 13 + ["z"] * 400_000)
    row = periodic.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (2, 560_000, 400_000, 1)

"""Ranked search against plain scoring of every document, and its tables against plain maxima."""

import collections
import math
import random
import re

import numpy as np
import pytest

from stormgrid.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(autouse=True)
def importable(spark):
    queries.importable(spark)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_brute_force(docs, items, top=10):
    held = [(i, collections.Counter(terms(t))) for i, t in docs if i is not None]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    asked = collections.defaultdict(list)
    for i, t in items:
        if i is not None:
            asked[i] += terms(t)
    out = []
    for item, words in asked.items():
        scores = []
        for i, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in words if t in c)
            if score > 0:
                scores.append((-score, i))
        out += [(item, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(out)


def tables(spark, docs, items):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score long, n int")
    return docs, spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, rank int")


def texts(seed, n):
    """Words of very unequal frequency, texts of very unequal length, ties, repeats and gaps."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Über", "naïve", "x1", "the"]
    odds = [1 / (i + 1) for i in range(len(vocabulary))]
    draw = lambda k: rng.choice([" ", ", ", "\0", "-"]).join(rng.choices(vocabulary, odds, k=k))
    docs = [(rng.randint(0, 10**6), draw(rng.choice([1, 5, 20, 60, 400]))) for _ in range(n)]
    docs += [(i + 2_000_000, t) for i, t in docs[:30]] + docs[:5] + [(7, None), (8, ""), (9, "?! .."), (None, "w1 w2")]
    items = [(i, draw(rng.choice([1, 3, 30]))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "unknown words"), (None, "w1"), (33, "W3 w3 w3 W4"), (33, "w5"), (34, "ÜBER über Über")]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"block_docs": 64, "leaf": 1}, {"leaf": 4, "query_terms": 20}, {"top": 1, "leaf": 2}])
def test_by_brute_force(spark, limits):
    docs, items = texts(1, 700)
    got = lexical.search(*tables(spark, docs, items), **limits).collect()
    assert sorted(map(tuple, got)) == by_brute_force(docs, items, limits.get("top", 10))


def test_one_text_in_a_third_of_the_rows(spark):
    docs, items = texts(2, 300)
    docs += [(10_000_000 + i, "w1 w2 w3 the") for i in range(150)]
    got = lexical.search(*tables(spark, docs, items), leaf=3).collect()
    assert sorted(map(tuple, got)) == by_brute_force(docs, items)


def test_empty_tables(spark):
    docs, items = texts(3, 20)
    for some, asked in ((docs[:0], items), (docs, items[:0]), ([(1, None)], items)):
        assert lexical.search(*tables(spark, some, asked)).collect() == []


def block_of(rng, docs, vocabulary):
    counts = np.array([rng.randint(0, vocabulary) for _ in range(docs)])
    term = np.concatenate([sorted(rng.sample(range(vocabulary), c)) for c in counts]).astype(np.int64)
    tf = np.array([rng.randint(1, 9) for _ in term])
    n = np.array([rng.randint(1, 500) for _ in range(docs)])
    weight = np.array([rng.randint(0, 900) for _ in range(vocabulary)])
    search = lexical.Search([], weight, docs, int(n.sum()), 10)
    return lexical.Block(np.array(rng.sample(range(10**6), docs)), n, counts, term, tf, search)


def test_sparse_table_by_plain_maximum():
    rng = random.Random(4)
    block = block_of(rng, 200, 9)
    for t in range(9):
        low, high = (int(x[0]) for x in block.lists(np.array([t])))
        for _ in range(200):
            a = rng.randint(low, high - 1)
            b = rng.randint(a + 1, high)
            place = int(block.greatest(np.array([a]), np.array([b]))[0])
            assert place == a + int(block.impact[a:b].argmax())


def test_intervals_save_scoring():
    """A rare term leads to its documents: the others' intervals are bounded away unscored."""
    rng = random.Random(5)
    docs, vocabulary = 4000, 3
    counts = np.full(docs, 2)
    term = np.tile([0, 1], docs)
    term[2 * 1234 + 1] = 2
    search = lexical.Search([], np.array([10, 20, 9000]), docs, docs * 50, 1)
    n = np.array([rng.randint(20, 80) for _ in range(docs)])
    block = lexical.Block(np.arange(docs), n, counts, term, np.ones(docs * 2, np.int64), search)
    best = lexical.Best(1)
    scored = lexical.search_block(block, np.arange(3), np.ones(3, np.int64), best, leaf=8)
    assert best.doc.tolist() == [1234] and scored < 50

"""Neighbours over several blocks: ties, repeated ids and recall against brute force."""

import numpy as np
import pytest

from stormgrid.llm import neighbours, queries


@pytest.fixture(autouse=True)
def importable(spark):
    queries.importable(spark)


def by_brute_force(rows, k=10):
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            best = {}
            for i, w in rows:
                if i != q:
                    d = float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum()))
                    best[i] = min(d, best.get(i, np.inf))
            out[q] = sorted((d, i) for i, d in best.items())[:k]
    return out


def test_blocks_ties_and_repeats(spark, monkeypatch):
    """With a certain stop every neighbour is found, in its order, whatever the blocks."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(3)
    # few different places, so many equal distances; some ids twice, at two places
    rows = [(i, rng.integers(0, 3, 6).astype(float).tolist()) for i in range(500)]
    rows = [(i, v) for i, v in rows if any(v)] + [(i, [9.0, 0.0, 0.0, 0.0, 0.0, i / 7]) for i in range(1, 30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = table.where("vec_id % 100 = 0")
    got = neighbours.nearest(table, asked, confidence=1 - 1e-12).collect()
    want = by_brute_force(rows)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert found == want


def test_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 32)) * 3
    rows = [(i, (centres[i % 40] + rng.standard_normal(32)).tolist()) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.search_table(table).collect()
    want = by_brute_force(rows)
    hit = sum((r["score"], r["vec_id"]) in set(want[r["query_id"]]) for r in got)
    assert hit >= 0.95 * sum(map(len, want.values()))


def test_few_leaves_for_near_copies():
    """A query with close neighbours is done after a part of the tree."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((500, 48)) * 4
    vectors = np.repeat(base, 12, axis=0) + rng.standard_normal((6000, 48)) * 0.05
    tree = neighbours.KdTree(vectors @ np.random.default_rng(3).standard_normal((48, neighbours.PROJECTED)))
    groups = list(tree.nearest(tree.points[7]))
    assert sorted(np.concatenate([p for p, _ in groups])) == list(range(6000))
    bounds = [b for _, b in groups]
    assert bounds == sorted(bounds) and bounds[-1] == np.inf
    ids, seen = np.arange(6000), []
    kept = neighbours.distances
    neighbours.distances = lambda v, q: (seen.append(len(v)), kept(v, q))[1]
    try:
        found = neighbours.search_block(ids, vectors, ids[:1], vectors[:1], 10, 0.99, 3)
    finally:
        neighbours.distances = kept
    assert {i for _, i, _ in found} <= set(range(12)) and sum(seen) < 2000

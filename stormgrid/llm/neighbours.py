"""Nearest neighbours by low-dimensional stable projections and a kd-tree.

Vectors are projected to a few dimensions with a Gaussian (2-stable) matrix: the squared
projected distance over the squared true one follows a chi-square law of as many degrees. A
kd-tree over the projections hands out neighbours leaf by leaf in growing projected distance, in
groups that double; each is verified with its true distance. The search ends when a vector as
near as the k-th found would, by that law, already have been handed out with the wanted confidence.

Rows are dealt to blocks by a hash, and every block has its own tree. Every query visits every
block: a stated query set against all rows, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

PROJECTED = 8  # even, for the closed form of the chi-square law
CONFIDENCE = 0.99
BLOCK_ROWS = 20_000
LEAF = 64
QUERY_EVERY = 100


def chi_square(x: np.ndarray | float, degrees: int = PROJECTED):
    """Distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def stop_ratio(confidence: float) -> float:
    """The squared projected over squared true distance from which the test holds."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid) < confidence else (low, mid)
    return high


class KdTree:
    """Points in a box tree, split at the median of the widest side: its leaves in order."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        leaves: list[tuple] = []  # (begin, end, low, high)
        if len(points):
            self._build(0, len(points), leaves)
        self.begin, self.end = (np.array([leaf[i] for leaf in leaves], np.int64) for i in (0, 1))
        self.low, self.high = (np.array([leaf[i] for leaf in leaves]) for i in (2, 3))

    def _build(self, begin: int, end: int, leaves: list[tuple]) -> None:
        mine = self.points[self.order[begin:end]]
        low, high = mine.min(0), mine.max(0)
        side = int(np.argmax(high - low))
        if end - begin <= LEAF or high[side] == low[side]:
            leaves.append((begin, end, low, high))
            return
        middle = (end - begin) // 2
        self.order[begin:end] = self.order[begin:end][np.argpartition(mine[:, side], middle)]
        self._build(begin, begin + middle, leaves)
        self._build(begin + middle, end, leaves)

    def nearest(self, q: np.ndarray):
        """(places in ``order``, squared distance that all later ones exceed or reach) by leaves in
        growing distance, twice as many each time."""
        gaps = (np.maximum(np.maximum(self.low - q, q - self.high), 0) ** 2).sum(1)
        by_gap, done, step = np.argsort(gaps, kind="stable"), 0, 1
        while done < len(by_gap):
            some = by_gap[done : done + step]
            done, step = done + len(some), step * 2
            places = np.concatenate([np.arange(self.begin[i], self.end[i]) for i in some])
            yield places, float(gaps[by_gap[done]]) if done < len(by_gap) else math.inf


def distances(vectors: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - q) ** 2).sum(1))


def search_block(ids, vectors, query_ids, queries, k: int, confidence: float, seed: int):
    """Each query's k nearest of a block: lists of (query, id, distance)."""
    rng = np.random.default_rng(seed)
    matrix = rng.standard_normal((vectors.shape[1], PROJECTED))
    tree, projected = KdTree(vectors @ matrix), queries @ matrix
    ids, vectors = ids[tree.order], vectors[tree.order]
    norms = (vectors**2).sum(1)
    ratio, out = stop_ratio(confidence), []
    for query, q, p in zip(query_ids, queries, projected):
        found_d, found_i, norm = np.zeros(0), np.zeros(0, np.int64), float(q @ q)
        for places, beyond in tree.nearest(p):
            places = places[ids[places] != query]
            if len(found_d) == k:
                # one product tells nearly all that are too far; the rest is measured exactly
                about = norms[places] - 2 * (vectors[places] @ q) + norm
                places = places[about <= found_d[-1] ** 2 + 1e-9 * (norms[places] + norm)]
            d = np.r_[found_d, distances(vectors[places], q)]
            i = np.r_[found_i, ids[places]]
            order = np.lexsort((i, d))
            # rows that repeat an id are one candidate, at the smallest distance
            order = order[np.sort(np.unique(i[order], return_index=True)[1])][:k]
            found_d, found_i = d[order], i[order]
            # all not handed out yet project at least that far
            if len(found_d) == k and beyond > ratio * found_d[-1] ** 2:
                break
        out += [(query, i, d) for i, d in zip(found_i, found_d)]
    return out


def sound(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, not empty, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, confidence: float = CONFIDENCE, seed: int = 3
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of (vec_id, embedding) for each of the queries
    of the same form, a query's own id apart.

    Ties go to the smaller vec_id. Rows without an id or with an unsound vector take no part;
    vectors are compared with those of their own length. Rows that repeat a vec_id are one
    candidate, at its smallest distance.
    """

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("embedding").cast("array<double>")
        rows = df.select(F.col("vec_id").cast("long"), v.alias("v")).where("vec_id IS NOT NULL")
        return rows.where(sound(F.col("v"))).withColumn("size", F.size("v"))

    rows = usable(vectors)
    blocks = rows.groupBy("size").agg(F.count("*").alias("n")).withColumn("blocks", F.expr(f"n div {BLOCK_ROWS} + 1"))
    per_size = F.broadcast(blocks.select("size", "blocks"))  # one row for each length of vector
    placed = rows.join(per_size, "size").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    asked = usable(queries).join(per_size, "size").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))

    def search(key, mine: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        found = search_block(
            mine["vec_id"].to_numpy(), np.stack(mine["v"]), asked["vec_id"].to_numpy(), np.stack(asked["v"]), k, confidence, seed
        )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = (
        placed.select("size", "block", "vec_id", "v")
        .groupBy("size", "block")
        .cogroup(asked.select("size", "block", "vec_id", "v").groupBy("size", "block"))
        .applyInPandas(search, "query_id long, vec_id long, score double")
    )
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def search_table(vectors: DataFrame, k: int = 10) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by 100."""
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0), k)

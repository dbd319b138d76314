"""Quality rules: an isolation forest on rule statistics.

A statistic counts by how far it lies outside the range of labelled good documents. The forest
cuts the labelled documents' excesses at random, many times over: they are dealt to the trees, each
to one at least, and the trees grow in parallel. A document that few cuts set apart, a short path,
is unlike the rest. The threshold is the score that a stated share of labelled good documents stays
below. Ranges and threshold are exact quantiles of all of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stormgrid.llm.components import one_text, stored
from stormgrid.llm.rules import BASE, statistics, text_chunks
from stormgrid.llm.textvec import U64, mix, odd_constants

TREES = 200
SAMPLE = 512  # rows that a tree has at least, if there are as many; more where documents are many
DEEPEST = math.ceil(math.log2(SAMPLE)) + 2
GOOD_LOST = 0.004  # share of labelled good documents that may score beyond the threshold
LEAST_WORDS, REPEAT_PERCENT = 20, 30
OUTER = 0.0005  # share of labelled good documents beyond each end of a statistic's range
LEAST_SPREAD = (0.05, 0.05, 0.5, 0.01, 0.01, 0.01)  # of a statistic, where good documents show less
FARTHEST = 3.0  # spreads outside the range, beyond which farther is the same
ANCHORS = 2  # made rows far outside in one statistic, for each of them and each SAMPLE rows of a tree
MEAN_LENGTH = 2  # the statistic that counts below its range too
SEED = 23


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Shares of repeated lines and words, mean word length, and shares of symbols, capitals and
    exclamation marks. They do not depend on a text's length, which is no ground to set it apart."""
    chars, words = s["word_chars"] + 50.0, np.maximum(s["n_words"], 1)
    return np.column_stack(
        [
            s["n_dup_lines"] / (s["n_lines"] + 1.0),
            s["n_repeat_words"] / words,
            s["word_chars"] / words,
            *[s[n] / chars for n in ("n_symbols", "n_upper", "n_exclaim")],
        ]
    )


@dataclass
class Ranges:
    """Where labelled good documents lie, statistic by statistic."""

    low: np.ndarray
    middle: np.ndarray
    high: np.ndarray

    def excess(self, x: np.ndarray) -> np.ndarray:
        """How many spreads each statistic lies above its range, and the word length below it. The
        small differences of ordinary texts are none."""
        above = (x - self.high) / np.maximum(self.high - self.middle, LEAST_SPREAD)
        below = (self.low - x) / np.maximum(self.middle - self.low, LEAST_SPREAD)
        return np.clip(np.column_stack([above, below[:, MEAN_LENGTH]]), 0.0, FARTHEST)


def average_path(n) -> np.ndarray:
    """Mean path of a failed search in a tree of n points."""
    n = np.maximum(np.asarray(n, float), 1)
    with np.errstate(divide="ignore"):
        got = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / n
    return np.where(n > 2, got, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as flat arrays: at an inner node feature >= 0, cut and children; at a leaf the path
    still to be expected. Of bounded size."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    rest: np.ndarray
    roots: np.ndarray
    scale: float
    threshold: float = 1.0
    ranges: Ranges | None = None

    @classmethod
    def of(cls, trees: list[tuple], rows: float, ranges: Ranges | None = None) -> Forest:
        """Trees from ``grown``, of so many rows each on average."""
        feature, cut, left, rest = ([np.asarray(t[i]) for t in trees] for i in range(4))
        roots = np.cumsum([0, *map(len, feature)])[:-1]
        left = [c + root for c, root in zip(left, roots)]
        joined = [np.concatenate(c) for c in (feature, cut, left, rest)]
        return cls(*joined, roots, float(average_path(rows)) or 1.0, ranges=ranges)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; higher is more isolated."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            inner = rows
            while len(inner):
                f = self.feature[at[inner]]
                inner, f = inner[f >= 0], f[f >= 0]
                right = x[inner, f] > self.cut[at[inner]]
                at[inner] = self.left[at[inner]] + right
            total += self.rest[at]
        return 2.0 ** (-total / len(self.roots) / self.scale)


def grown(x: np.ndarray, rng: np.random.Generator) -> tuple[list, list, list, list]:
    """Feature, cut, left child and rest of the nodes of one tree over the rows, its root first."""
    feature, cut, left, rest = [], [], [], []

    def new_node() -> int:
        for column, value in ((feature, -1), (cut, 0.0), (left, 0), (rest, 0.0)):
            column.append(value)
        return len(feature) - 1

    def grow(place: int, rows: np.ndarray, depth: int) -> None:
        low, high = rows.min(0), rows.max(0)
        open_ = np.flatnonzero(high > low)
        if depth == DEEPEST or len(rows) < 2 or not len(open_):
            rest[place] = depth + float(average_path(len(rows)))
            return
        f = rng.choice(open_)
        at = rng.uniform(low[f], high[f])
        below = rows[:, f] <= at
        feature[place], cut[place], left[place] = int(f), float(at), len(feature)
        for _ in range(2):
            new_node()
        child = left[place]
        grow(child, rows[below], depth + 1)
        grow(child + 1, rows[~below], depth + 1)

    grow(new_node(), x, 0)
    return feature, cut, left, rest


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > REPEAT_PERCENT * s["n_words"])


def _statistics_of(column: pa.Array):
    for at, run in text_chunks(column):
        s = statistics(run)
        yield at, len(run), s, features(s)


def _labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, y), one row of each labelled doc_id."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    return rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("y"))


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(y, text) of up to ``bound`` labelled documents, chosen by a hash of their ids, to look at.
    ``fit`` takes all of them."""
    some = F.broadcast(_labelled(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))  # bound rows
    return one_text(docs.select(F.col("doc_id").cast("long"), "text").join(some, "doc_id")).select("y", "text")


def labelled_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, y, x) of every labelled document that passes the base rules, one text of each doc_id,
    the one ``one_text`` takes. Texts do not travel, their features do."""

    def run(batches):
        for batch in batches:
            for at, n, s, x in _statistics_of(batch.column(3)):
                held = [batch.column(i).slice(at, n) for i in range(3)]
                x = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [*held, pa.array(~base_failed(s)), x], names=["doc_id", "hash", "sha", "fine", "x"]
                )

    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), F.sha2(F.col("text"), 256).alias("sha"), "text"
    )
    rows = rows.mapInArrow(run, "doc_id long, hash long, sha string, fine boolean, x array<double>")
    one = F.min_by(F.struct("fine", "x"), F.struct("hash", "sha")).alias("one")
    return rows.join(_labelled(labels), "doc_id").groupBy("doc_id", "y").agg(one).where("one.fine").select(
        "doc_id", "y", "one.x"
    )


def quantiles(values: DataFrame, shares: tuple[float, ...], higher: bool = False) -> dict[int, list[float]]:
    """Exact quantiles of ``v`` for each ``f``, interpolated or the next higher value.

    Different values are put in order over all partitions; their sizes tell in which of them a
    quantile lies, and only those are counted through.
    """
    counted = values.groupBy("f", "v").agg(F.count("*").alias("n"))
    ordered = counted.repartitionByRange("f", "v").withColumn("part", F.spark_partition_id())
    ordered = stored(ordered, "ordered-values")
    sizes: dict[int, list] = {}
    for r in ordered.groupBy("f", "part").agg(F.sum("n").alias("n")).orderBy("f", "part").collect():
        sizes.setdefault(r["f"], []).append((r["part"], r["n"]))
    wanted = set()
    for f, parts in sizes.items():
        ends = np.cumsum([n for _, n in parts])
        for share in shares:
            for rank in {math.floor(share * (ends[-1] - 1)), math.ceil(share * (ends[-1] - 1))}:
                i = int(np.searchsorted(ends, rank, side="right"))
                wanted.add((f, parts[i][0], rank, rank - int(ends[i] - parts[i][1])))
    if not wanted:
        return {}
    listed = values.sparkSession.createDataFrame(sorted(wanted), "f int, part int, rank long, nth long")
    before = Window.partitionBy("f", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    places = F.broadcast(listed.select("f", "part").distinct())  # two for each quantile
    inside = ordered.join(places, ["f", "part"]).withColumn("least", F.coalesce(F.sum("n").over(before), F.lit(0)))
    found = inside.join(F.broadcast(listed), ["f", "part"]).where("nth >= least AND nth < least + n")
    value = {(r["f"], r["rank"]): r["v"] for r in found.select("f", "rank", "v").collect()}
    got: dict[int, list[float]] = {}
    for f, parts in sizes.items():
        last = sum(n for _, n in parts) - 1
        for share in shares:
            low, high = math.floor(share * last), math.ceil(share * last)
            pair = [value[f, low], value[f, high]]
            got.setdefault(f, []).append(pair[1] if higher else float(np.quantile(pair, share * last - low)))
    return got


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _deal(rows: DataFrame, ranges: Ranges, times: int) -> DataFrame:
    """(tree, x): the excesses of each row for ``times`` trees, those with the least hashes."""
    salts = odd_constants(TREES, SEED)

    def run(batches):
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), ranges.excess(_matrix(batch.column(1)))
            hashed = mix(mix(ids.astype(np.int64).view(U64))[:, None] ^ salts)
            trees = np.argpartition(hashed, times - 1, axis=1)[:, :times].astype(np.int32)
            dealt = np.repeat(x, times, axis=0)
            dealt = pa.FixedSizeListArray.from_arrays(pa.array(dealt.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(trees.ravel()), dealt], names=["tree", "x"])

    return rows.select("doc_id", "x").mapInArrow(run, "tree int, x array<double>")


def _grow(table: pa.Table) -> pa.Table:
    """One tree of its rows and the anchors."""
    table = table.combine_chunks()
    tree, x = table["tree"][0].as_py(), _matrix(table["x"].chunk(0))
    x = x[np.lexsort(x.T)]  # the order of rows is not fixed, the forest shall be
    # a kind of anomaly that the documents lack would never be cut
    anchors = np.repeat(np.eye(x.shape[1]) * FARTHEST, ANCHORS * max(1, len(x) // SAMPLE), axis=0)
    nodes = grown(np.r_[x, anchors], np.random.default_rng([SEED, tree]))
    columns = {"tree": [tree], "n": [len(x) + len(anchors)], **{c: [v] for c, v in zip(NODES, nodes)}}
    types = [pa.int32(), pa.int64(), *map(pa.list_, (pa.int32(), pa.float64(), pa.int32(), pa.float64()))]
    return pa.table([pa.array(v, t) for v, t in zip(columns.values(), types)], names=list(columns))


NODES = ("feature", "cut", "left", "rest")
TREE_SCHEMA = "tree int, n long, feature array<int>, cut array<double>, left array<int>, rest array<double>"


def fit(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """A forest and its threshold from every labelled document, or None where none passes the base
    rules."""
    rows = stored(labelled_features(docs, labels), "labelled-features")
    n, n_good = rows.agg(F.count("*"), F.count_if(F.col("y") == 1)).first()
    if not n:
        return None
    good = rows.where("y = 1") if n_good else rows
    ends = quantiles(good.select(F.posexplode("x").alias("f", "v")), (OUTER, 0.5, 1 - OUTER))
    ranges = Ranges(*np.array([ends[f] for f in sorted(ends)]).T)
    times = min(TREES, math.ceil(TREES * SAMPLE / n))
    trees = _deal(rows, ranges, times).groupBy("tree").applyInArrow(_grow, TREE_SCHEMA)
    trees = sorted(trees.collect())  # TREES, of bounded depth
    forest = Forest.of([t[2:] for t in trees], float(np.mean([t["n"] for t in trees])), ranges)

    def score(batches):
        for batch in batches:
            v = forest.scores(ranges.excess(_matrix(batch.column(0))))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(v), np.int32)), pa.array(v)], names=["f", "v"])

    scores = good.select("x").mapInArrow(score, "f int, v double")
    forest.threshold = quantiles(scores, (1 - GOOD_LOST,), higher=True)[0][0]
    return forest


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, anomaly double, kept boolean"
)


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """Base counts, base_failed, the anomaly score and kept, for every row of (doc_id, text).

    Null, empty and blank texts have no words and fail the base rules. Without a forest the
    score is 0, and the base rules alone decide. Every row is judged by itself.
    """

    def run(batches):
        for batch in batches:
            for at, n, s, x in _statistics_of(batch.column(1)):
                failed = base_failed(s)
                score = forest.scores(forest.ranges.excess(x)) if forest else np.zeros(n)
                kept = ~failed & (score <= (forest.threshold if forest else 1.0))
                out = [batch.column(0).slice(at, n), *[pa.array(s[c], pa.int64()) for c in BASE]]
                out += [pa.array(failed), pa.array(score), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", *BASE, "base_failed", "anomaly", "kept"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)

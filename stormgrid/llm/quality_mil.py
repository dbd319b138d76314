"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded (statistics of its words through a
learnt layer), a gated attention gives it a weight, and the weighted sum of the encodings is
scored. All layers learn together from document labels of a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stormgrid.llm.components import one_text
from stormgrid.llm.rules import CHARACTER, DIGIT, EXCLAIM, PUNCTUATION, SYMBOL, UPPER, repeated_words
from stormgrid.llm.textvec import split_words, text_chunks

LABELLED_PER_CLASS = 2500  # bound of the labelled sample
FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.3
PASSAGE_WORDS = 64
ENCODED, GATE = 16, 8
ROUNDS, RATE, DECAY = 500, 0.02, 1e-4
PIPE = np.arange(256) == ord("|")
HIGH = np.arange(256) >= 0xC0
FEATURES = 13


def passages(run: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a run of texts, and where each text's passages begin. A text
    without words has one passage, without anything in it."""
    words = split_words(run)
    hashed = words.hashes(lower=False)
    counts = words.counts()
    number = np.maximum(-(-counts // PASSAGE_WORDS), 1)
    begin = np.r_[0, np.cumsum(number)]
    data = words.data
    length = (words.end - words.start).astype(float)
    chars = words.word_totals(CHARACTER[data]).astype(float)
    again = np.zeros(len(hashed), bool)
    again[1:] = hashed[1:] == hashed[:-1]
    within = np.arange(len(hashed)) - np.repeat(words.first[:-1], counts)
    again[within == 0] = False
    place = np.repeat(begin[:-1], counts) + within // PASSAGE_WORDS
    add = lambda v: np.bincount(place, v, minlength=begin[-1])
    n, c = add(np.ones(len(hashed))), add(chars)
    per_word, per_char = np.maximum(n, 1), np.maximum(c, 1)
    key = np.unique(np.stack([place.astype(np.uint64), hashed]), axis=1)[0] if len(hashed) else np.zeros(0)
    distinct = np.bincount(key.astype(np.int64), minlength=begin[-1])
    shares = [add(words.word_totals(table[data])) / per_char for table in (SYMBOL, UPPER, DIGIT, PUNCTUATION, EXCLAIM, PIPE, HIGH)]
    x = np.column_stack(
        [
            *shares,
            c / per_word / 10,
            add((chars <= 3).astype(float)) / per_word,
            distinct / per_word,
            add(again.astype(float)) / per_word,
            add(repeated_words(words, hashed).astype(float)) / per_word,
            np.log1p(n) / 5 + 0 * add(length),
        ]
    )
    return x, begin


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass
class Network:
    """Scale of the features and the weights of all layers; of fixed size."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = (x - self.mean) / self.spread
        h = np.tanh(x @ w["encode"] + w["encode0"])
        value, gate = np.tanh(h @ w["value"]), sigmoid(h @ w["gate"])
        energy = (value * gate) @ w["attend"]
        bag = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        top = np.maximum.reduceat(energy, begin[:-1])
        raw = np.exp(energy - top[bag])
        share = raw / np.add.reduceat(raw, begin[:-1])[bag]
        z = np.add.reduceat(share[:, None] * h, begin[:-1])
        p = sigmoid(z @ w["score"] + w["score0"])
        return {"x": x, "h": h, "value": value, "gate": gate, "share": share, "bag": bag, "z": z, "p": p}

    def gradients(self, f: dict, begin: np.ndarray, y: np.ndarray, cost: np.ndarray) -> dict[str, np.ndarray]:
        w, bag = self.weights, f["bag"]
        d_logit = (f["p"] - y) * cost / cost.sum()
        d_z = d_logit[:, None] * w["score"]
        d_share = (f["h"] * d_z[bag]).sum(1)
        mean = np.add.reduceat(f["share"] * d_share, begin[:-1])
        d_energy = f["share"] * (d_share - mean[bag])
        d_both = d_energy[:, None] * w["attend"]
        d_value = d_both * f["gate"] * (1 - f["value"] ** 2)
        d_gate = d_both * f["value"] * f["gate"] * (1 - f["gate"])
        d_h = f["share"][:, None] * d_z[bag] + d_value @ w["value"].T + d_gate @ w["gate"].T
        d_h *= 1 - f["h"] ** 2
        return {
            "score": f["z"].T @ d_logit,
            "score0": d_logit.sum(keepdims=True),
            "attend": (f["value"] * f["gate"]).T @ d_energy,
            "value": f["h"].T @ d_value,
            "gate": f["h"].T @ d_gate,
            "encode": f["x"].T @ d_h,
            "encode0": d_h.sum(0),
        }


def train(x: np.ndarray, begin: np.ndarray, y: np.ndarray, prior: float, seed: int = 9) -> Network:
    """Full-batch Adam; classes weighted to their true shares."""
    rng = np.random.default_rng(seed)
    shape = {"encode": (FEATURES, ENCODED), "value": (ENCODED, GATE), "gate": (ENCODED, GATE)}
    weights = {n: rng.normal(0, s[0] ** -0.5, s) for n, s in shape.items()}
    weights |= {"encode0": np.zeros(ENCODED), "attend": rng.normal(0, GATE**-0.5, GATE)}
    weights |= {"score": rng.normal(0, ENCODED**-0.5, ENCODED), "score0": np.zeros(1)}
    net = Network(x.mean(0), x.std(0) + 1e-3, weights)
    cost = np.where(y == 1, prior / max((y == 1).mean(), 1e-9), (1 - prior) / max((y == 0).mean(), 1e-9))
    first, second = ({n: np.zeros_like(v) for n, v in weights.items()} for _ in range(2))
    for step in range(1, ROUNDS + 1):
        grads = net.gradients(net.forward(x, begin), begin, y, cost)
        for n, g in grads.items():
            g = g + DECAY * weights[n]
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.999 * second[n] + 0.001 * g * g
            weights[n] -= RATE * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = LABELLED_PER_CLASS) -> Network | float:
    """A network, or the labels' share of good ones where they show only one class or none (a
    half then). Learns from up to ``per_class`` documents of each class, chosen by a hash, whose
    labels may be learnt."""
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("y"))
    )
    prior = rows.agg(F.avg("y")).first()[0]
    order = F.xxhash64("doc_id")
    some = [rows.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    sample = F.broadcast(some[0].unionByName(some[1]))  # at most 2 * per_class rows

    def run(batches):
        for batch in batches:
            for at, texts in text_chunks(batch.column(2)):
                x, begin = passages(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        batch.column(1).slice(at, len(texts)),
                        pa.array([x[a:b].ravel() for a, b in zip(begin[:-1], begin[1:])], pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "y", "x"],
                )

    texts = one_text(docs.select(F.col("doc_id").cast("long"), "text").join(sample, "doc_id")).select("doc_id", "y", "text")
    bags = texts.mapInArrow(run, "doc_id long, y int, x array<double>").toPandas()  # bounded by the sample
    if len(set(bags["y"])) < 2:
        return 0.5 if prior is None else float(prior)
    # rows arrive in any order, and sums shall not depend on it
    bags = bags.assign(n=bags["x"].map(len), s=bags["x"].map(np.sum)).sort_values(["doc_id", "y", "n", "s"])
    begin = np.r_[0, np.cumsum([len(b) // FEATURES for b in bags["x"]])]
    x = np.concatenate(list(bags["x"])).reshape(-1, FEATURES)
    return train(x, begin, bags["y"].to_numpy(), float(prior))


def score(docs: DataFrame, net: Network | float) -> DataFrame:
    """doc_id, held_out, score, predicted and n_passages of every row of (doc_id, text).

    Null, empty and blank texts are one empty passage and get its score. Rows are scored by
    their text alone, so repeated texts get equal scores.
    """

    def run(batches):
        for batch in batches:
            for at, texts in text_chunks(batch.column(1)):
                x, begin = passages(texts)
                p = net.forward(x, begin)["p"] if isinstance(net, Network) else np.full(len(texts), net)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(p), pa.array(np.diff(begin), pa.int64())],
                    names=["doc_id", "score", "n_passages"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, n_passages long")
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_passages",
    )

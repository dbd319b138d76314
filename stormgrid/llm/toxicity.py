"""Toxicity of disguised text: a noisy-channel decoder restores it, then a lexicon scores it.

A character language model (trigrams over 26 letters, other letters and a word bound) is counted
over all documents. Text that may be disguised is a lattice: a digit or symbol may stand for
letters that look like it or for itself, a letter repeated three times and more for one or two,
and single letters set apart for one word. Symbols that may as well be punctuation and doubled letters
give a second reading, which counts besides the text as it stands. The best path under channel costs and language model
(Viterbi, a state being the last two characters) is the restored text; where a text offers no
choice the lattice has one path, and nothing is computed.

The lexicon is learnt from a bounded sample of labelled rows: for each word and word beginning,
in how many toxic and other documents it occurs; a beginning counts if it stands for several
words. A document's evidence is its three strongest words, turned into a probability by a
logistic curve fitted on the same sample, each toxic document judged without its own counts; the
same fit tells how telling a word must be to count.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stormgrid.llm.components import few_parts, one_text, stored, unused
from stormgrid.llm.textvec import release, text_chunks

LABELLED_PER_CLASS = 4000  # bound of the labelled sample
FOLDS, HELD_OUT_FOLD = 3, 1
THRESHOLD = 0.7
SYMBOLS = 28  # word bound, a to z, any other letter
OTHER_LETTER = 27
STEMS = (4, 5, 6)  # lengths of word beginnings that count besides the word
SMOOTHING = 2.0
LEAST_WEIGHT = 1.0
LEAST_WEIGHTS = (1.0, 1.5, 2.0, 2.5, 3.0)  # of these, the sample tells from which on a word is evidence
STRONGEST = 3
ONE_WORD = 1.2  # a beginning seen in no more toxic documents than so often its commonest word is dropped
LONG_WORD = 40  # characters from which a word is learnt by its digest
ORDINARY = 100_000  # distinct tokens that a worker remembers to need no decoder, and words whose weights it does
SETTLED = 4096  # steps after which the part of a path that is decided is written out
RIDGE = 0.05

# FIXED VALUES: the letters that a digit or symbol may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
STAND_IN, LITERAL, COLLAPSE, JOIN, APART = 1.0, 8.0, 0.7, 0.2, 4.0  # channel costs, in nats

# a digit, @ or $ beside a letter; other symbols between letters; a letter three times
DISGUISED = re.compile(
    r"[^\W\d_][0-9@$€]|[0-9@$€][^\W\d_]|[^\W\d_][!|+(]+[^\W\d_]|([^\W\d_])\1\1", re.IGNORECASE
)
# symbols at a word's edge, where they may be punctuation; three letters doubled, as common words have too
DOUBTFUL = re.compile(
    r"[!|+(][^\W\d_]|[^\W\d_][!|+(]|([^\W\d_])\1\w*?([^\W\d_])\2\w*?([^\W\d_])\3", re.IGNORECASE
)
# three and more single letters or stand-ins, set apart by blanks, line ends, signs or any mix of them
SINGLE = r"(?:[^\W_]|[@$€!|+(])"
BETWEEN = r"(?:[^\w@$€!|+(]|_)+"
SPACED = re.compile(rf"(?<![\w@$€!|+]){SINGLE}(?:{BETWEEN}{SINGLE}){{2,}}(?![^\W_]|[@$€])")
GAP = re.compile(BETWEEN)
TOKEN = re.compile(r"[\w@$€!|+(]+")
EDGES = re.compile(r"^[!|+(]+|[!|+(]+$")
RUN = re.compile(r"(.)\1+")
DOUBLED = 3  # doubled characters from which a token may be doubled throughout
WORD = re.compile(r"[^\W\d_]+")


def _letter_codes() -> np.ndarray:
    codes = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        if chr(c).isalpha():
            codes[c] = OTHER_LETTER
    for i in range(26):
        codes[[ord("a") + i, ord("A") + i]] = i + 1
    return codes


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    return _letter_codes()


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n) over all texts: every task counts its own, at most 28 cubed figures, and the
    figures are summed."""

    def run(batches):
        codes, total = letter_codes(), np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for _, texts in text_chunks(batch.column(0)):
                joined = "\n\n".join(texts.to_pylist())
                points = np.frombuffer(f"\n\n{joined}\n\n".encode("utf-32-le", "replace"), np.uint32)
                c = codes[points]
                total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=SYMBOLS**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["gram", "n"])

    counted = docs.select("text").mapInArrow(run, "gram int, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(grams: list[int], counts: list[int]) -> np.ndarray:
    """log P(c | a b), interpolated down to single characters."""
    n3 = np.zeros(SYMBOLS**3)
    n3[grams] = counts
    n3 = n3.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    n2 = n3.sum(0)
    p1 = (n2.sum(0) + 1) / (n2.sum() + SYMBOLS)
    p2 = (n2 + 5 * p1) / (n2.sum(1, keepdims=True) + 5)
    p3 = (n3 + 5 * p2[None]) / (n3.sum(2, keepdims=True) + 5)
    return np.log(p3)


class Decoder:
    """Restores disguised text under a language model."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp.tolist()
        self.short = lru_cache(maxsize=50_000)(self.token)
        self.ordinary: set[str] = set()

    @staticmethod
    def code(c: str) -> int:
        if "a" <= c <= "z":
            return ord(c) - 96
        return OTHER_LETTER if c.isalpha() else 0

    def lattice(self, token: str, spaced: bool = False, doubled: bool = False) -> list[list[tuple[str, float]]]:
        """Choices of output with their cost, one list for each run of equal characters."""
        steps, i, token = [], 0, token.lower()
        while i < len(token):
            c, j = token[i], i + 1
            if spaced and (gap := GAP.match(token, i)):
                steps.append([("", JOIN), (gap[0], APART)])
                i = gap.end()
                continue
            while j < len(token) and token[j] == c:
                j += 1
            run = j - i
            if c.isalpha():
                choices = [(c * run, 0.0)] if run < 3 else [(c, COLLAPSE), (c * 2, COLLAPSE)]
                if doubled:
                    choices = [(c, 0.0)]
            elif c in LOOKS_LIKE:
                choices = [(c * run, LITERAL * run)]
                for letter in LOOKS_LIKE[c]:
                    choices.append((letter * min(run, 2), STAND_IN * run))
                    if run > 1:
                        choices.append((letter, STAND_IN * run + COLLAPSE))
            else:
                choices = [(c * run, 0.0)]
            steps.append(choices)
            i = j
        return steps

    def best_path(self, steps: list[list[tuple[str, float]]]) -> str:
        """The cheapest path of the lattice, exactly: all states are kept, which are at most the
        pairs of characters. A part that all of them share is written out as it goes."""
        costs, back, out, limit = {(0, 0): 0.0}, [], [], SETTLED
        for choices in [*steps, [("\n", 0.0)]]:
            after: dict[tuple[int, int], float] = {}
            came: dict[tuple[int, int], tuple[tuple[int, int], str]] = {}
            for state, cost in costs.items():
                for letters, price in choices:
                    total = cost + price
                    x, y = state
                    for c in letters:
                        z = self.code(c)
                        total -= self.logp[x][y][z]
                        x, y = y, z
                    if total < after.get((x, y), math.inf):
                        after[x, y], came[x, y] = total, (state, letters)
            costs = after
            back.append(came)
            if len(back) >= limit:
                back = self.settle(back, set(costs), out)
                limit = max(SETTLED, 2 * len(back))
        self.settle(back, {min(costs, key=lambda s: (costs[s], s))}, out)
        return "".join(out)[:-1]

    @staticmethod
    def settle(back: list[dict], ends: set, out: list[str]) -> list[dict]:
        """Writes the steps that the paths to all ``ends`` have in common, and returns the rest."""
        k = len(back)
        while k and len(ends) > 1:
            k -= 1
            ends = {back[k][e][0] for e in ends}
        found = []
        for step in reversed(back[:k] if len(ends) == 1 else []):
            (end,) = ends
            before, letters = step[end]
            found.append(letters)
            ends = {before}
        out += reversed(found)
        return back[len(found) :]

    def token(self, token: str) -> tuple[str, str]:
        """(restored, other readings). Symbols at the edges stay in the restored text."""
        core, others = EDGES.sub("", token), []
        if core != token and WORD.search(core):
            others.append(self.best_path(self.lattice(token)))
        if len(RUN.findall(token)) >= DOUBLED:
            others.append(self.best_path(self.lattice(core, doubled=True)))
        if not DISGUISED.search(core):
            return token, " ".join(others)
        at = token.index(core)
        return token[:at] + self.best_path(self.lattice(core)) + token[at + len(core) :], " ".join(others)

    def both(self, text: str) -> tuple[str, str]:
        """The text with its disguised tokens restored in lower case, other text as it is; and
        further readings of what may be disguised or not."""
        others: list[str] = []

        def spaced(found: re.Match) -> str:
            kinds = set(GAP.sub("", found[0]))
            if len(kinds) < 2:
                return found[0]  # a a a a: repeated words, not one that is spelt out
            read = self.best_path(self.lattice(found[0], spaced=True))
            if len(kinds) > 2 and any(map(str.isalpha, kinds)):
                return read
            others.append(GAP.sub("", read))
            return found[0]

        text = SPACED.sub(spaced, text)
        read: dict[str, str] = {}
        for t in self.disguised(text):
            read[t], other = self.short(t) if len(t) <= LONG_WORD else self.token(t)
            if other:
                others.append(other)
        if any(t != r for t, r in read.items()):
            text = TOKEN.sub(lambda found: read.get(found[0], found[0]), text)
        return text, " ".join(others)

    def disguised(self, text: str) -> list[str]:
        """The distinct tokens that may be disguised, in order. Ordinary ones are remembered, so
        that each is looked at once."""
        new = set(TOKEN.findall(text)) - self.ordinary
        found = {t for t in new if DISGUISED.search(t) or DOUBTFUL.search(t)}
        if len(self.ordinary) > ORDINARY:
            self.ordinary.clear()
        self.ordinary.update(t for t in new if len(t) <= LONG_WORD and t not in found)
        return sorted(found)

    def restore(self, text: str) -> str:
        return self.both(text)[0]

    def readings(self, text: str) -> str:
        """The restored text and, on a line after it, the other readings."""
        return "\n".join(self.both(text))


def signs(text: str) -> set[str]:
    """Distinct words of a restored text."""
    return set(WORD.findall(text.lower()))


def features(word: str) -> list[str]:
    """A word, or the digest of a long one, and its beginnings; the latter end in a star."""
    name = word if len(word) < LONG_WORD else "#" + hashlib.md5(word.encode("utf-8", "replace")).hexdigest()
    return [name, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def shaped(evidence: list[float]) -> list[float]:
    """Weights, ascending, as the curve takes them: the strongest squared, for one sure word says
    more than some chance ones of the same sum."""
    return [*evidence[:-1], evidence[-1] ** 2]


@dataclass
class Model:
    """Everything a score depends on; bounded by the alphabet and the labelled sample."""

    logp: np.ndarray
    toxic: dict[str, int] = field(default_factory=dict)
    clean: dict[str, int] = field(default_factory=dict)
    n_toxic: int = 0
    n_clean: int = 0
    least: float = LEAST_WEIGHT
    slopes: list[float] = field(default_factory=lambda: [0.0] * STRONGEST)
    offset: float = 0.0


class Scorer:
    def __init__(self, model: Model):
        self.model, self.decoder = model, Decoder(model.logp)
        self.weights = {f: self.weight(f, 0) for f in model.toxic}
        self.known: dict[str, float] = {}

    def weight(self, feature: str, own: int) -> float:
        """Log odds of a feature; ``own`` occurrences are left out."""
        m = self.model
        t = m.toxic.get(feature, 0) - own
        c = m.clean.get(feature, 0) * m.n_toxic / max(m.n_clean, 1)
        got = math.log((t + SMOOTHING) / (c + SMOOTHING))
        return got if got >= m.least else 0.0

    def evidence(self, restored: str, own: int = 0) -> list[float]:
        """Weights of the strongest words, ascending."""
        best = [0.0] * STRONGEST
        for word in signs(restored):
            w = self.known.get(word) if not own else None
            if w is None:
                some = [f for f in features(word) if f in self.weights]
                w = max((self.weight(f, own) if own else self.weights[f] for f in some), default=0.0)
                if not own and len(word) < LONG_WORD:
                    if len(self.known) > ORDINARY:
                        self.known.clear()
                    self.known[word] = w
            if w > best[0]:
                best[0] = w
                best.sort()
        return best

    def score(self, restored: str) -> float:
        x = sum(a * w for a, w in zip(self.model.slopes, shaped(self.evidence(restored)))) + self.model.offset
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, per_class: int = LABELLED_PER_CLASS) -> DataFrame:
    """(doc_id, y) of up to ``per_class`` rows of each class, chosen by a hash, from rows whose
    labels may be learnt. A document with both labels counts as the larger one."""
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias("y"))
    )
    order = F.xxhash64("doc_id")
    some = [rows.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class) for y in (0, 1)]
    return some[0].unionByName(some[1])


def _sample_texts(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    sample = F.broadcast(labelled_sample(labels, "toxic", per_class))  # at most 2 * per_class rows
    return one_text(docs.select(F.col("doc_id").cast("long"), "text").join(sample, "doc_id")).select("y", "text")


def _feature_counts(texts: DataFrame, logp: np.ndarray) -> DataFrame:
    def run(batches):
        decoder, counts = Decoder(logp), (Counter(), Counter())
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {f for w in signs(decoder.readings(text or "")) for f in features(w)}
                counts[y].update(found)
                counts[y][""] += 1  # documents
        names = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([c[f] for f in names], pa.int64()) for c in counts]],
            names=["feature", "clean", "toxic"],
        )

    return texts.mapInArrow(run, "feature string, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )


def fit_curve(evidence: np.ndarray, y: np.ndarray, prior: float) -> tuple[list[float], float]:
    """Slopes and offset of the logistic curve, classes weighted to their true shares."""
    share = np.where(y == 1, prior / max((y == 1).mean(), 1e-9), (1 - prior) / max((y == 0).mean(), 1e-9))
    x = np.c_[evidence, np.ones(len(y))]
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (share * (p - y)) + RIDGE * w
        curvature = (x * (share * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.clip(np.linalg.solve(curvature, gradient), -1, 1)
        w = w - step
        w[:-1] = np.maximum(w[:-1], 0.0)  # more evidence never lowers a score
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1].tolist(), float(w[-1])


def losses(evidence: np.ndarray, y: np.ndarray, slopes: list[float], offset: float, prior: float) -> float:
    """Mean log loss of a curve, classes weighted to their true shares."""
    x = np.where(y == 1, -1, 1) * (evidence @ np.array(slopes) + offset)
    each = np.logaddexp(0, x)
    return prior * each[y == 1].mean() + (1 - prior) * each[y == 0].mean()


def calibrate(evidence: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, list[float], float]:
    """The least weight of a word that counts, and the curve over what is left, of the least loss.
    Chance words would lift texts that have some of them, and lower what one sure word says."""
    best = None
    for least in LEAST_WEIGHTS:
        some = np.array([shaped(e) for e in np.where(evidence >= least, evidence, 0.0)])
        slopes, offset = fit_curve(some, y, prior)
        loss = losses(some, y, slopes, offset, prior)
        if best is None or loss < best[0] - 1e-9:
            best = loss, least, slopes, offset
    return best[1:]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = LABELLED_PER_CLASS) -> Model:
    """Language model from all documents, lexicon and curve from a bounded labelled sample."""
    grams = trigram_counts(docs).collect()  # at most 28 cubed rows
    model = Model(language_model([r["gram"] for r in grams], [r["n"] for r in grams]))
    texts = _sample_texts(docs, labels, per_class)
    counts = stored(few_parts(_feature_counts(texts, model.logp), 10 * per_class), "toxic-words")
    totals = counts.where("feature = ''").first()
    if totals is None or not totals["toxic"] or not totals["clean"]:
        n = totals["clean"] + totals["toxic"] if totals else 0
        p = ((totals["toxic"] if totals else 0) + 0.5) / (n + 1)
        model.offset = math.log(p / (1 - p))
        return model
    model.n_toxic, model.n_clean = totals["toxic"], totals["clean"]
    odds = F.log((F.col("toxic") + SMOOTHING) / (F.col("clean") * (model.n_toxic / model.n_clean) + SMOOTHING))
    telling = counts.where("feature <> ''").where(odds >= LEAST_WEIGHT)
    words = counts.where("toxic > 0 AND feature <> '' AND NOT endswith(feature, '*')")
    stems = F.array(*[F.concat(F.substring("feature", 1, n), F.lit("*")) for n in STEMS])
    commonest = words.select(F.explode(stems).alias("feature"), "toxic").groupBy("feature").agg(F.max("toxic").alias("top"))
    kept = telling.join(commonest, "feature", "left").where(
        ~F.col("feature").endswith("*") | (F.col("toxic") > ONE_WORD * F.col("top"))
    )
    for r in kept.collect():  # bounded by the sample
        model.toxic[r["feature"]], model.clean[r["feature"]] = r["toxic"], r["clean"]

    def judged(batches):
        scorer = Scorer(model)
        for batch in batches:
            ys = batch.column(0).to_pylist()
            found = [scorer.evidence(scorer.decoder.readings(t or ""), y) for y, t in zip(ys, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(found, pa.list_(pa.float64()))], names=["y", "e"])

    seen = texts.mapInArrow(judged, "y int, e array<double>").toPandas()  # at most 2 * per_class rows
    usable = labels.where(F.col("toxic").isin(0, 1)).where(~held_out(F.col("doc_id")))
    prior = usable.agg(F.avg("toxic")).first()[0]
    model.least, model.slopes, model.offset = calibrate(np.stack(seen["e"]), seen["y"].to_numpy(), prior)
    return model


def _with_scores(rows: DataFrame, model: Model, restored: bool, name: str = "_score") -> DataFrame:
    """Rows with a score of their last column, the text, and its restored form if asked for."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded, see Model
    new = [name, *["restored"] * restored]
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    schema = ", ".join([*fields, f"{name} double", *["restored string"] * restored])

    def run(batches):
        scorer = _scorer(_Key(shared))
        for batch in batches:
            for at, texts in text_chunks(batch.columns[-1], 1 << 19):
                read = [scorer.decoder.both(t) for t in texts.to_pylist()]
                scores = pa.array(map(scorer.score, map("\n".join, read)), pa.float64())
                out = [*[c.slice(at, len(read)) for c in batch.columns], scores]
                if restored:
                    out.append(pa.array([r for r, _ in read], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, *new])
        release()

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, restored: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted and, if asked for, the restored text of every row.

    Null and empty texts have no evidence and get the curve's value without any. Rows are
    scored one by one, so repeated ids and texts get equal scores.
    """
    rows = _with_scores(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), model, restored)
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
        *["restored"] * restored,
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows below the threshold with all their columns."""
    rest = [c for c in docs.columns if c != "text"]
    name = unused("_score", docs.columns)
    kept = _with_scores(docs.select(*rest, "text"), model, False, name).where(F.col(name) < THRESHOLD)
    return kept.select(*docs.columns)


class _Key:
    def __init__(self, shared):
        self.shared = shared

    def __hash__(self):
        return hash(self.shared._path if hasattr(self.shared, "_path") else id(self.shared))

    def __eq__(self, other):
        return hash(self) == hash(other)


@lru_cache(maxsize=2)
def _scorer(key: _Key) -> Scorer:
    return Scorer(key.shared.value)

"""Byte-level BPE by a tokenization automaton.

The automaton reads tokens. Its paths are exactly the token sequences that merging in rank order
yields, so a byte string has one path through it, and that path is its encoding. It starts as
one state with an arc for every byte. Every merge (u, v) -> w adds a gadget: the state that u
leads to is copied without its arc v, all u arcs are led to the copy, and every state with a u
arc gets an arc w to where v led. A copy is held as its difference (where it was copied from,
which arc it lacks, and at which merge), so that all states of 50,000 merges take a few megabytes.

Texts are split into words as the byte-level pre-tokenizer does, special tokens first. Words are
encoded from left to right: at each of its bytes, exactly one token that ends there is an arc of
the state reached where it starts. All distinct words of a run of texts go through the table
side by side. Decoding emits the arcs' labels.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from stormgrid.llm.textvec import BASE, BASE_INVERSE, BYTE_CODE, U64, mix, powers, release, text_chunks

SPACE, LETTER, NUMBER, OTHER, SPECIAL = range(5)
CHUNK_BYTES = 1 << 19
SIDE_BY_SIDE_BYTES = 32  # longer words are encoded one at a time
SLOTS = 1 << 18
ARC_SLOTS = 1 << 20
LENGTH_SALT = U64(0x9E3779B97F4A7C15)
SPECIAL_SALT = U64(0x632BE59BD9B4E019)


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files: itself for visible
    Latin-1 characters, the following free code points from 256 on for the others."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def character_classes() -> np.ndarray:
    """Space, letter, number or other for every code point."""
    classes = np.full(0x110000, OTHER, np.uint8)
    points = np.r_[0:0xD800, 0xE000:0x110000].astype(np.uint32)
    every = points.tobytes().decode("utf-32-le")
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, every):
            classes[points[found.start() : found.end()]] = kind
    return classes


def hash_bytes(value: bytes) -> np.uint64:
    data = np.frombuffer(value, np.uint8)
    raw = np.sum(BYTE_CODE[data] * powers(BASE, len(data)), dtype=U64, keepdims=True)
    return mix(raw + np.array([len(data)], U64) * LENGTH_SALT)[0]


@dataclass
class Tables:
    """The compiled automaton; its size depends on the vocabulary alone."""

    labels: list[bytes]
    special: dict[str, int]
    made: np.ndarray  # of a token: the merge that made it, -1 for bytes
    left: np.ndarray  # of a token: the left part of that merge
    leads: np.ndarray  # of a token: the state its arcs lead to
    came: list[int] = field(default_factory=lambda: [0])  # of a state: where it was copied from
    lacks: list[int] = field(default_factory=lambda: [-1])  # of a state: the arc left out
    born: list[int] = field(default_factory=lambda: [-1])  # of a state: at which merge
    classes: np.ndarray | None = None


def has_arc(t: Tables, state: int, token: int) -> bool:
    """Whether a state has an arc for a token, from the differences."""
    while True:
        made = t.made[token]
        while t.born[state] > made:  # copied after the token's arcs were added
            if t.lacks[state] == token:
                return False
            state = t.came[state]
        if made < 0:
            return True
        token = t.left[token]  # the arc was added where there was one for the left part


def compile_tables(path: str) -> Tables:
    """Read a tokenizer file and add the gadgets of its merges one after the other."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    names = byte_names()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {
        bytes(names[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special
    }
    labels = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for label, i in [*ids.items(), *[(s.encode(), i) for s, i in special.items()]]:
        labels[i] = label
    n = len(labels)
    t = Tables(labels, special, [-1] * n, [-1] * n, [0] * n)
    for at, pair in enumerate(spec["model"]["merges"]):
        first, second = (bytes(names[c] for c in p) for p in (pair.split(" ") if isinstance(pair, str) else pair))
        u, v, w = ids[first], ids[second], ids[first + second]
        before = t.leads[u]
        if t.made[w] >= 0 or not has_arc(t, before, v):
            continue  # the two never stand side by side, or an earlier merge made the token
        t.made[w], t.left[w], t.leads[w] = at, u, t.leads[v]
        t.came.append(before)
        t.lacks.append(v)
        t.born.append(at)
        t.leads[u] = len(t.came) - 1
    t.classes = character_classes()
    return t


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places start, start + 1, ... of each piece, piece after piece."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


class Automaton:
    """Tables in the form in which words are looked up."""

    def __init__(self, t: Tables):
        self.t = t
        self.ids = {label: i for i, label in enumerate(t.labels) if label}
        for name in t.special:
            self.ids.pop(name.encode(), None)
        self.longest = max(map(len, self.ids), default=1)
        self.made, self.left, self.leads = (np.array(x, np.int64) for x in (t.made, t.left, t.leads))
        self.born = np.array(t.born, np.int64)
        self._number_states()
        self._hash_tokens()
        self.arc_cache = np.full(ARC_SLOTS, -1, np.int64)
        lengths = np.array([len(x) for x in t.labels], np.int64)
        self.label_start, self.label_length = np.cumsum(lengths) - lengths, lengths
        self.label_bytes = np.frombuffer(b"".join(t.labels), np.uint8)
        width = len(str(len(t.labels))) + 1
        decimal = "".join(f"{i},".ljust(width, "\0") for i in range(len(t.labels)))
        self.decimal = np.frombuffer(decimal.encode(), np.uint8).reshape(-1, width)
        self.special_find = regex.compile("|".join(map(regex.escape, sorted(t.special, key=len, reverse=True))))
        self.special_hash = {int(hash_bytes(s.encode()) ^ SPECIAL_SALT): i for s, i in t.special.items()}

    def _number_states(self) -> None:
        """States are a tree of copies: number it so that a subtree is a range. A path from the
        root lacks an arc at most once, so the subtrees that lack one token are disjoint, and
        the one that may hold a state is found by search."""
        came, n = self.t.came, len(self.t.came)
        size = [1] * n
        for s in range(n - 1, 0, -1):
            size[came[s]] += size[s]
        place, free = [0] * n, [1] * n
        for s in range(1, n):
            place[s] = free[came[s]]
            free[came[s]] += size[s]
            free[s] = place[s] + 1
        self.place = np.array(place, np.int64)
        self.upto = self.place + np.array(size, np.int64)
        key = (np.array(self.t.lacks, np.int64) << 32 | self.place)[1:]
        order = np.argsort(key)
        self.lack_key = np.r_[np.int64(-1), key[order]]
        self.lack_state = np.r_[0, order + 1]

    def _hash_tokens(self) -> None:
        self.slot_key = np.zeros(SLOTS + 64, U64)
        self.slot_token = np.full(SLOTS + 64, -1, np.int64)
        self.probes = 1
        for label, i in self.ids.items():
            h = hash_bytes(label)
            at = first = int(h >> U64(46))
            while self.slot_token[at] >= 0:
                at += 1
            self.slot_key[at], self.slot_token[at] = h, i
            self.probes = max(self.probes, at - first + 1)

    def tokens_of(self, hashes: np.ndarray) -> np.ndarray:
        """The token with each hash, -1 for none."""
        slot = (hashes >> U64(46)).astype(np.int64)
        out = np.where(self.slot_key[slot] == hashes, self.slot_token[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.slot_token[slot] >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = slot[open_] + probe
            hit = self.slot_key[at] == hashes[open_]
            out[open_[hit]] = self.slot_token[at[hit]]
            open_ = open_[~hit & (self.slot_token[at] >= 0)]
        return out

    def _arcs_from_differences(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        out = np.ones(len(state), bool)
        rest, limit = np.arange(len(state)), np.full(len(state), np.iinfo(np.int64).max)
        token = token.copy()
        while len(rest):
            place = self.place[state[rest]]
            at = np.searchsorted(self.lack_key, token[rest] << 32 | place, side="right") - 1
            lacking = self.lack_state[at]
            gone = (
                (self.lack_key[at] >> 32 == token[rest])
                & (place < self.upto[lacking])
                & (self.born[lacking] <= limit[rest])
            )
            out[rest[gone]] = False
            rest = rest[~gone & (self.made[token[rest]] >= 0)]
            limit[rest] = self.made[token[rest]]
            token[rest] = self.left[token[rest]]
        return out

    def arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each state has an arc for its token; the table entries used last are kept."""
        key = state << 20 | token
        slot = (key.astype(U64) * LENGTH_SALT >> U64(44)).astype(np.int64)
        held = self.arc_cache[slot]
        out = (held & 1).astype(bool)
        miss = np.flatnonzero(held >> 1 != key)
        if len(miss):
            out[miss] = self._arcs_from_differences(state[miss], token[miss])
            self.arc_cache[slot[miss]] = key[miss] << 1 | out[miss]
        return out

    def encode_word(self, word: bytes) -> list[int]:
        """One word, however long."""
        t, ids, leads = self.t, self.ids, self.t.leads
        known: dict[tuple[int, int], bool] = {}
        states, last, came = [0], [-1], [0]
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - self.longest), end):
                token = ids.get(word[start:end])
                if token is None:
                    continue
                key = states[start], token
                if key not in known:
                    known[key] = has_arc(t, *key)
                if known[key]:
                    break
            else:
                raise ValueError(f"no token ends at byte {end} of {word[:60]!r}")
            states.append(leads[token])
            last.append(token)
            came.append(start)
        out, end = [], len(word)
        while end:
            out.append(last[end])
            end = came[end]
        return out[::-1]

    def _encode_short(self, data, start, length) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many words side by side: flat ids and how many each word has. Words come
        longest first, so that those still running are a prefix."""
        n, most = len(start), int(length[0]) if len(length) else 0
        data = data[ragged(start, length)]
        start = np.cumsum(length) - length
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(BYTE_CODE[data] * powers(BASE, len(data)), out=sums[1:])
        inverse = powers(BASE_INVERSE, len(data) + 1)
        salts = np.arange(most + 1, dtype=U64) * LENGTH_SALT
        state = np.zeros((n, most + 1), np.int32)
        last = np.full((n, most + 1), -1, np.int32)
        came = np.zeros((n, most + 1), np.int32)
        for end in range(1, most + 1):
            rest = np.arange(int(np.searchsorted(-length, -end, side="right")))
            stop = start + end
            for size in range(min(end, self.longest), 0, -1):
                if not len(rest):
                    break
                begin = stop[rest] - size
                raw = (sums[stop[rest]] - sums[begin]) * inverse[begin]
                token = self.tokens_of(mix(raw + salts[size]))
                some = np.flatnonzero(token >= 0)
                good = some[self.arcs(state[rest[some], end - size].astype(np.int64), token[some])]
                rows, found = rest[good], token[good]
                state[rows, end], last[rows, end], came[rows, end] = self.leads[found], found, end - size
                keep = np.ones(len(rest), bool)
                keep[good] = False
                rest = rest[keep]
            if len(rest):
                raise ValueError("the vocabulary lacks a byte that a text holds")
        counts, at, rows = np.zeros(n, np.int64), length.copy(), np.arange(n)
        steps = []
        while len(rows):
            steps.append((rows, last[rows, at[rows]]))
            counts[rows] += 1
            at[rows] = came[rows, at[rows]]
            rows = rows[at[rows] > 0]
        flat, ends = np.zeros(int(counts.sum()), np.int64), np.cumsum(counts)
        for back, (rows, token) in enumerate(steps):  # the last token of each word first
            flat[ends[rows] - 1 - back] = token
        return flat, counts

    def encode_run(self, run: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a run of texts, and where each text's begin and end in them."""
        offsets = np.frombuffer(run.buffers()[1], np.int64)[run.offset : run.offset + len(run) + 1]
        held = run.buffers()[2]
        data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(run) + 1, np.int64)
        starts, ends, special = self.split(data, offsets - offsets[0])
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(BYTE_CODE[data] * powers(BASE, len(data)), out=sums[1:])
        inverse = powers(BASE_INVERSE, len(data) + 1)
        length = ends - starts
        hashed = mix((sums[ends] - sums[starts]) * inverse[starts] + length.astype(U64) * LENGTH_SALT)
        hashed = np.where(special, hashed ^ SPECIAL_SALT, hashed)
        distinct, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        first_start, first_length = starts[first], length[first]

        counts = np.ones(len(distinct), np.int64)
        single = self.tokens_of(distinct)
        whole = np.flatnonzero(single >= 0)
        single[whole[~self.arcs(np.zeros(len(whole), np.int64), single[whole])]] = -1
        for i in np.flatnonzero(special[first]):
            single[i] = self.special_hash[int(distinct[i])]
        rest = np.flatnonzero(single < 0)
        short = rest[first_length[rest] <= SIDE_BY_SIDE_BYTES]
        short = short[np.argsort(-first_length[short], kind="stable")]
        flat, counts[short] = self._encode_short(data, first_start[short], first_length[short])
        pieces, at = [single, flat], np.arange(len(distinct))
        at[short] = len(single) + np.cumsum(counts[short]) - counts[short]
        filled = len(single) + len(flat)
        for i in rest[first_length[rest] > SIDE_BY_SIDE_BYTES]:
            ids = self.encode_word(data[first_start[i] : first_start[i] + first_length[i]].tobytes())
            pieces.append(np.array(ids, np.int64))
            at[i], counts[i] = filled, len(ids)
            filled += len(ids)
        per_word = counts[which]
        ids = np.concatenate(pieces)[ragged(at[which], per_word)]
        upto = np.r_[0, np.cumsum(per_word)]
        return ids, upto[np.searchsorted(starts, offsets - offsets[0])]

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where words begin and end, and which are special tokens: runs of letters, numbers or
        other characters, each with one blank before it, the contractions 's 't 're 've 'm 'll
        'd, and white space without the last character before a word."""
        text = data.tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        byte_at = np.r_[np.flatnonzero(data & 0xC0 != 0x80), len(data)]
        kind = self.t.classes[points]
        hard = np.zeros(n + 1, bool)
        hard[np.searchsorted(byte_at, offsets)] = True
        if self.t.special:
            texts = np.flatnonzero(hard)
            for a, b in zip(texts[:-1], texts[1:]):
                if any(s in text[a:b] for s in self.t.special):
                    for found in self.special_find.finditer(text[a:b]):
                        kind[a + found.start() : a + found.end()] = SPECIAL
                        hard[a + found.start()] = hard[a + found.end()] = True
        begins = hard.copy()
        begins[1:n] |= kind[1:] != kind[:-1]
        run = np.flatnonzero(begins[:n])
        run_end = np.r_[run[1:], n]
        word_follows = (kind[run] == SPACE) & ~hard[run_end]
        after = run_end[word_follows]
        begins[after - 1] = True
        begins[after[points[after - 1] == 0x20]] = False

        quote = run[(points[run] == 0x27) & (run_end - run == 1) & begins[run] & ~hard[run_end]]
        quote = quote[kind[quote + 1] == LETTER]
        if len(quote):
            one = points[quote + 1]
            two = np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
            two = np.where(hard[np.minimum(quote + 2, n)], 0, two)
            size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
            for pair in ("re", "ve", "ll"):
                size[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
            quote, size = quote[size > 0], size[size > 0]
            begins[quote + 1] = False
            begins[quote + 1 + size] = True
        word = np.flatnonzero(begins[:n])
        start = byte_at[word]
        return start, np.r_[start[1:], len(data)], kind[word] == SPECIAL

    def decoded_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The labels of the ids joined, and where each label begins."""
        lengths = self.label_length[ids]
        return self.label_bytes[ragged(self.label_start[ids], lengths)], np.r_[0, np.cumsum(lengths)]

    def decimal_bytes(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        rows = self.decimal[ids]
        return rows[rows != 0].tobytes()[:-1]

    def decode(self, ids) -> str:
        """The labels of the arcs, as text; bytes that are no UTF-8 become U+FFFD."""
        return self.decoded_bytes(np.asarray(ids, np.int64))[0].tobytes().decode("utf-8", errors="replace")

    def encode(self, text: str) -> list[int]:
        return self.encode_run(next(text_chunks(pa.array([text])))[1])[0].tolist()


@lru_cache(maxsize=2)
def _automaton(held: _Held) -> Automaton:
    return Automaton(held.shared.value)


class _Held:
    """A broadcast known by its vocabulary, so that a worker builds the automaton once."""

    def __init__(self, key: str, shared):
        self.key, self.shared = key, shared

    def __hash__(self):
        return hash(self.key)

    def __eq__(self, other):
        return self.key == other.key


def _shared(spark: SparkSession, path: str) -> _Held:
    tables = compile_tables(path)  # a few megabytes, whatever the input
    return _Held(f"{path} {len(tables.labels)}", spark.sparkContext.broadcast(tables))


def _schema(rows: DataFrame, new: dict[str, str]) -> str:
    old = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return ", ".join([*old, *[f"{n} {t}" for n, t in new.items()]])


def _named(df: DataFrame, names: list[str]) -> list:
    return [df["`" + n.replace("`", "``") + "`"] for n in names]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", digests: bool = False) -> DataFrame:
    """Every row with ``n_tokens`` and its ``ids``. Null and empty texts have no ids.

    With ``digests`` the row has, in place of the text and the ids, ids_sha256 (of the decimal
    ids joined by commas) and decoded_sha256 (of the text that the ids decode to). Other columns
    stay as they are, but one that has the name of a new column gives way to it.
    """
    held = _shared(docs.sparkSession, vocabulary)
    new = {"n_tokens": "long"}
    new |= {"ids_sha256": "string", "decoded_sha256": "string"} if digests else {"ids": "array<int>"}
    keep = [c for c in docs.columns if c not in new and (c != text or not digests)]
    rows = docs.select(*_named(docs, keep), docs[text].cast("string").alias("_bpe_text"))

    def run(batches):
        machine = _automaton(held)
        for batch in batches:
            for at, texts in text_chunks(batch.column(len(keep)), CHUNK_BYTES):
                ids, bound = machine.encode_run(texts)
                out = [c.slice(at, len(texts)) for c in batch.columns[: len(keep)]]
                out.append(pa.array(np.diff(bound), pa.int64()))
                if digests:
                    labels, label_at = machine.decoded_bytes(ids)
                    first, second = [], []
                    for a, b in zip(bound[:-1], bound[1:]):
                        first.append(hashlib.sha256(machine.decimal_bytes(ids[a:b])).hexdigest())
                        spelt = labels[label_at[a] : label_at[b]].tobytes().decode("utf-8", errors="replace")
                        second.append(hashlib.sha256(spelt.encode()).hexdigest())
                    out += [pa.array(first, pa.string()), pa.array(second, pa.string())]
                else:
                    out.append(pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=[*keep, *new])
        release()

    return rows.mapInArrow(run, _schema(rows.drop("_bpe_text"), new))


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """Every row with ``decoded``, the text its ids spell; null ids spell null, no ids the empty
    text. A column of that name gives way to it."""
    held = _shared(encoded.sparkSession, vocabulary)
    keep = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(*_named(encoded, keep))
    place = keep.index(ids)

    def run(batches):
        machine = _automaton(held)
        for batch in batches:
            texts = [None if v.as_py() is None else machine.decode(v.as_py()) for v in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return rows.mapInArrow(run, _schema(rows, {"decoded": "string"}))

"""License scans by conditional compression.

A candidate block is a run of words, across line ends, around words that licenses use. It is
compressed alone and with each template as a raw zstandard dictionary; one that the block repeats
shrinks it most. Templates are taken in the order of the bytes saved. The first of which nearly all
words are there, in order, without a difference in a telling word, is confirmed, together with
those that save nearly as much, among which the exact differences decide. Their words are cut out,
and what is left is ranked again, until no template saves its least share or none is confirmed.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from stormgrid.llm.license_wordings import WORDINGS, full_texts

# FIXED VALUES: short notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that the following conditions are met.",
    "CC0-1.0": "Licensed under CC0 1.0 Universal.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
}
WORD = re.compile(r"[\w.+-]*\w")
LEAST_WORDS = 0.85  # of the template's words that the block has in order
# for each class of templates: the level of compression, and the share of a template's own gain that
# a block must save with it. Copies of all templates among other words, with as many words missing as
# LEAST_WORDS allows, saved 0.18, 0.51 and 0.50 at least
LEVELS, LEAST_REDUCTION = (15, 9, 3), (0.1, 0.35, 0.35)
NEARLY = 0.9  # of the bytes that the first confirmed template saves
LONG_HINTS = 0.02  # of the words of a text of more than SIZES[0] words
SIZES = (32, 512)  # words of templates that are searched in windows of one length, and longer ones
# words in which two licenses of nearly the same wording differ; in long texts digits and "by" tell nothing
TELLING = re.compile(r"\d|^(cc0|by|sa|nc|nd|lesser|affero|mit|apache|mozilla|gnu|by-[a-z-]+)$")
TELLING_LONG = re.compile(r"^(lesser|affero|apache|mozilla|gnu|creative|eclipse)$")


# the name of a license, or several, in a tag that says so
SPDX = re.compile(r"(?i)spdx-license-identifier:[ \t]*((?:[ \t]*(?:[()]|[\w.+-]*[\w.+]))+)")
SPDX_SUFFIX = re.compile(r"(?i)(-only|-or-later|\+)$")
SPDX_WORDS = {"and", "or", "with"}


def wordings() -> list[tuple[str, str]]:
    """(license, wording) of all templates: short notices, headers, grants and full texts."""
    return [*TEMPLATES.items(), *WORDINGS, *full_texts()]


def words(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]


def hint_words(texts: Iterable[str]) -> set[str]:
    """Words so chosen from the texts that they make up more of a short one than may be missing:
    whatever repeats LEAST_WORDS of it holds one. Of a longer text they are LONG_HINTS of its
    words at least. License words come first, then frequent and long ones."""
    chosen: set[str] = set()
    for text in texts:
        counts = Counter(w for w, _, _ in words(text))
        total = sum(counts.values())
        missing = math.floor((1 - LEAST_WORDS if total <= SIZES[0] else LONG_HINTS) * total + 1e-9)
        have = sum(n for w, n in counts.items() if w in chosen)
        for w in sorted(counts, key=lambda w: (not w.startswith("licen"), -counts[w] * (len(w) > 7), -len(w), w)):
            if have > missing:
                break
            if w not in chosen:
                chosen.add(w)
                have += counts[w]
    return chosen


def branches(some: Iterable[str]) -> str:
    """A pattern of words that shares their beginnings."""
    by_first: dict[str, list[str]] = {}
    for w in some:
        by_first.setdefault(w[:1], []).append(w[1:])
    if "" in by_first:
        return ""  # the rest makes no difference
    parts = [(c if c.isalnum() or c in "_-" else f"[{c}]") + branches(rest) for c, rest in sorted(by_first.items())]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def hint(texts: Iterable[str]) -> str:
    """A pattern, for Python and Java alike, that every notice matches."""
    return r"(?iu)\b" + branches({*hint_words(texts), "spdx-license-identifier"})


def windows(text: list[tuple[str, int, int]], hints: set[str], span: int) -> Iterator[tuple[int, int]]:
    """Runs of words, whatever lines they stand on, such that each ``span`` words in a row with a
    hint among them lie whole in one."""
    begin = end = None
    for i, (w, _, _) in enumerate(text):
        if w in hints:
            if begin is not None and i - span > end:
                yield from ((a, min(a + 2 * span, end)) for a in range(begin, max(end - span, begin + 1), span))
                begin = None
            begin, end = max(0, i - span) if begin is None else begin, min(len(text), i + span + 1)
    if begin is not None:
        yield from ((a, min(a + 2 * span, end)) for a in range(begin, max(end - span, begin + 1), span))


def places(have: np.ndarray, want: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(words lost and added, first, last) of the runs of ``have`` nearest to ``want``, for each
    first word the nearest of at most ``most`` differences."""
    at = np.arange(len(have) + 1)
    cost, start = np.zeros(len(at), np.int64), at
    for word in want:
        down = cost + 1  # the word is lost
        same = np.r_[False, have == word]
        come = np.r_[down[:1], cost[:-1]]
        take = same & (come < down)
        cost, start = np.where(take, come, down), np.where(take, np.r_[start[:1], start[:-1]], start)
        ahead = cost - at  # further words are added
        low = np.minimum.accumulate(ahead)
        source = np.maximum.accumulate(np.where(ahead == low, at, 0))
        cost, start = low + at, start[source]
    best: dict[int, tuple[int, int]] = {}
    for end in np.flatnonzero(cost <= most).tolist():
        found = int(cost[end]), end
        best[int(start[end])] = min(best.get(int(start[end]), found), found)
    return sorted((d, a, b) for a, (d, b) in best.items() if b > a)


class Scanner:
    def __init__(self, templates: Iterable[tuple[str, str]]):
        self.templates = [(name, t) for name, t in templates if words(t)]
        self.words = [[w for w, _, _ in words(t)] for _, t in self.templates]
        numbers: dict[str, int] = {}
        self.numbers = numbers
        self.coded = [np.array([numbers.setdefault(w, len(numbers)) for w in ws]) for ws in self.words]
        self.distinct, self.counts = zip(*[np.unique(c, return_counts=True) for c in self.coded])
        bounds = [0, *SIZES, math.inf]
        self.classes = [
            [i for i, w in enumerate(self.words) if a < len(w) <= b] for a, b in zip(bounds, bounds[1:])
        ]
        self.plain = [self.compressor(level) for level in LEVELS[: len(self.classes)]]
        self.kind = {i: k for k, among in enumerate(self.classes) for i in among}
        self.given, self.gain = [], []
        for i, w in enumerate(self.words):
            data, k = " ".join(w).encode("utf-8", "replace"), self.kind[i]
            dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVELS[k])
            self.given.append(self.compressor(LEVELS[k], dictionary))
            self.gain.append(max(len(self.plain[k].compress(data)) - len(self.given[-1].compress(data)), 1))
        self.hints = [hint_words(self.templates[i][1] for i in among) for among in self.classes]

    @staticmethod
    def compressor(level: int, given: zstandard.ZstdCompressionDict | None = None) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=level, write_content_size=False, write_dict_id=False, dict_data=given)

    def reductions(self, block: list[str], among: list[int]) -> list[tuple[int, int]]:
        """(bytes, template) that a block saves with each template as dictionary, most first."""
        data = " ".join(block).encode("utf-8", "replace")
        alone: dict[int, int] = {}
        out = []
        for i in among:
            k = self.kind[i]
            if k not in alone:
                alone[k] = len(self.plain[k].compress(data))
            out.append((alone[k] - len(self.given[i].compress(data)), i))
        return sorted(out, key=lambda r: (-r[0], r[1]))

    def held(self, coded: np.ndarray, among: list[int]) -> list[int]:
        """The templates of which a block has enough words in any order. Only what cannot be confirmed
        is left out: words in common in order are no more than those in any order."""
        there = np.bincount(coded[coded >= 0], minlength=len(self.numbers))
        return [i for i in among if np.minimum(there[self.distinct[i]], self.counts[i]).sum() >= LEAST_WORDS * len(self.coded[i])]

    def compare(self, block: list[str], coded: np.ndarray, i: int) -> Iterator[tuple[int, int, int, int]]:
        """(words in common, words that differ, first, last) of the places that repeat a template."""
        want = self.words[i]
        for differ, a, b in places(coded, self.coded[i], len(want)):
            same = (len(want) + b - a - differ) // 2
            added = b - a - same
            if same < LEAST_WORDS * len(want) or added > same // 2:
                continue
            if not differ or not self.tells(block[a:b], want):
                yield same, differ, a, b

    @staticmethod
    def tells(have: list[str], want: list[str]) -> bool:
        """Whether the words in which the two differ make another license of one."""
        if len(want) > SIZES[0]:
            there, asked = Counter(have), Counter(want)
            return any(map(TELLING_LONG.search, [*(there - asked), *(asked - there)]))
        for kind, a, b, c, d in SequenceMatcher(None, have, want, autojunk=False).get_opcodes():
            if kind != "equal" and any(map(TELLING.search, [*have[a:b], *want[c:d]])):
                return True
        return False

    def confirm(self, block: list[str], coded: np.ndarray, some: list[int]) -> list[tuple]:
        """Places in the block of the template that saves most among those that are there, and of
        those that save nearly as much."""
        best, least = [], 0.0
        for saved, i in self.reductions(block, some):
            if best and saved < least:
                break
            share = saved / self.gain[i]
            if share < LEAST_REDUCTION[self.kind[i]]:
                continue
            for same, differ, a, b in self.compare(block, coded, i):
                best.append((2 * differ - same, self.templates[i][0], a, b, round(share, 4), differ))
                least = least or saved * NEARLY
        return apart(best)

    def search(self, all_words: list, coded: np.ndarray, begin: int, end: int, among: list[int]) -> Iterator[tuple]:
        """Notices among the words from begin to end. What lies between those confirmed is ranked
        again, until no more is confirmed."""
        todo = [(begin, end)]
        while todo:
            lo, hi = todo.pop()
            some = self.held(coded[lo:hi], among) if lo < hi else []
            if not some:
                continue
            found = self.confirm([w for w, _, _ in all_words[lo:hi]], coded[lo:hi], some)
            yield from ((cost, name, lo + a, lo + b, *rest) for cost, name, a, b, *rest in found)
            if found:
                edges = [lo, *[lo + x for f in sorted(found, key=lambda f: f[2]) for x in f[2:4]], hi]
                todo += zip(edges[::2], edges[1::2])

    def scan(self, text: str) -> Iterator[tuple]:
        """(license, start, end, reduction, differing words) of every confirmed notice."""
        found, all_words = [], words(text)
        coded = np.array([self.numbers.get(w, -1) for w, _, _ in all_words], np.int64)
        for among, hints in zip(self.classes, self.hints):
            if not among:
                continue
            span = max(len(self.words[i]) for i in among) * 3 // 2 + 1
            for begin, end in windows(all_words, hints, span):
                found += self.search(all_words, coded, begin, end, among)
        for _, name, a, b, gain, differ in sorted(apart(found), key=lambda f: f[2]):
            yield name, all_words[a][1], all_words[b - 1][2], gain, differ
        yield from tagged(text, {name.lower(): name for name, _ in self.templates})


def tagged(text: str, known: dict[str, str]) -> Iterator[tuple]:
    """Licenses that SPDX tags name; a name is a whole wording, so it stands for the whole gain."""
    for tag in SPDX.finditer(text):
        exception = False
        for m in WORD.finditer(text, *tag.span(1)):
            word = m[0].lower()
            if word not in SPDX_WORDS and not exception:
                yield known.get(SPDX_SUFFIX.sub("", word), SPDX_SUFFIX.sub("", m[0])), m.start(), m.end(), 1.0, 0
            exception = word == "with"


def apart(found: list[tuple]) -> list[tuple]:
    """Best first, those that share no word with a better one: one license for each wording."""
    ends: list[tuple[int, int]] = []
    out = []
    for f in sorted(set(found)):
        a, b = f[2:4]
        k = bisect.bisect_left(ends, (a, b))
        if (k == 0 or ends[k - 1][1] <= a) and (k == len(ends) or ends[k][0] >= b):
            ends.insert(k, (a, b))
            out.append(f)
    return out


SCHEMA = "doc_id long, license string, start long, end long, reduction double, n_differences long"


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row for every notice found in (doc_id, text): license, span in code points, the size
    reduction that ranked it, and in how many words it differs from the template.

    Texts without a license word are left out before Python sees them. Null and empty texts have
    no rows, repeated rows each have their own. Of templates that fit the same words, the one
    with the fewest differences is named.
    """
    templates = wordings() if templates is None else list(templates.items())

    def run(batches):
        scanner = Scanner(templates)
        for batch in batches:
            rows = [
                (doc, *found)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for found in scanner.scan(text)
            ]
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "license", "start", "end", "reduction", "n_differences"],
            )

    return docs.where(F.col("text").rlike(hint(t for _, t in templates))).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)

"""Ranked lexical search by range-maximum sparse tables and best-first document intervals.

Documents are dealt to blocks as they are stored, and a block has a posting list for each query
term: its documents in order, with the term's impact on their scores. A sparse table over the
impacts answers in constant time which posting of a stretch has the greatest. The sum of these
maxima over an item's terms bounds the score of every document in an interval. The interval of the
greatest bound goes first: the document of its greatest impact is scored and splits it in two.
Intervals of few documents are scored whole. An item is done with a block when no interval's bound
reaches its k-th score, which carries over from block to block of a task.

Every document is compared with every item this way, in blocks: items are a stated query set.
They are brought to the tasks in groups of a bounded number of terms. Of the documents only
figures of each query term are shuffled, and k rows for each item and task.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stormgrid.llm.components import stored
from stormgrid.llm.textvec import text_chunks
from stormgrid.llm.words import spelt, terms

TOP = 10
QUERY_TERMS = 200_000  # distinct terms by item that are broadcast at a time
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 1 << 20
LEAF = 128  # documents of an interval that is scored whole
BATCH = 32  # intervals taken at a time

POSTING_SCHEMA = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND_SCHEMA = "item_id long, doc_id long, score long"


def item_term_batches(batches):
    """For mapInArrow over (item_id, text): item_id and term, a row for each occurrence."""
    for batch in batches:
        ids = batch.column(0)
        for at, part in text_chunks(batch.column(1)):
            words = terms(part)
            item = at + np.repeat(np.arange(len(part)), words.counts())
            names = spelt(words).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(item)), names], names=["item_id", "term"])


def posting_batches(vocabulary):
    """For mapInArrow over (doc_id, text): how many terms each document has, and how often it holds
    each term of the vocabulary. Documents without a term are left out."""

    def run(batches):
        known = pa.array(vocabulary.value, pa.large_binary())
        for batch in batches:
            for at, part in text_chunks(batch.column(1)):
                words = terms(part)
                n = words.counts()
                named = pc.index_in(spelt(words), value_set=known)
                hit = np.flatnonzero(named.is_valid())
                doc = np.repeat(np.arange(len(part)), n)[hit]
                term = named.drop_null().to_numpy().astype(np.int64)
                pairs, tf = np.unique(doc * max(len(known), 1) + term, return_counts=True)
                doc, term = np.divmod(pairs, max(len(known), 1))
                offsets = np.searchsorted(doc, np.arange(len(part) + 1)).astype(np.int32)
                rows = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)),
                        pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(tf.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )
                yield rows.filter(pa.array(n > 0))

    return run


@dataclass
class Search:
    """What the tasks need of a group of items. ``items`` holds for each its id, its terms as
    numbers of the vocabulary and how often it repeats each; ``weight`` is by term."""

    items: list[tuple[int, np.ndarray, np.ndarray]]
    weight: np.ndarray
    documents: int
    occurrences: int
    top: int


class Block:
    """Posting lists of some documents, in ascending order of doc_id, with their sparse table."""

    def __init__(self, ids, n, counts, term, tf, search: Search):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.size = ids[order], len(ids)
        doc = place[np.repeat(np.arange(len(ids)), counts)]
        by_list = np.lexsort((doc, term))
        self.doc, term, tf = doc[by_list], term[by_list].astype(np.int64), tf[by_list].astype(np.int64)
        share = 100 - 75 + (75 * n[order] * search.documents) // search.occurrences
        self.impact = search.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * share[self.doc]))
        self.key = term * self.size + self.doc
        # row j: the place of the greatest of the 2**j impacts from each place on, the first of equal
        longest = int(np.bincount(term).max(initial=1)) if len(term) else 1
        level = np.arange(len(term), dtype=np.int32)
        self.table, step = [level], 1
        while step * 2 <= longest:
            left, right = level[: len(level) - step], level[step:]
            level = np.where(self.impact[left] >= self.impact[right], left, right)
            self.table.append(level)
            step *= 2

    def lists(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(self.key, term * self.size), np.searchsorted(self.key, (term + 1) * self.size)

    def greatest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of the greatest impacts of some stretches of lists; of no use for empty ones."""
        length = np.maximum(end - begin, 1)
        power = np.frexp(length)[1] - 1
        found = np.empty(begin.shape, np.int64)
        for j in np.unique(power):
            here = power == j
            first = np.minimum(begin[here], len(self.table[j]) - 1)
            left, right = self.table[j][first], self.table[j][np.maximum(end[here] - (1 << int(j)), 0)]
            found[here] = np.where(self.impact[left] >= self.impact[right], left, right)
        return found


class Best:
    """The k best documents seen for an item, higher scores and then smaller ids first."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.r_[self.score, score], np.r_[self.doc, doc]
        order = np.lexsort((doc, -score))[: self.k]
        self.score, self.doc = score[order], doc[order]

    def may_take(self, bound, doc):
        """Whether a document of this score and id, or better, would be among them."""
        if len(self.score) < self.k:
            return bound > 0
        return (bound > self.score[-1]) | ((bound == self.score[-1]) & (doc < self.doc[-1]))


def search_block(block: Block, term: np.ndarray, times: np.ndarray, best: Best, leaf: int = LEAF) -> int:
    """Brings an item's best documents up to date with a block; how many documents were scored."""
    begin, end = block.lists(term)
    held = end > begin
    term, times, begin, end = term[held], times[held], begin[held], end[held]
    if not len(term):
        return 0
    base, scored, serial = term * block.size, 0, 0
    heap: list[tuple] = []

    def push(low, high, a, b):
        """Intervals low:high of documents, with the stretch of each list that lies in each."""
        nonlocal serial
        place = block.greatest(a, b)
        part = np.where(b > a, block.impact[place] * times, 0)
        bound = part.sum(1)
        widest = part.argmax(1)
        split = block.doc[place[np.arange(len(place)), widest]]
        go = best.may_take(bound, block.ids[np.minimum(low, block.size - 1)]) & (low < high)
        for i in np.flatnonzero(go):
            heapq.heappush(heap, (-int(bound[i]), serial, int(low[i]), int(high[i]), int(split[i]), a[i], b[i]))
            serial += 1

    push(np.array([0]), np.array([block.size]), begin[None], end[None])
    while heap:
        taken = []
        while heap and len(taken) < BATCH:
            interval = heapq.heappop(heap)
            if not best.may_take(-interval[0], block.ids[interval[2]]):
                if len(best.score) == best.k and -interval[0] < best.score[-1]:
                    heap.clear()  # all others are bounded by less
                continue
            taken.append(interval)
        whole = [t for t in taken if t[3] - t[2] <= leaf]
        if whole:
            a, b = np.stack([t[5] for t in whole]).ravel(), np.stack([t[6] for t in whole]).ravel()
            size = b - a
            at = np.repeat(a, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            worth = block.impact[at] * np.repeat(np.tile(times, len(whole)), size)
            # whole numbers far below 2**53, so their sums as doubles are exact
            score = np.bincount(block.doc[at], worth, block.size).astype(np.int64)
            good = np.flatnonzero(score)
            scored += len(good)
            good = good[best.may_take(score[good], block.ids[good])]
            best.add(score[good], block.ids[good])
        parted = [t for t in taken if t[3] - t[2] > leaf]
        if parted:
            low, high, x = (np.array([t[i] for t in parted]) for i in (2, 3, 4))
            a, b = np.stack([t[5] for t in parted]), np.stack([t[6] for t in parted])
            at = np.searchsorted(block.key, base + x[:, None])
            there = (at < b) & (block.key[np.minimum(at, len(block.key) - 1)] == base + x[:, None])
            score = np.where(there, block.impact[np.minimum(at, len(block.key) - 1)] * times, 0).sum(1)
            scored += len(x)
            good = (score > 0) & best.may_take(score, block.ids[x])
            best.add(score[good], block.ids[x[good]])
            push(np.r_[low, x + 1], np.r_[x, high], np.r_[a, at + there], np.r_[at, b])
    return scored


def search_batches(shared, block_docs: int, leaf: int):
    """For mapInArrow over ``POSTING_SCHEMA``: the best documents of the task for each item."""

    def run(batches):
        search: Search = shared.value
        found = [Best(search.top) for _ in search.items]

        def settle(rows: list[pa.RecordBatch]):
            table = pa.Table.from_batches(rows).combine_chunks()
            ids, n = table["doc_id"].to_numpy(), table["n"].to_numpy()
            lists = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table["terms"], table["tfs"])]
            counts = lists[0].value_lengths().to_numpy()
            block = Block(ids, n, counts, *[c.flatten().to_numpy() for c in lists], search)
            for (_, term, times), best in zip(search.items, found):
                search_block(block, term, times, best, leaf)

        held, docs, postings = [], 0, 0
        for batch in batches:
            for begin in range(0, len(batch), block_docs):
                part = batch.slice(begin, block_docs)
                more = len(part.column(2).flatten())
                if held and (docs + len(part) > block_docs or postings + more > BLOCK_POSTINGS):
                    settle(held)
                    held, docs, postings = [], 0, 0
                held.append(part)
                docs, postings = docs + len(part), postings + more
        if held:
            settle(held)
        for (item, _, _), best in zip(search.items, found):
            rows = [np.full(len(best.doc), item, np.int64), best.doc, best.score]
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["item_id", "doc_id", "score"])

    return run


def _search_group(docs: DataFrame, items: list, top: int, block_docs: int, leaf: int) -> DataFrame:
    """The best documents of each task for a group of items, given as (item_id, term, n) rows."""
    spark: SparkSession = docs.sparkSession
    vocabulary = sorted({bytes(r["term"]) for r in items})
    number = {t: i for i, t in enumerate(vocabulary)}
    shared = spark.sparkContext.broadcast(vocabulary)
    postings = stored(docs.mapInArrow(posting_batches(shared), POSTING_SCHEMA), "postings")
    shared.destroy()
    total = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(len(vocabulary), np.int64)
    holders = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for r in holders.collect():  # terms of the items only
        weight[r["term"]] = math.floor(1000 * math.log((2 * total[0] + 2) / (2 * r["df"] + 1)))
    by_item: dict[int, list] = {}
    for r in items:
        by_item.setdefault(r["item_id"], []).append((number[bytes(r["term"])], r["n"]))
    asked = [(i, *np.array(sorted(t), np.int64).T) for i, t in sorted(by_item.items())]
    shared = spark.sparkContext.broadcast(Search(asked, weight, total[0], max(total[1], 1), top))
    found = stored(postings.mapInArrow(search_batches(shared, block_docs, leaf), FOUND_SCHEMA), "found")
    shared.destroy()
    return found


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    query_terms: int = QUERY_TERMS,
    block_docs: int = BLOCK_DOCS,
    leaf: int = LEAF,
) -> DataFrame:
    """item_id, rank, doc_id, score: for each of the items (item_id, text) the ``top`` documents of
    (doc_id, text) with the highest scores above 0, equal ones by ascending doc_id.

    Null and empty texts have no terms. Rows without a doc_id are left out, also of the counts, and
    so are rows without an item_id. Rows that repeat a doc_id are documents of their own; rows
    that repeat an item_id are one item with the terms of all.
    """
    usable = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    asked = items.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    asked = asked.mapInArrow(item_term_batches, "item_id long, term binary")
    asked = stored(asked.groupBy("item_id", "term").agg(F.count("*").alias("n")), "item-terms")
    groups = asked.count() // query_terms + 1
    found = None
    for group in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group).collect()
        part = _search_group(usable, mine, top, block_docs, leaf)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")

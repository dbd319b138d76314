"""Near-duplicate documents by bottom-k sketches.

A document's set is its distinct five-word shingles. One hash function orders all shingles, and
the k smallest of a set are its sketch. Inverted lists of retained values propose pairs, the
sketch of the union estimates their similarity, and the whole sets decide.

Which lists are needed: with an overlap of less than ``least_overlap`` values two full sketches
are taken as unlike (at similarity 0.75 and the defaults below, the chance of a linked pair
falling there is under 1e-7, a binomial tail). A pair above it must share a value among the
``k - least_overlap + 1`` rarest values of either sketch, whatever the order, so only those are
listed. Documents whose rarest values occur nowhere else take no further part, and a passage
that many documents share is listed only for documents that consist mostly of such passages.

Long lists are not expanded into pairs. Documents with equal sets are one class from the start.
Each list first proposes only its most central member to the others. What that connects is
merged, and then only pairs from different components are compared inside the join, where
sketches and estimate are at hand, each pair in the first list that holds both. Parity bitmaps
of the whole sets bound how far two sets agree, and turn away most unlike pairs by bit counts. Whether a list
is the first is mostly told by the few values before it, which pairs of like documents share.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormgrid.llm.components import PART_ROWS, PART_TEXTS, components, few_parts, stored
from stormgrid.llm.shingles import PARITY_WORDS, SET_SCHEMA, SKETCH_SCHEMA, set_batches, sketch_batches

SHINGLE = 5
PERCENT = 75
SKETCH = 64
LEAST_OVERLAP = 28
WIDE_SKETCH = 160
LOOK_BACK = 3
# Sets of more members differ in so many that their parity bitmaps say little.
MAPPED = 1500
# Union-sketch estimates spread by sqrt(p (1 - p) / k); so many of these spreads below the
# threshold a pair is let go.
SPREADS = 5.0


def _similar(a: Column, b: Column, percent: int) -> Column:
    """Exact Jaccard similarity of two sets, in whole numbers."""
    both = F.size(F.array_intersect(a, b)).cast("long")
    union = F.size(a) + F.size(b) - both
    return both * 100 >= union * percent


def _estimate_passes(a: Column, b: Column, k: int, percent: int, spreads: float) -> Column:
    """Similarity in the sketch of the union, the k smallest of both, not far below the threshold."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    share = F.size(F.array_intersect(F.array_intersect(union, a), b))
    p = percent / 100
    slack = spreads * math.sqrt(p * (1 - p) / k)
    # a sketch of fewer than k values is the whole set, and the figure exact
    return share >= F.when(F.size(union) < k, F.lit(p) * F.size(union) - 1e-9).otherwise(
        F.lit((p - slack) * k)
    )


def _may_be_similar(percent: int) -> Column:
    """False only for unlike sets: similar ones differ in few members, and their parity bitmaps
    in no more bits than that. Some bit counts in place of a set operation."""
    differ = F.lit(0)
    for i in range(PARITY_WORDS):
        differ += F.bit_count(F.col(f"x.bits{i}").bitwiseXOR(F.col(f"y.bits{i}")))
    return differ.cast("long") * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)


def document_sketches(docs: DataFrame, size: int = SHINGLE, k: int = SKETCH) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketch_batches(size, k), SKETCH_SCHEMA)


def classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: its smallest document and its sketch."""
    return (
        sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .select("id", "n", "sketch", "digest")
    )


def rare_postings(found: DataFrame, k: int, least_overlap: int) -> DataFrame:
    """(value, id, n, weight): the listed values of each class, lists of two and more only.

    ``weight`` tells how central a class is: the sum of the occurrences of its shared values.
    """
    posted = found.select("id", "n", F.size("sketch").alias("held"), F.explode("sketch").alias("value"))
    shared = posted.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    both = posted.join(shared, "value")
    per_doc = both.groupBy("id", "n", "held").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("common"),  # at most k a document
        F.sum("df").alias("weight"),
    )
    # values found nowhere else come first in the order; a set smaller than k is held whole and
    # needs the same share of its values in common as the threshold asks
    need = F.when(F.col("held") < k, F.ceil(F.col("held") * (PERCENT / 100) - 1e-9)).otherwise(F.lit(least_overlap))
    listed = F.col("held") - F.least(need, F.lit(least_overlap)) + 1 - (F.col("held") - F.size("common"))
    return (
        per_doc.withColumn("common", F.expr("common.value"))
        .withColumn("prefix", F.sort_array(F.slice("common", 1, F.greatest(listed, F.lit(0)).cast("int"))))
        .where(F.size("prefix") > 0)
        .select("id", "n", "weight", "prefix")
    )


def _lists(prefixes: DataFrame) -> DataFrame:
    rows = prefixes.select("id", "n", "weight", "prefix", F.posexplode("prefix").alias("at", "value"))
    before = [F.get("prefix", F.col("at") - i).alias(f"before{i}") for i in range(1, LOOK_BACK + 1)]
    return rows.select("id", "n", "weight", "value", *before)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets are similar. The estimate comes first and needs only the sketches."""
    wide = sets.select("id", F.slice("members", 1, WIDE_SKETCH).alias("wide"))
    likely = (
        pairs.join(wide.selectExpr("id AS a", "wide AS wa"), "a")
        .join(wide.selectExpr("id AS b", "wide AS wb"), "b")
        .where(_estimate_passes(F.col("wa"), F.col("wb"), WIDE_SKETCH, percent, SPREADS))
        .select("a", "b")
    )
    return (
        likely.join(sets.selectExpr("id AS a", "members AS sa"), "a")
        .join(sets.selectExpr("id AS b", "members AS sb"), "b")
        .where(_similar(F.col("sa"), F.col("sb"), percent))
        .select("a", "b")
    )


def _central_pairs(prefixes: DataFrame) -> DataFrame:
    """Each listed class with the most central member of the list."""
    lists = _lists(prefixes)
    heads = lists.groupBy("value").agg(
        F.max_by("id", F.struct("weight", "id")).alias("a"), F.count("*").alias("members")
    )
    return (
        lists.join(heads.where("members > 1"), "value")
        .where("id <> a")
        .select(F.least("id", "a").alias("a"), F.greatest("id", "a").alias("b"))
        .distinct()
    )


def _cross_pairs(prefixes: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs from different components that the estimate lets through, each found once.

    Lists within one component are dropped before the join; in the others the comparison is
    part of the join, so that unlike pairs are never rows. Sets that outgrow the bitmap are
    compared by their sketches, in a join of their own: its condition is too long to be compiled
    along with the other one.
    """
    placed = (
        _lists(prefixes)
        .join(labels.withColumnRenamed("component", "part"), "id", "left")
        .withColumn("part", F.coalesce("part", "id"))
    )
    mixed = placed.groupBy("value").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
    left = placed.join(mixed.select("value"), "value", "left_semi").drop("weight")
    steps = range(1, LOOK_BACK + 1)
    met_before = F.lit(False)
    for i in steps:
        for j in steps:
            met_before = met_before | F.coalesce(F.col(f"x.before{i}") == F.col(f"y.before{j}"), F.lit(False))
    meet = (
        (F.col("x.value") == F.col("y.value"))
        & (F.col("x.part") != F.col("y.part"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
    )
    found = [F.col("x.id").alias("a"), F.col("y.id").alias("b")]

    words = [F.coalesce(F.get("bits", F.lit(i)), F.lit(0)).alias(f"bits{i}") for i in range(PARITY_WORDS)]
    mapped = left.where(F.col("n") <= MAPPED).join(sets.select("id", *words), "id")
    by_bits = mapped.alias("x").join(mapped.alias("y"), meet & _may_be_similar(percent) & ~met_before).select(*found)

    held = prefixes.select("id", "prefix").join(
        sets.select("id", F.slice("members", 1, WIDE_SKETCH).alias("wide")), "id"
    )
    long = left.where(F.col("n") * 100 >= MAPPED * percent).join(held, "id")
    first_shared = F.array_min(F.array_intersect(F.col("x.prefix"), F.col("y.prefix")))
    by_sketch = long.alias("x").join(
        long.alias("y"),
        meet
        & (F.greatest("x.n", "y.n") > MAPPED)
        & ~met_before
        & (F.col("x.value") == first_shared)
        & _estimate_passes(F.col("x.wide"), F.col("y.wide"), WIDE_SKETCH, percent, SPREADS),
    ).select(*found)
    return by_bits.unionByName(by_sketch).distinct()


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, k: int = SKETCH, least_overlap: int = LEAST_OVERLAP
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of (doc_id, text).

    Documents without a word (null, empty or blank text) have the empty set and stay alone.
    Rows that repeat a doc_id are one document with several sets. A row without a doc_id is
    returned with a null component and kept, and takes no part in links. Equal texts and equal
    sets always fall together, whatever their number.
    """
    sketches = stored(document_sketches(docs, size, k), "sketches")
    rows = sketches.count()
    found = classes(sketches)
    prefixes = stored(few_parts(rare_postings(found, k, least_overlap), rows), "prefixes")
    # whole sets only for the classes that some list holds, from one more reading of the texts
    wanted = prefixes.select(F.col("id").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi")
    texts = few_parts(texts, rows, PART_TEXTS)
    sets = stored(texts.mapInArrow(set_batches(size), SET_SCHEMA).withColumnRenamed("doc_id", "id"), "sets")

    same_id = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").join(
        found.select("digest", F.col("id").alias("rep")), "digest"
    )
    exact = same_id.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    # pairs are verified by all tasks there are, and what is left of them is then a few numbers
    parts = rows // PART_ROWS + 1
    near = stored(_verified(_central_pairs(prefixes), sets, percent).repartition(parts), "near")
    labels = components(near, near.count())
    rest = _verified(_cross_pairs(prefixes, sets, labels, percent), sets, percent)
    rest = stored(rest.repartition(parts), "rest")
    labels = components(exact.unionByName(near).unionByName(rest), rows + near.count() + rest.count())
    named = sketches.select("doc_id", "n_shingles").join(
        labels.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left"
    )
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return named.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of documents that stay: one document of each group, all columns as they were."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    return few_parts(kept, docs.count(), PART_TEXTS)

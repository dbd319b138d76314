"""Mixing sources to target weights, through a tree of domains, languages and sources.

A token budget goes down the tree: at every node it is shared among the children by weight. A
child that cannot use its share, since all it holds is ``epochs`` times its tokens, is given what
it holds, and the rest goes to its siblings by weight; only what no sibling can use reaches the
siblings of the parent. All shares are whole tokens and add up to the budget.

A leaf passes through its documents in an order seeded anew for each epoch: whole epochs, then
the prefix of the last that fits the rest of its tokens. The document at which the prefix ends
is selected with the tokens that were left.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormgrid.llm.components import few_parts, stored
from stormgrid.operators.sizing import join_dimension

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DOCS = 2_000


@dataclass(frozen=True)
class Mix:
    """``weights`` by level and name, 1 where not named; whole numbers up to 1000. ``percent`` of
    all tokens is the budget."""

    percent: int = 80
    epochs: int = 2
    seed: int = 17
    weights: dict[str, dict[str, int]] = field(
        default_factory=lambda: {
            "domain": {"web": 5, "books": 3, "code": 2},
            "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
            "source": {},
        }
    )


def domain(source: Column) -> Column:
    """The domain of a source, by its name's last character; a parameter of the trial corpus."""
    place = F.ascii(F.substring(source, -1, 1)) % 3
    return F.when(place == 0, "books").when(place == 1, "code").otherwise("web")


def _tokens() -> Column:
    return F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, the leaf's path and its key, n_tokens (words) of every row. Null names are empty
    names, null texts have no tokens."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    return docs.select(
        "doc_id", domain(source).alias("domain"), lang.alias("lang"), source.alias("source"), _tokens().alias("n_tokens")
    ).withColumn("leaf", F.concat_ws("\x01", *LEVELS))


def _weight(level: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, weight in weights.items():
        out = F.when(F.col(level) == name, weight).otherwise(out)
    return out.cast("long")


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``share`` of every child, from its ``cap`` and ``weight`` and the parent's ``budget``.

    In order of cap by weight, children take their cap while it is at most their part of what is
    left; the others divide the rest, whole tokens first, then one each until none is left.
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("cap") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    rest = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ranked = children.select(
        "*", F.row_number().over(order).alias("_i"), rest.alias("_rest"), F.sum("weight").over(onward).alias("_weights")
    )
    full = F.expr("cap * _weights <= weight * _rest")
    first = F.min(F.when(~full, F.struct("_i", "_rest", "_weights"))).over(group)
    cut = ranked.withColumn("_cut", first)
    part = F.expr("weight * _cut._rest div _cut._weights")
    open_ = F.col("_cut").isNotNull() & (F.col("_i") >= F.col("_cut._i"))
    cut = cut.withColumn("_part", F.when(open_, part))
    left = F.col("_cut._rest") - F.sum("_part").over(group)
    extra = (F.col("_i") - F.col("_cut._i") < left).cast("long")
    share = F.when(open_, F.col("_part") + extra).otherwise(F.col("cap"))
    return cut.withColumn("share", share).drop("_i", "_rest", "_weights", "_cut", "_part", "budget")


def allocate(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``share`` of each leaf of (domain, lang, source, leaf, tokens, docs)."""
    leaves = leaves.withColumn("cap", F.col("tokens") * mix.epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("cap"), F.lit(0)).alias("c"))
    budget = total.select(F.least(F.expr(f"t * {mix.percent} div 100"), "c").alias("budget"))
    nodes, shares = None, None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        if depth + 1 < len(LEVELS):
            nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"))
        else:
            nodes = leaves
        nodes = nodes.withColumn("weight", _weight(level, mix.weights.get(level, {})))
        if shares is None:
            nodes = nodes.withColumn("budget", budget.scalar())
        else:
            nodes = nodes.join(shares, path[:-1])
        shared = share_out(nodes, path[:-1], level)
        shares = shared.select(*path, F.col("share").alias("budget"))
    return shared


def _order(mix: Mix, epoch: Column) -> Column:
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(mix.seed), epoch.cast("string"), doc).cast("binary"))


def _bucket(order: Column, buckets: Column) -> Column:
    """Equal stretches of the order's values, few enough documents each to be sorted by one task."""
    return F.shiftright(F.conv(F.substring(order, 1, 7), 16, 10).cast("long") * buckets, 28)


def plan_mix(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row per leaf: whole epochs, and the place and tokens at which the next one is cut. ``rows``
    is a stored table."""
    n = rows.count()  # leaves are no more than their rows
    leaves = rows.groupBy("leaf", *LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = stored(few_parts(allocate(stored(few_parts(leaves, n), "leaves"), mix), n), "shares")
    goal = stored(
        leaves.select(
            "leaf",
            F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(0).alias("whole"),
            F.when(F.col("tokens") > 0, F.col("share") % F.col("tokens")).otherwise(0).alias("rest"),
            F.expr(f"docs div {BUCKET_DOCS} + 1").alias("buckets"),
        ),
        "goals",
    )
    order = _order(mix, F.col("whole") + 1)
    placed = join_dimension(rows.select("doc_id", "leaf", "n_tokens"), goal, "leaf").where("rest > 0")
    placed = placed.withColumn("order", order).withColumn("bucket", _bucket(F.col("order"), F.col("buckets")))
    # the order is cut into buckets, summed before they meet: no leaf is sorted as a whole
    sums = placed.groupBy("leaf", "bucket", "rest").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("leaf").orderBy("bucket"))
    crossing = (
        sums.withColumn("upto", upto)
        .where("upto >= rest AND upto - n < rest")
        .select("leaf", F.col("bucket").alias("cut_bucket"), (F.col("upto") - F.col("n")).alias("before"))
    )
    crossing = stored(few_parts(crossing, n), "crossings")
    inside = join_dimension(placed, crossing, "leaf").where("bucket = cut_bucket")
    steps = inside.groupBy("leaf", "rest", "before", "order").agg(
        F.sum("n_tokens").alias("n"), F.count("*").alias("cut_rows")
    )
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("leaf").orderBy("order"))
    cuts = (
        steps.withColumn("upto", upto)
        .where("upto >= rest AND upto - n < rest")
        .select(
            "leaf",
            F.col("order").alias("cut"),
            (F.col("rest") - F.col("upto") + F.col("n")).alias("cut_tokens"),
            "cut_rows",
        )
    )
    return stored(few_parts(goal.select("leaf", "whole").join(cuts, "leaf", "left"), n), "mix")


def _in_turn(tied: DataFrame) -> DataFrame:
    """Rows that share the place of the cut, one after the other: ``cut_tokens`` becomes what is left
    at a row's turn, none or less where the budget has ended before it.

    They are numbered where they lie and stored so; a stretch is what one task wrote. The
    stretches are summed first, so however many rows repeat an id, no task sorts them all.
    """
    rows = stored(tied.withColumn("_turn", F.monotonically_increasing_id()), "turns")
    rows = rows.withColumn("_stretch", F.shiftright("_turn", 33))
    earlier = Window.partitionBy("leaf").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("leaf", "_stretch").agg(F.sum("n_tokens").alias("_sum"))
    sums = sums.select("leaf", "_stretch", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("leaf", "_stretch").orderBy("_turn").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    rows = rows.join(sums, ["leaf", "_stretch"]).withColumn("cut_tokens", F.col("cut_tokens") - before)
    return rows.select(*tied.columns)


def apply_mix(rows: DataFrame, plan: DataFrame, mix: Mix) -> DataFrame:
    """The selected rows, one for each epoch that takes them, with ``epoch`` and ``taken_tokens``.

    Rows that repeat a doc_id within a leaf share a place in the order; where the budget ends at
    such a place they are taken one after the other until it is used up. Leaves without tokens
    select nothing. ``plan`` is a stored table.
    """
    both = join_dimension(rows, plan, "leaf")
    both = both.withColumn("_order", _order(mix, F.col("whole") + 1))
    if not plan.where("cut_rows > 1").isEmpty():
        tied = F.coalesce((F.col("cut_rows") > 1) & (F.col("_order") == F.col("cut")), F.lit(False))
        both = both.where(~tied).unionByName(_in_turn(both.where(tied)))
    partly = (F.col("_order") < F.col("cut")) | ((F.col("_order") == F.col("cut")) & (F.col("cut_tokens") > 0))
    epochs = F.col("whole") + F.coalesce(partly, F.lit(False)).cast("long")
    taken = F.when((F.col("epoch") > F.col("whole")) & (F.col("_order") == F.col("cut")), F.least("n_tokens", "cut_tokens"))
    return (
        both.withColumn("_epochs", epochs)
        .where("_epochs > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("_epochs").cast("int"))))
        .withColumn("taken_tokens", F.coalesce(taken, "n_tokens"))
        .drop("whole", "cut", "cut_tokens", "cut_rows", "_order", "_epochs", "leaf")
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, epoch, taken_tokens of everything selected."""
    rows = stored(leaves_of(docs), "tokens")
    return apply_mix(rows, plan_mix(rows, mix), mix)


def select_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The selected rows of documents with all their columns; a row stays whole where the budget
    ends within it, and is repeated where several epochs take it."""
    plan = plan_mix(stored(leaves_of(docs), "tokens"), mix)
    row = F.struct(*[docs["`" + c.replace("`", "``") + "`"] for c in docs.columns])
    rows = docs.select(row.alias("_row"), "doc_id", "lang", "source", "text")
    # tokens are counted in the plan; only ids that repeat at a cut need them again
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    keyed = rows.select(
        "_row", "doc_id", _tokens().alias("n_tokens"), F.concat_ws("\x01", domain(source), lang, source).alias("leaf")
    )
    return apply_mix(keyed, plan, mix).select("_row.*")

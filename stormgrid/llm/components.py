"""Connected components of a table of links, by repeated contraction to smaller ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormgrid.session import scratch

PART_ROWS = 10_000  # rows of ids and figures that are worth a file
PART_TEXTS = 2_000  # rows with a text or a set


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_parts(df: DataFrame, rows: int, part_rows: int = PART_ROWS) -> DataFrame:
    """The rows in no more partitions than ``rows`` rows fill.

    With hundreds of shuffle partitions a table of some kilobytes would be as many files. Each
    costs requests to the store, and on a local disk without Hadoop's native library the executor
    starts processes to set its permissions. Large tables keep the partitions they have.
    """
    return df.coalesce(rows // part_rows + 1)


def unused(name: str, columns: list[str]) -> str:
    """The name, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _smallest(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(links: DataFrame, rows: int, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, for every linked id. ``rows``: about how
    many links there are; it decides on the number of files alone.

    Each round joins every larger neighbour to the smallest one (large star), then all smaller
    neighbours (small star), until the links are stars around their smallest id. Rounds grow
    with the logarithm of the longest chain. A hub's neighbours are reduced to one minimum
    before the shuffle, and none are collected into a row.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    edges = stored(few_parts(edges.distinct(), rows), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").selectExpr("v AS u", "m AS v")
        large = stored(few_parts(large.distinct(), state[0]), "large-star")
        low = _smallest(large)
        small = large.join(low, "u").where("v <> m").selectExpr("v AS u", "m AS v")
        small = small.unionByName(low.selectExpr("u", "m AS v")).distinct()
        edges = stored(few_parts(small, state[0]), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.selectExpr("u AS id", "v AS component")
    return stars.unionByName(stars.selectExpr("component AS id", "component").distinct())


def one_text(sampled: DataFrame) -> DataFrame:
    """One row of (doc_id, text, y) for each doc_id, the one whose text has the least hash: a sample
    bounded in ids is then bounded in rows too."""
    order = F.struct(F.xxhash64("text"), F.sha2(F.col("text"), 256))
    return sampled.groupBy("doc_id", "y").agg(F.min_by("text", order).alias("text"))

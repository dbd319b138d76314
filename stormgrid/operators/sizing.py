"""Broadcast only what has been measured, and another way beyond that."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from stormgrid.session import scratch

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 20_000_000


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows, and about how many bytes they take: one distributed aggregate, which sends a single row
    from each task."""
    texts = [F.octet_length(f.name) for f in df.schema.fields if f.dataType.typeName() == "string"]
    width = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(16 * len(df.columns)))
    return tuple(df.agg(F.count("*"), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first())


def is_small(df: DataFrame) -> bool:
    """Whether rows and text are few enough to broadcast."""
    return small_enough(*measured(df))


def broadcast_if_bounded(df: DataFrame, bound: DataFrame) -> DataFrame:
    """Broadcast ``df`` when ``bound``, a small table with at least as many rows, is measured
    to be small enough; leave the join to the planner otherwise.

    The planner cannot see that an aggregate shrinks a huge input, and AQE finds out only
    after the other side has been shuffled.
    """
    return F.broadcast(df) if is_small(bound) else df


def join_dimension(df: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows, however unevenly spread over the key, with a table unique on it.

    A small dimension is broadcast. A larger one is joined by shuffle, and the keys that hold
    more than one shuffle partition's share of the rows are spread over all partitions by a salt:
    fewer such keys can exist than partitions. Rows without a key match nothing and are spread
    too. The rows are read twice, once to count their keys.
    """
    if is_small(dim):
        return df.join(F.broadcast(dim), key, how)
    spark = df.sparkSession
    share = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # counted once, into a table: hot keys are fewer than there are partitions
    counted, path = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")), scratch(spark, "counts")
    counted.write.parquet(path)
    counts = spark.read.schema(counted.schema).parquet(path)
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    return _spread(df, dim, key, how, counts.where(F.col("_n") * share > total).select(key))


def _spread(df: DataFrame, dim: DataFrame, key: str, how: str, hot: DataFrame) -> DataFrame:
    """The join by shuffle: rows of the few ``hot`` keys, and those without a key, are dealt by a
    salt, and the dimension rows of hot keys are repeated for every salt."""
    share = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot.withColumn("_hot", F.lit(True))
    tagged = df.join(F.broadcast(hot), key, "left")
    spread = F.coalesce("_hot", F.lit(False)) | F.col(key).isNull()
    deal = F.xxhash64(*df.columns, F.spark_partition_id())  # equal rows of several tasks part
    salt = F.when(spread, F.pmod(deal, F.lit(share)).cast("int")).otherwise(F.lit(0))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(share - 1))).otherwise(F.array(F.lit(0)))
    repeated = dim.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return tagged.withColumn("_salt", salt).drop("_hot").join(repeated, [key, "_salt"], how).drop("_salt")


# A key is hot with more than this part of all rows; fewer than that many can be.
HOT_SHARES = 1000


@dataclass(frozen=True)
class Known:
    """What a load has noted for the joins that follow it: whether the dimension is small enough to
    broadcast, and its hot keys, fewer than ``HOT_SHARES``."""

    small: bool
    hot: DataFrame


def small_enough(rows: int, size: int) -> bool:
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def hot_keys(counts: DataFrame, key: str, rows: str = "rows") -> DataFrame:
    """Keys with more than one of ``HOT_SHARES`` parts of all rows, of a table of rows by key."""
    total = F.coalesce(counts.select(F.sum(rows)).scalar(), F.lit(0))
    return counts.where(F.col(rows) * HOT_SHARES > total).select(key)


def join_known(df: DataFrame, dim: DataFrame, key: str, known: Known, how: str = "inner") -> DataFrame:
    """``join_dimension`` with what is known beforehand: the rows are read once, and no job runs
    while the plan is put together."""
    if known.small:
        return df.join(F.broadcast(dim), key, how)
    return _spread(df, dim, key, how, known.hot.select(key))

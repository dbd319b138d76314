"""Consecutive numbers over a distributed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormgrid.session import shared_folder


def number_in_order(df: DataFrame, order: str, into: str, after: Column) -> DataFrame:
    """Number rows ``after`` + 1, + 2, ... in order of a unique column.

    A window without partitions would sort everything in one task. Here the rows are split
    by range, and each needs only its place in its part plus the size of the parts before.
    """
    shared_folder(df.sparkSession)
    # Range bounds are sampled, so two reads could split differently: fix one split first.
    placed = (
        df.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
        .withColumns(
            {
                "_part": F.shiftright("_place", 33),
                "_place": F.col("_place").bitwiseAND((1 << 33) - 1),
            }
        )
    )
    # one row per partition, whatever the number of rows
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(into, (after + F.col("_offset") + F.col("_place") + 1).cast("int"))
        .drop("_part", "_place", "_offset")
    )

"""Joins with the city list and coverage of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stormgrid.functions.coerce import strip
from stormgrid.operators.clean import first_per_key
from stormgrid.operators.sizing import join_dimension


def reference_list(cities: DataFrame, position: str | None = None) -> DataFrame:
    """City list keyed by stripped name, first row per name in list order.

    ``position`` names a column that numbers the list: unique and fixed-width, so the first
    row is a plain hash aggregate. A file scan has no order that survives parallel reading;
    without a position the coordinates decide, which is at least stable.
    """
    named = cities.withColumnsRenamed({"lat": "city_lat", "lng": "city_lng"}).withColumn(
        "city", strip(F.col("city"))
    )
    if position is None:
        return first_per_key(named.select("city", "city_lat", "city_lng"), ["city"], ["city_lat", "city_lng"])
    return named.groupBy("city").agg(
        *[F.min_by(c, position).alias(c) for c in ("city_lat", "city_lng")]
    )


def join_cities(df: DataFrame, reference: DataFrame | None) -> DataFrame:
    """Add reference coordinates by name; rows without a match, or without a list, stay."""
    if reference is None:
        return df
    return join_dimension(df, reference, "city", "left")


def unmatched(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Rows per city name that the reference list does not know."""
    # one row per city before the join, so no city's rows meet in one task
    per_city = df.groupBy("city").agg(F.count("*").alias("rows"))
    return per_city.join(reference, "city", "left_anti")


def coverage(expected: DataFrame, landed: DataFrame, keys: Sequence[str] = ("run_date",)) -> DataFrame:
    """Manifest rows: per run the expected and landed counts with one row per failed city.

    Counts are of the list's rows, a repeated name as often as it is listed. A run without failures keeps one row with a null city. The failed names stay rows: as an
    array they would have to meet in one task.
    """
    keys = list(keys)
    wanted = expected.groupBy(*keys, "city").agg(F.count("*").alias("_listed"))
    arrived = landed.select(*keys, "city").distinct().withColumn("_landed", F.lit(True))
    status = wanted.join(arrived, [*keys, "city"], "left")
    totals = status.groupBy(*keys).agg(
        F.sum("_listed").alias("total_cities"),
        F.coalesce(F.sum(F.when(F.col("_landed"), F.col("_listed"))), F.lit(0)).alias("success_count"),
    )
    failed = status.where(F.col("_landed").isNull()).select(*keys, F.col("city").alias("failed_city"))
    # One row per run date: small enough to broadcast however many cities there are. Keyed on
    # the run alone, a shuffle would bring a whole run's failures into one task.
    partly = failed.join(F.broadcast(totals), keys)
    fully = totals.where("success_count = total_cities").withColumn(
        "failed_city", F.lit(None).cast("string")
    )
    return fully.unionByName(partly)

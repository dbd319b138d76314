"""Keyed load of the dimension, the fact and the history as whole-row operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stormgrid.operators.clean import first_per_key
from stormgrid.operators.numbering import number_in_order
from stormgrid.operators.sizing import Known, join_dimension, join_known
from stormgrid.schemas import (
    DIM,
    FACT_KEY,
    HISTORY_COLUMNS,
    SERVING_TYPES,
    VIEW_COLUMNS,
    nan_to_null,
    serving_values,
)


class RepeatedKey(ValueError):
    """A load holds several rows for one key."""


class NullCoordinates(ValueError):
    """A city to load lacks a coordinate the dimension requires."""


def incoming_cities(gold: DataFrame) -> DataFrame:
    """One row per named city: its first by date, as the sorted layer lists them, with rows
    without a date at the end. City and date are unique in a run, so both coordinates come
    from one row; the buffers are fixed-width, so no sort is needed."""
    day = F.coalesce(F.col("forecast_date"), F.lit("9999-12-31").cast("date"))
    return (
        gold.where(F.col("city").isNotNull())
        .groupBy(F.col("city").alias("city_name"))
        .agg(*[F.min_by(c, day).alias(c) for c in ("latitude", "longitude")])
    )


def with_coordinates(cities: DataFrame) -> DataFrame:
    return cities.dropna(subset=["latitude", "longitude"])


def upsert_dim(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Known names keep their id and take the new coordinates; new names get the next ids by
    name. A full join with a hit flag, since a matched row is replaced and not merged."""
    offered = incoming.select(
        "city_name",
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lng"),
        F.lit(True).alias("_hit"),
    )
    joined = existing.join(offered, "city_name", "full_outer").select(
        "city_id",
        "city_name",
        F.when(F.col("_hit"), F.col("_lat")).otherwise(F.col("latitude")).alias("latitude"),
        F.when(F.col("_hit"), F.col("_lng")).otherwise(F.col("longitude")).alias("longitude"),
    )
    top = F.coalesce(existing.select(F.max("city_id")).scalar(), F.lit(0))
    fresh = number_in_order(joined.where("city_id IS NULL").drop("city_id"), "city_name", "city_id", top)
    known = joined.where("city_id IS NOT NULL")
    return known.unionByName(fresh).select(*[F.col(f.name).cast(f.dataType) for f in DIM.fields])


def _with_dimension(rows: DataFrame, dim: DataFrame, key: str, known: Known | None) -> DataFrame:
    return join_dimension(rows, dim, key) if known is None else join_known(rows, dim, key, known)


def with_city_id(gold: DataFrame, dim: DataFrame, known: Known | None = None) -> DataFrame:
    """Rows whose city the dimension knows. ``known`` names hot cities by ``city``."""
    return _with_dimension(gold, dim.select("city_id", F.col("city_name").alias("city")), "city", known)


def unmapped_cities(gold: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows per city that a load would leave out."""
    per_city = gold.groupBy("city").agg(F.count("*").alias("rows"))
    return per_city.join(dim.select(F.col("city_name").alias("city")), "city", "left_anti")


def serving_rows(gold: DataFrame, dim: DataFrame, loaded_at: Column, known: Known | None = None) -> DataFrame:
    """Gold as fact rows in the declared types."""
    mapped = with_city_id(nan_to_null(gold), dim, known)
    values = serving_values()
    return mapped.select(
        F.col("city_id"),
        F.col("forecast_date"),
        *[values[c].alias(c) for c in SERVING_TYPES],
        loaded_at.cast("timestamp_ntz").alias("loaded_at"),
    )


def castable(gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose figures all fit their declared types, and a row for each one that does not: its
    key, the column and the value as text. For callers that would rather lose such a row than have
    it end a load, as the plain cast of ``serving_rows`` does."""
    misfit = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
                    F.struct(F.lit(f"{c} {t.simpleString()}").alias("reason"), F.col(c).cast("string").alias("value")),
                )
                for c, t in SERVING_TYPES.items()
            ]
        )
    )
    judged = nan_to_null(gold).withColumn("_misfit", misfit)
    sound = judged.where(F.size("_misfit") == 0).drop("_misfit")
    return sound, judged.select("city", "forecast_date", F.inline("_misfit"))


def placeable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fact rows with a date, and the others with the reason why they cannot be loaded."""
    dated = F.col("forecast_date").isNotNull()
    return rows.where(dated), rows.where(~dated).withColumn("reason", F.lit("no_date"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    if not repeated_keys(df, keys).isEmpty():
        raise RepeatedKey(f"{what}: several rows for one {tuple(keys)}")
    return df


def upsert_fact(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = FACT_KEY) -> DataFrame:
    """Incoming rows replace whole rows with their key, nulls included; the rest stays.

    The incoming side must be unique on the key (``require_unique``). It is a run's worth of
    rows, so below the size threshold the anti join broadcasts it and never moves the table.
    """
    untouched = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(incoming).select(*existing.columns)


def cascade_delete(fact: DataFrame, deleted: DataFrame) -> DataFrame:
    """Rows of the fact, the history or the dimension without those of deleted cities."""
    return fact.join(deleted.select("city_id"), "city_id", "left_anti")


def history_rows(fact_rows: DataFrame, run_date: Column, recorded_at: Column) -> DataFrame:
    return fact_rows.select(
        run_date.cast("date").alias("run_date"),
        *HISTORY_COLUMNS,
        recorded_at.cast("timestamp_ntz").alias("recorded_at"),
    )


def history_latest(history: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The forecast in force per key, optionally as of a run date: what replaying the loads
    up to that run would leave in the fact."""
    if as_of is not None:
        history = history.where(F.col("run_date") <= as_of)
    return first_per_key(history, FACT_KEY, [F.desc("run_date")])


def serving_view(fact: DataFrame, dim: DataFrame, known: Known | None = None) -> DataFrame:
    """Fact rows with their city; unordered, so that filters reach the scan."""
    return _with_dimension(fact, dim, "city_id", known).select(*VIEW_COLUMNS)

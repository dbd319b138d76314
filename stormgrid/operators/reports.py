"""Questions and reports over figures by city or by day, from a maintained rollup or the fact.

All work on a row for each city or day (``operators.rollup``); names and coordinates are fetched
for those, so neither the fact nor its rows ever pass through a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stormgrid import policy
from stormgrid.functions import scoring
from stormgrid.functions.numbers import exact_mean, round_tenth_even
from stormgrid.operators import rollup


def _mean(column: str) -> Column:
    n = F.nullif(F.col(f"n_{column}"), F.lit(0))
    return F.col(f"sum_{column}").cast("double") / n.cast("double")


def _named(cities: DataFrame, dim: DataFrame) -> DataFrame:
    return cities.join(dim.select("city_id", "city_name", "latitude", "longitude"), "city_id")


def hottest_cities(cities: DataFrame, dim: DataFrame, n: int = policy.TOP_CITIES) -> DataFrame:
    count = F.nullif(F.col("n_temp_max"), F.lit(0)).cast("decimal(18,0)")
    rows = _named(cities, dim).select(
        "city_name",
        F.round(F.col("sum_temp_max") / count, 2).cast("double").alias("avg_temp_max"),
        F.col("max_temp_max").cast("double").alias("peak_temp_max"),
    )
    return rows.orderBy(F.desc_nulls_first("avg_temp_max"), "city_name").limit(n)


def wettest_cities(cities: DataFrame, dim: DataFrame, n: int = policy.TOP_CITIES) -> DataFrame:
    rows = _named(cities.where("sum_precipitation_mm > 0"), dim).select(
        "city_name",
        F.col("sum_precipitation_mm").cast("double").alias("total_mm"),
        _mean("precipitation_prob").alias("avg_probability"),
    )
    return rows.orderBy(F.desc("total_mm"), "city_name").limit(n)


def riskiest_cities(cities: DataFrame, dim: DataFrame, n: int = policy.TOP_CITIES) -> DataFrame:
    rows = _named(cities, dim).select(
        "city_name", _mean("risk_score").alias("avg_score"), F.col("n_risky").alias("high_risk_days")
    )
    return rows.orderBy(F.desc("avg_score"), "city_name").limit(n)


def riskiest_dates(days: DataFrame) -> DataFrame:
    rows = days.select(
        "forecast_date", _mean("risk_score").alias("avg_score"), F.col("n_risky").alias("high_risk_cities")
    )
    return rows.orderBy(F.desc("avg_score"), "forecast_date")


def summary(cells: DataFrame) -> DataFrame:
    return rollup.merged(cells).select(
        "rows", _mean("risk_score").alias("mean_score"), F.col("n_high_score").alias("high_risk_rows")
    )


def flag_counts(cells: DataFrame) -> DataFrame:
    """Rows of each quality flag that occurs."""
    counts = rollup.merged(cells).select(*[F.col(n).alias(label) for label, n in rollup.FLAGS.items()])
    return counts.unpivot([], list(rollup.FLAGS), "data_quality_flag", "rows").where("rows > 0")


def top_city(cities: DataFrame, dim: DataFrame) -> DataFrame:
    rows = _named(cities, dim).select(F.col("city_name").alias("city"), _mean("risk_score").alias("mean_score"))
    return rows.where("mean_score IS NOT NULL").orderBy(F.desc("mean_score"), "city").limit(1)


def map_points(cities: DataFrame, dim: DataFrame) -> DataFrame:
    """One point per located city; its level follows from the rounded mean."""
    means = [round_tenth_even(_mean(c)).alias(c) for c in ("risk_score", "temp_max", "precipitation_mm")]
    points = _named(cities, dim.dropna(subset=["latitude", "longitude"])).select(
        "city_name", "latitude", "longitude", *means, F.col("n_risk_score").alias("n_forecasts")
    )
    return points.withColumn("risk_level", scoring.risk_level(F.col("risk_score")))


def kpis(cities: DataFrame, dim: DataFrame) -> DataFrame:
    """Headline figures, one row even for no input; the riskiest city is the first by name among
    equals."""
    rows = _named(cities, dim).withColumn("mean_score", _mean("risk_score"))
    standing = F.when(F.col("mean_score").isNotNull(), F.struct(-F.col("mean_score"), F.col("city_name")))
    return rows.agg(
        F.count("*").alias("n_cities"),
        F.max("max_temp_max").cast("double").alias("temp_max"),
        F.max("max_precipitation_mm").cast("double").alias("precip_max"),
        F.coalesce(F.sum("n_risky"), F.lit(0)).alias("n_risky"),
        F.min_by("city_name", standing).alias("top_city"),
    )


def risk_by_city(cities: DataFrame, dim: DataFrame, n: int = policy.TOP_CHART_CITIES) -> DataFrame:
    rows = _named(cities, dim).select("city_name", _mean("risk_score").alias("risk_score"))
    return rows.orderBy(F.desc_nulls_last("risk_score"), "city_name").limit(n)


def risk_pivot(fact: DataFrame, dim: DataFrame, chosen: Sequence[str]) -> DataFrame:
    """Mean score by date and chosen city, from the fact: its cells are single rows. The broadcast
    side holds no more rows than cities were chosen, for names are unique."""
    picked = dim.where(F.col("city_name").isin(list(chosen))).select("city_id", "city_name")
    rows = fact.select("city_id", "forecast_date", "risk_score").join(F.broadcast(picked), "city_id")
    return rows.groupBy("forecast_date").pivot("city_name", list(chosen)).agg(exact_mean(F.col("risk_score")))


def city_names(cities: DataFrame, dim: DataFrame) -> DataFrame:
    ids = cities.select("city_id").distinct()
    return dim.join(ids, "city_id", "left_semi").select("city_name").orderBy("city_name")


def bounds(cells: DataFrame) -> DataFrame:
    return cells.agg(F.min("first_day").alias("min_date"), F.max("last_day").alias("max_date"))

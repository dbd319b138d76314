"""Analytical questions and report aggregates over the serving tables.

Questions by city aggregate on ``city_id`` first and fetch names for the few rows that
remain: the fact is never shuffled or broadcast against for the sake of a label, and a city
with a third of all rows is folded by the map-side partial aggregate.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stormgrid import policy
from stormgrid.functions import scoring
from stormgrid.functions.numbers import decimal_mean, exact_mean, exact_sum, round_tenth_even
from stormgrid.operators.sizing import broadcast_if_bounded

DETAIL_COLUMNS = [
    "city_name",
    "forecast_date",
    "temp_max",
    "precipitation_mm",
    "wind_gust_max",
    "risk_score",
    "risk_level",
    "data_quality_flag",
]


def _named(per_city: DataFrame, dim: DataFrame) -> DataFrame:
    return per_city.join(dim.select("city_id", "city_name"), "city_id").drop("city_id")


def hottest_cities(fact: DataFrame, dim: DataFrame, n: int = policy.TOP_CITIES) -> DataFrame:
    per_city = fact.groupBy("city_id").agg(
        decimal_mean(F.col("temp_max"), 2).alias("avg_temp_max"),
        F.max("temp_max").cast("double").alias("peak_temp_max"),
    )
    return _named(per_city, dim).orderBy(F.desc_nulls_first("avg_temp_max"), "city_name").limit(n)


def wettest_cities(fact: DataFrame, dim: DataFrame, n: int = policy.TOP_CITIES) -> DataFrame:
    per_city = fact.groupBy("city_id").agg(
        exact_sum(F.col("precipitation_mm")).cast("double").alias("total_mm"),
        exact_mean(F.col("precipitation_prob")).alias("avg_probability"),
    )
    return _named(per_city.where("total_mm > 0"), dim).orderBy(F.desc("total_mm"), "city_name").limit(n)


def riskiest_cities(fact: DataFrame, dim: DataFrame, n: int = policy.TOP_CITIES) -> DataFrame:
    per_city = fact.groupBy("city_id").agg(
        exact_mean(F.col("risk_score")).alias("avg_score"),
        F.count_if(scoring.is_high_risk(F.col("risk_level"))).alias("high_risk_days"),
    )
    return _named(per_city, dim).orderBy(F.desc("avg_score"), "city_name").limit(n)


def riskiest_dates(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("forecast_date")
        .agg(
            exact_mean(F.col("risk_score")).alias("avg_score"),
            F.count_if(scoring.is_high_risk(F.col("risk_level"))).alias("high_risk_cities"),
        )
        .orderBy(F.desc("avg_score"), "forecast_date")
    )


def worst_days(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Every day on which a city reaches its highest score, ties included.

    Equal to rank() = 1 by city, but as a maximum joined back: all tied days of a hot city
    would have to pass through one window task. The join broadcasts the maxima, at most one
    row per city of the dimension; with more cities than that, its key of city and score
    spreads the days of a city over many tasks.
    """
    peaks = fact.groupBy("city_id").agg(F.max("risk_score").alias("risk_score"))
    named = peaks.join(dim.select("city_id", "city_name"), "city_id")
    days = fact.select("city_id", "forecast_date", "risk_score", "risk_level")
    return (
        days.join(broadcast_if_bounded(named, dim), ["city_id", "risk_score"])
        .select("city_name", "forecast_date", "risk_score", "risk_level")
        .orderBy(F.desc("risk_score"), "city_name", "forecast_date")
    )


def apply_filters(
    view: DataFrame,
    cities: Sequence[str] = (),
    date_range: Sequence = (),
    risk_levels: Sequence[str] = (),
) -> DataFrame:
    """City, period (both ends inclusive) and level filters; an empty one filters nothing."""
    if cities:
        view = view.where(F.col("city_name").isin(list(cities)))
    if len(date_range) == 2:
        start, end = date_range
        view = view.where(F.col("forecast_date").between(start, end))
    if risk_levels:
        view = view.where(F.col("risk_level").isin(list(risk_levels)))
    return view


def period_bounds(view: DataFrame, preset: str, today: datetime.date) -> DataFrame:
    """First and last day of a preset, one row. A preset that misses the available days, or
    is not known, means all of them."""
    days = view.agg(F.min("forecast_date").alias("first_day"), F.max("forecast_date").alias("last_day"))
    length = policy.PERIODS.get(preset)
    if length is None:
        return days
    now = F.lit(today).cast("date")
    start = F.greatest(now, F.col("first_day"))
    end = F.least(F.date_add(now, max(length - 1, 0)), F.col("last_day"))
    empty = start > end
    return days.select(
        F.when(empty, F.col("first_day")).otherwise(start).alias("first_day"),
        F.when(empty, F.col("last_day")).otherwise(end).alias("last_day"),
    )


def in_period(view: DataFrame, preset: str, today: datetime.date) -> DataFrame:
    """The bounds enter as scalar subqueries, which also reach the Parquet scan."""
    bounds = period_bounds(view, preset, today)
    return view.where(
        F.col("forecast_date").between(
            bounds.select("first_day").scalar(), bounds.select("last_day").scalar()
        )
    )


def high_risk(df: DataFrame) -> DataFrame:
    """Rows at or above the high-risk score; the two top levels are the same rows."""
    return df.where(F.col("risk_score") >= policy.HIGH_RISK_SCORE)


def map_points(view: DataFrame) -> DataFrame:
    """One point per located city; its level follows from the rounded mean."""

    def tenth(column: str) -> Column:
        return round_tenth_even(exact_mean(F.col(column))).alias(column)

    points = (
        view.dropna(subset=["latitude", "longitude"])
        .where(F.col("city_name").isNotNull())
        .groupBy("city_name", "latitude", "longitude")
        .agg(
            tenth("risk_score"),
            tenth("temp_max"),
            tenth("precipitation_mm"),
            F.count("risk_score").alias("n_forecasts"),
        )
    )
    return points.withColumn("risk_level", scoring.risk_level(F.col("risk_score")))


def kpis(view: DataFrame) -> DataFrame:
    """Headline figures, one row even for no input.

    Per city first, then over cities: one scan and one shuffle of city rows give all five
    figures, the riskiest city included (first by name among equals).
    """
    per_city = view.groupBy("city_name").agg(
        F.max("temp_max").alias("temp_max"),
        F.max("precipitation_mm").alias("precip_max"),
        F.count_if(scoring.is_high_risk(F.col("risk_level"))).alias("n_risky"),
        exact_mean(F.col("risk_score")).alias("mean_score"),
    )
    contender = F.col("city_name").isNotNull() & F.col("mean_score").isNotNull()
    standing = F.when(contender, F.struct(-F.col("mean_score"), F.col("city_name")))
    return per_city.agg(
        F.count("city_name").alias("n_cities"),
        F.max("temp_max").cast("double").alias("temp_max"),
        F.max("precip_max").cast("double").alias("precip_max"),
        F.coalesce(F.sum("n_risky"), F.lit(0)).alias("n_risky"),
        F.min_by("city_name", standing).alias("top_city"),
    )


def risk_by_city(view: DataFrame, n: int = policy.TOP_CHART_CITIES) -> DataFrame:
    return (
        view.where(F.col("city_name").isNotNull())
        .groupBy("city_name")
        .agg(exact_mean(F.col("risk_score")).alias("risk_score"))
        .orderBy(F.desc_nulls_last("risk_score"), "city_name")
        .limit(n)
    )


def risk_pivot(view: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Mean score by date and chosen city. The list is given, so no job has to find it, and
    the rows of other cities are dropped before the shuffle."""
    chosen = view.where(F.col("city_name").isin(list(cities)))
    return chosen.groupBy("forecast_date").pivot("city_name", list(cities)).agg(
        exact_mean(F.col("risk_score"))
    )


def detail_table(view: DataFrame) -> DataFrame:
    """All rows, riskiest first. City and date complete the order, and let the range
    partitioning split a run of equal scores."""
    return view.select(*DETAIL_COLUMNS).orderBy(F.desc("risk_score"), "city_name", "forecast_date")


def _comes_after(order: Sequence[tuple[str, bool]], last: Sequence) -> Column:
    """Rows behind the one with the values ``last`` in an order of (column, descending), in which
    nulls are the least."""
    behind, tied = F.lit(False), F.lit(True)
    for (column, descending), value in zip(order, last, strict=True):
        c = F.col(column)
        if descending:
            past = F.lit(False) if value is None else (c < F.lit(value)) | c.isNull()
        else:
            past = c.isNotNull() if value is None else c > F.lit(value)
        behind, tied = behind | (tied & past), tied & c.eqNullSafe(F.lit(value))
    return behind


DETAIL_ORDER = [("risk_score", True), ("city_name", False), ("forecast_date", False)]


def detail_page(view: DataFrame, size: int, after: Sequence | None = None) -> DataFrame:
    """The next ``size`` rows of the detail table behind the row whose score, city and date are
    ``after``, the first ones without it.

    A seek: rows of higher scores are left out by the scan, and of the others only the page is
    ever sorted, so a page far down costs no more than the first.
    """
    rows = view.select(*DETAIL_COLUMNS)
    if after is not None:
        score = F.col("risk_score")
        reached = score.isNull() if after[0] is None else (score <= F.lit(after[0])) | score.isNull()
        rows = rows.where(reached).where(_comes_after(DETAIL_ORDER, after))
    return rows.orderBy(F.desc("risk_score"), "city_name", "forecast_date").limit(size)


def page_end(page: Sequence) -> tuple | None:
    """What to pass as ``after`` for the page behind this one's rows; None behind the last."""
    return tuple(page[-1][c] for c, _ in DETAIL_ORDER) if page else None


def period_days(
    preset: str, today: datetime.date, first: datetime.date, last: datetime.date
) -> tuple[datetime.date, datetime.date]:
    """``period_bounds`` for stored days whose first and last are known."""
    length = policy.PERIODS.get(preset)
    if length is None:
        return first, last
    start, end = max(today, first), min(today + datetime.timedelta(days=max(length - 1, 0)), last)
    return (start, end) if start <= end else (first, last)


def city_names(view: DataFrame) -> DataFrame:
    return view.select("city_name").distinct().orderBy("city_name")


def filter_bounds(view: DataFrame) -> DataFrame:
    return view.agg(F.min("forecast_date").alias("min_date"), F.max("forecast_date").alias("max_date"))

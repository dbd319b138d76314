"""Silver rows to scored gold rows: one map-only stage."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from stormgrid.functions import scoring
from stormgrid.functions.numbers import round_tenth_exact
from stormgrid.policy import QUALITY_COLUMNS, SCORE_CAP


def with_categories(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "temp_category": scoring.temp_category(F.col("temp_max")),
            "precipitation_category": scoring.precipitation_category(F.col("precipitation_mm")),
            "wind_category": scoring.wind_category(F.col("wind_gust_max")),
        }
    )


def risk_parts() -> dict[str, Column]:
    return {
        "rain_points": scoring.rain_points(F.col("precipitation_mm"), F.col("precipitation_prob")),
        "gust_points": scoring.gust_points(F.col("wind_gust_max")),
        "temp_points": scoring.temp_points(F.col("temp_max")),
        "severity_points": scoring.severity_points(F.col("weather_code")),
    }


def with_score(df: DataFrame) -> DataFrame:
    """Score, level and quality flag. The additions keep one order: doubles do not commute
    past rounding."""
    rain, gust, temp, severity = risk_parts().values()
    total = F.least(rain + gust + temp + severity, F.lit(SCORE_CAP))
    # The raw total is a column of its own so that the rounding reads it instead of
    # repeating the whole sum in each branch; the same goes for the level.
    scored = df.withColumn("_total", total).withColumn("risk_score", round_tenth_exact(F.col("_total")))
    return scored.withColumns(
        {
            "risk_level": scoring.risk_level(F.col("risk_score")),
            "data_quality_flag": scoring.quality_flag(*[F.col(c) for c in QUALITY_COLUMNS]),
        }
    ).drop("_total")


def with_calendar(df: DataFrame, run_date: Column) -> DataFrame:
    day = F.col("forecast_date")
    return df.withColumns(
        {
            "day_of_week": scoring.day_name(day),
            "is_weekend": scoring.is_weekend(day),
            "days_ahead": F.date_diff(day, run_date),
        }
    )


def gold(silver: DataFrame, run_date: str | datetime.date | Column) -> DataFrame:
    """Silver columns plus nine. ``run_date`` is required: the clock of the machine that
    happens to run the job says nothing about the data."""
    if not isinstance(run_date, Column):
        run_date = F.lit(run_date).cast("date")
    return with_calendar(with_score(with_categories(silver)), run_date)

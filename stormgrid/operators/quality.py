"""Quality figures of the silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormgrid.functions.numbers import exact_mean
from stormgrid.policy import HIGH_RISK_SCORE
from stormgrid.schemas import MEASURES


def quality_report(silver: DataFrame) -> DataFrame:
    """Size, period and missing values, one row from one pass."""
    return silver.agg(
        F.count("*").alias("rows"),
        F.count_distinct("city").alias("cities"),
        F.min("forecast_date").alias("date_min"),
        F.max("forecast_date").alias("date_max"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in MEASURES],
    )


def missing_pct(silver: DataFrame) -> DataFrame:
    """Share of missing values of each measure that has any."""
    counts = silver.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in MEASURES]
    )
    return (
        counts.unpivot(["rows"], MEASURES, "column_name", "missing")
        .where("missing > 0")
        .select("column_name", "missing", (F.col("missing") * 100 / F.col("rows")).alias("pct"))
    )


def days_per_city(silver: DataFrame) -> DataFrame:
    named = silver.where(F.col("city").isNotNull())
    return named.groupBy("city").agg(F.count_distinct("forecast_date").alias("days"))


def coverage_evenness(silver: DataFrame) -> DataFrame:
    """Do all cities have the same number of days?"""
    spread = days_per_city(silver).agg(F.min("days").alias("min_days"), F.max("days").alias("max_days"))
    return spread.withColumn(
        "uneven", F.coalesce(F.col("min_days") != F.col("max_days"), F.lit(False))
    )


def top_city(df: DataFrame, city: str = "city") -> DataFrame:
    """City with the highest mean score; the first by name among equals."""
    return (
        df.where(F.col(city).isNotNull())
        .groupBy(city)
        .agg(exact_mean(F.col("risk_score")).alias("mean_score"))
        .where(F.col("mean_score").isNotNull())
        .orderBy(F.desc("mean_score"), F.asc(city))
        .limit(1)
    )


def gold_summary(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count("*").alias("rows"),
        exact_mean(F.col("risk_score")).alias("mean_score"),
        F.count_if(F.col("risk_score") >= HIGH_RISK_SCORE).alias("high_risk_rows"),
    )


def quality_flag_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("data_quality_flag").agg(F.count("*").alias("rows"))

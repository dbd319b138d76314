"""Mergeable figures of the fact by city and month and by day, kept current load by load.

Every figure is a count, an exact sum, a maximum or a minimum, so cells of a month, a city or a
stretch of months add up to the figures of the whole. A load recomputes the months it touches
from the fact and leaves the others alone; reports read cells, some thirty times fewer than rows.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stormgrid import policy
from stormgrid.functions import scoring
from stormgrid.schemas import SERVING_TYPES

SUMMED = ["temp_max", "precipitation_mm", "precipitation_prob", "risk_score"]
FLAGS = {policy.COMPLETE: "n_complete", policy.PARTIAL: "n_partial", policy.LACKING: "n_lacking"}
COUNTS = ["rows", "n_risky", "n_high_score", *FLAGS.values(), *[f"n_{c}" for c in SUMMED]]
# Sums of the declared two decimals: exact, and still a primitive long in the first aggregate.
TERM, SUM = "decimal(8,2)", T.DecimalType(18, 2)

FIGURES = [
    *[T.StructField(c, T.LongType()) for c in COUNTS],
    *[T.StructField(f"sum_{c}", SUM) for c in SUMMED],
    *[T.StructField(f"max_{c}", SERVING_TYPES[c]) for c in SUMMED],
    T.StructField("first_day", T.DateType()),
    T.StructField("last_day", T.DateType()),
]
MONTH = T.StructField("month", T.DateType())
CITY_MONTHS = T.StructType([MONTH, T.StructField("city_id", T.IntegerType()), *FIGURES])
DAYS = T.StructType([MONTH, T.StructField("forecast_date", T.DateType()), *FIGURES])


def _month() -> Column:
    return F.trunc("forecast_date", "MM").alias("month")


def of_fact(fact: DataFrame, *keys: str) -> DataFrame:
    """The figures by key, from the rows themselves."""
    day = fact["forecast_date"]  # also where the date is a key
    figures = {
        "rows": F.count("*"),
        "n_risky": F.count_if(scoring.is_high_risk(F.col("risk_level"))),
        "n_high_score": F.count_if(F.col("risk_score") >= policy.HIGH_RISK_SCORE),
        **{n: F.count_if(F.col("data_quality_flag") == label) for label, n in FLAGS.items()},
        **{f"n_{c}": F.count(c) for c in SUMMED},
        **{f"sum_{c}": F.sum(F.col(c).cast(TERM)) for c in SUMMED},
        **{f"max_{c}": F.max(c) for c in SUMMED},
        "first_day": F.min(day),
        "last_day": F.max(day),
    }
    cells = fact.groupBy(*keys).agg(*[figures[f.name].alias(f"_{f.name}") for f in FIGURES])
    return cells.select(*keys, *[F.col(f"_{f.name}").cast(f.dataType).alias(f.name) for f in FIGURES])


def merged(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells of equal keys as one; without keys a single row, of zeros and nulls for no cells."""

    def whole(f: T.StructField) -> Column:
        if f.name in COUNTS:
            return F.coalesce(F.sum(f.name), F.lit(0))
        if f.name.startswith("sum_"):
            return F.sum(f.name)
        return F.min(f.name) if f.name == "first_day" else F.max(f.name)

    out = cells.groupBy(*keys).agg(*[whole(f).alias(f"_{f.name}") for f in FIGURES])
    return out.select(*keys, *[F.col(f"_{f.name}").cast(f.dataType).alias(f.name) for f in FIGURES])


def city_months(fact: DataFrame) -> DataFrame:
    return of_fact(fact.withColumn("month", _month()), "month", "city_id")


def days(fact: DataFrame) -> DataFrame:
    return of_fact(fact.withColumn("month", _month()), "month", "forecast_date")


def in_months(fact: DataFrame, months: list[datetime.date]) -> DataFrame:
    """Fact rows of some months; the dates are partitions, so no other is read."""
    return fact.where(F.trunc("forecast_date", "MM").isin(months))


def _first_of_month(day: datetime.date) -> datetime.date:
    return day.replace(day=1)


def _after_month(day: datetime.date) -> datetime.date:
    return (_first_of_month(day) + datetime.timedelta(days=31)).replace(day=1)


def of_period(cells: DataFrame, fact: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """City figures of a period, both ends inclusive: whole months from their cells, the days before
    and after them from the fact."""
    begin = first if first == _first_of_month(first) else _after_month(first)
    end = _first_of_month(last + datetime.timedelta(days=1))  # the first month not whole
    day = F.col("forecast_date")
    if begin >= end:
        return of_fact(fact.where(day.between(first, last)), "city_id")
    edges = fact.where((day.between(first, last)) & ((day < begin) | (day >= end)))
    whole = cells.where((F.col("month") >= begin) & (F.col("month") < end)).drop("month")
    return merged(whole.unionByName(of_fact(edges, "city_id")), "city_id")

"""Typing, deduplication and plausibility rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormgrid.functions import coerce
from stormgrid.policy import PLAUSIBLE
from stormgrid.schemas import DAILY_COLUMNS, MEASURES, nan_to_null


def parse_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to doubles, unreadable and NaN values null.

    Three small steps, each reading the one before by name: written as one expression per
    column, every text would be parsed twice and the generated code outgrow the JIT.
    """
    flagged = df.withColumn("_suspect", coerce.may_be_java_literal(*[F.col(c) for c in columns]))
    parsed = flagged.withColumns({c: coerce.to_number(F.col(c), F.col("_suspect")) for c in columns})
    return nan_to_null(parsed.drop("_suspect"), columns)


def standardize(raw: DataFrame) -> DataFrame:
    """Raw text rows to silver names and types; unreadable values become null."""
    renamed = raw.withColumnsRenamed(DAILY_COLUMNS)
    numbers = parse_numbers(renamed, ["latitude", "longitude", *MEASURES, "weather_code"])
    return numbers.withColumns(
        {
            "city": coerce.strip(F.col("city")),
            "forecast_date": coerce.to_day(F.col("forecast_date")),
            "extracted_at": coerce.to_stamp(F.col("extracted_at")),
            "weather_code": coerce.to_whole(F.col("weather_code")),
        }
    )


def unreadable_codes(raw: DataFrame) -> DataFrame:
    """How many weather codes held a number that is not a whole one."""
    number = F.col("weather_code")
    return parse_numbers(raw.select("weather_code"), ["weather_code"]).agg(
        F.count_if(number.isNotNull() & coerce.to_whole(number).isNull()).alias("fractional_codes")
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], stamp: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the latest stamp, where a missing stamp counts as the latest of all.

    The filter on row_number lets Spark keep one row per key and task before the shuffle, so
    a key that holds most of the rows arrives as one row per map task. ``tiebreak`` makes
    equal stamps deterministic.
    """
    order = [F.col(stamp).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in tiebreak]]
    return _first_by(df, keys, order)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return _first_by(df, keys, [F.col(c) if isinstance(c, str) else c for c in order])


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # The sort compares its first eight bytes in place and follows a pointer to the row only
    # when they are equal. Names that begin alike make that the rule; a hash of the key,
    # ahead of the key itself, makes it the exception and nearly halves the sort.
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(window)).where("_position = 1").drop("_position")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that deduplication on the key removes."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))
    )


def fix_inverted_temps(df: DataFrame) -> DataFrame:
    """A minimum above the maximum discredits both."""
    inverted = F.col("temp_min") > F.col("temp_max")
    # one select: both columns are judged on the original pair
    return df.withColumns(
        {c: F.when(inverted, None).otherwise(F.col(c)) for c in ["temp_min", "temp_max"]}
    )


def out_of_range(column: str) -> Column:
    low, high = PLAUSIBLE[column]
    return ~F.col(column).between(low, high)


def null_out_of_range(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.when(out_of_range(c), None).otherwise(F.col(c)) for c in PLAUSIBLE}
    )


def apply_rules(df: DataFrame) -> DataFrame:
    """Inverted pairs first: a pair they remove is not judged by range any more."""
    return null_out_of_range(fix_inverted_temps(df))


def rule_counts(df: DataFrame) -> list[Column]:
    """Aggregates counting the hits of each rule, for a frame made by ``with_rule_inputs``."""
    low_rain, high_rain = PLAUSIBLE["precipitation_mm"]
    rain = F.col("precipitation_mm")
    counts = {
        "inverted_temps": F.col("_inverted"),
        "temp_max_range": out_of_range("temp_max"),
        "temp_min_range": out_of_range("temp_min"),
        "precipitation_negative": rain < low_rain,
        "precipitation_excessive": rain > high_rain,
        "wind_speed_range": out_of_range("wind_speed_max"),
        "wind_gust_range": out_of_range("wind_gust_max"),
        "probability_range": out_of_range("precipitation_prob"),
    }
    return [F.count_if(hit).alias(name) for name, hit in counts.items()]


def with_rule_inputs(df: DataFrame) -> DataFrame:
    """Rows as the range rules see them, with the verdict of the pair rule kept aside."""
    return fix_inverted_temps(df.withColumn("_inverted", F.col("temp_min") > F.col("temp_max")))


def dq_rule_counts(df: DataFrame) -> DataFrame:
    """Hits of every rule in one pass, one row per rule."""
    inputs = with_rule_inputs(df)
    counts = inputs.agg(*rule_counts(inputs))
    return counts.unpivot([], counts.columns, "rule", "hits")

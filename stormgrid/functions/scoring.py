"""Categories, score parts, levels, flags and calendar columns as native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from stormgrid import policy


def bucket(
    value: Column,
    bands: Sequence[tuple[float, str]],
    above: str,
    when_null: str | None = None,
    exactly: Sequence[tuple[float, str]] = (),
) -> Column:
    """Label of the first band whose upper bound exceeds the value."""
    arms = [(value.isNull(), when_null)] if when_null is not None else []
    arms += [(value == point, label) for point, label in exactly]
    arms += [(value < bound, label) for bound, label in bands]
    chain = F.when(arms[0][0], F.lit(arms[0][1]))
    for condition, label in arms[1:]:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(above))


def temp_category(temp: Column) -> Column:
    return bucket(temp, policy.TEMP_BANDS, policy.TEMP_ABOVE, policy.UNKNOWN)


def precipitation_category(mm: Column) -> Column:
    return bucket(mm, policy.RAIN_BANDS, policy.RAIN_ABOVE, policy.UNKNOWN, [(0.0, policy.DRY)])


def wind_category(gust: Column) -> Column:
    return bucket(gust, policy.GUST_BANDS, policy.GUST_ABOVE, policy.UNKNOWN)


def risk_level(score: Column) -> Column:
    """A null score fails every comparison and so lands in the top level."""
    return bucket(score, policy.LEVEL_BANDS, policy.LEVEL_ABOVE)


def rain_points(mm: Column, probability: Column) -> Column:
    # least() skips nulls, so the null has to become zero inside it.
    amount = F.least(F.coalesce(mm, F.lit(0.0)), F.lit(policy.RAIN_SATURATION_MM))
    chance = F.coalesce(probability, F.lit(0.0))
    return (
        amount / policy.RAIN_SATURATION_MM * policy.RAIN_AMOUNT_POINTS
        + chance / 100.0 * policy.RAIN_PROBABILITY_POINTS
    )


def gust_points(gust: Column) -> Column:
    held = F.least(F.coalesce(gust, F.lit(0.0)), F.lit(policy.GUST_SATURATION_KMH))
    return held / policy.GUST_SATURATION_KMH * policy.GUST_POINTS


def temp_points(temp: Column) -> Column:
    def capped(degrees: Column) -> Column:
        return F.least(degrees * policy.POINTS_PER_DEGREE, F.lit(policy.TEMP_POINTS_CAP))

    return (
        F.when(temp > policy.COMFORT_HIGH, capped(temp - policy.COMFORT_HIGH))
        .when(temp < policy.COMFORT_LOW, capped(policy.COMFORT_LOW - temp))
        .otherwise(0.0)
    )


def severity(code: Column) -> Column:
    """Severity by code as an in-list per severity: no lookup join, no map scan per row."""
    by_severity: dict[int, list[int]] = {}
    for known, level in policy.SEVERITY_OF_CODE.items():
        by_severity.setdefault(level, []).append(known)
    chain = F.when(code.isNull(), policy.SEVERITY_OF_NO_CODE)
    for level, codes in by_severity.items():
        chain = chain.when(code.isin(codes), level)
    return chain.otherwise(policy.SEVERITY_OF_OTHER_CODE)


def severity_points(code: Column) -> Column:
    return severity(code) * policy.POINTS_PER_SEVERITY


def quality_flag(*columns: Column) -> Column:
    lacking = sum((c.isNull().cast("int") for c in columns[1:]), columns[0].isNull().cast("int"))
    return (
        F.when(lacking == 0, policy.COMPLETE)
        .when(lacking <= policy.PARTIAL_UP_TO, policy.PARTIAL)
        .otherwise(policy.LACKING)
    )


def is_high_risk(level: Column) -> Column:
    return level.isin(policy.HIGH_RISK_LEVELS)


def day_name(day: Column) -> Column:
    """English whatever the JVM's locale: seven fixed names by weekday number."""
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(day) + 1)


def is_weekend(day: Column) -> Column:
    return F.weekday(day).isin(policy.WEEKEND_DAYS)

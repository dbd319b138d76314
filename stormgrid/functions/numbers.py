"""Rounding and averaging with results that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A double sum changes with the order of its rows. Sums of a two-digit decimal do not, and
# up to 18 digits the running sum stays a primitive long in the hash aggregate. The layers hold
# figures of at most two decimals below a million; anything else is an error, never rounded or
# left out unseen, whether or not ANSI mode is on.
EXACT = "decimal(8,2)"
EXACT_BELOW = 1e6
STEP = 1e-6


def exact_sum(value: Column) -> Column:
    number = value.cast("double")
    near = F.abs(number * 100 - F.rint(number * 100)) <= STEP
    fits = number.isNull() | ((F.abs(number) < EXACT_BELOW - 0.005) & near)
    outside = F.raise_error(F.concat(F.lit("not a figure of two decimals below a million: "), number.cast("string")))
    return F.sum(F.when(fits, value.cast(EXACT)).otherwise(outside.cast(EXACT)))


def exact_mean(value: Column) -> Column:
    """Mean as a double; null when nothing was counted."""
    return exact_sum(value).cast("double") / F.nullif(F.count(value), F.lit(0)).cast("double")


def decimal_mean(value: Column, digits: int) -> Column:
    """Mean rounded half away from zero, divided at 20 digits so that only one rounding shows."""
    n = F.nullif(F.count(value), F.lit(0)).cast("decimal(18,0)")
    return F.round(exact_sum(value) / n, digits).cast("double")


def round_tenth_even(value: Column) -> Column:
    """Nearest tenth of the scaled value, ties to even."""
    return F.rint(value * 10) / 10


def round_tenth_exact(value: Column) -> Column:
    """Nearest tenth of the exact binary value, ties to even.

    Scaling by ten is only in doubt next to a tie; there the decimal formatter, which works
    on the exact value, decides. It is slow, so it is kept off the common path.
    """
    tenths = value * 10
    near_tie = F.abs(tenths - F.floor(tenths) - 0.5) < 1e-6
    return F.when(near_tie, F.format_number(value, 1).cast("double")).otherwise(F.rint(tenths) / 10)

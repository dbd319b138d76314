"""Text to typed values; anything unreadable becomes null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# FIXED VALUES: every character a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spark's text-to-double cast also takes Java literals ("1d", "2.5f", "0x1p3").
JAVA_LETTER = r"[dDfFxX]"
JAVA_LITERAL = r"[0-9.][dDfF]\s*$|[xX]"
DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"
STAMP_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def may_be_java_literal(*texts: Column) -> Column:
    """Whether any of a row's texts holds a letter such a literal needs. One look at the row
    spares its numbers the pattern."""
    return F.concat_ws(" ", *texts).rlike(JAVA_LETTER)


def to_number(text: Column, suspect: Column) -> Column:
    """A double, possibly NaN (see ``schemas.nan_to_null``)."""
    return F.when(~(suspect & text.rlike(JAVA_LITERAL)), text.try_cast("double"))


def to_day(text: Column) -> Column:
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("date"))


def to_stamp(text: Column) -> Column:
    """Zone-less timestamps stay zone-less: the session time zone plays no part."""
    return F.when(text.rlike(STAMP_SHAPE), text.try_cast("timestamp_ntz"))


def to_whole(number: Column) -> Column:
    """Whole numbers only; a fraction is not a code, and truncating it would invent one."""
    return F.when(number == F.floor(number), number.try_cast("int"))


def safe_name(text: Column) -> Column:
    """A name usable as one path segment."""
    return F.translate(text, " /", "__")

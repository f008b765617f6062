"""Number rules: reporting scale, safe division, text to number.

Scales and percentages are double literals; a bare ``100.0`` would become a
decimal in SQL text and change every result type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BILLION = 1e9
MILLION = 1e6


def in_billions(value: Column) -> Column:
    return F.round(value / F.lit(BILLION), 2)


def in_millions(value: Column, digits: int = 1) -> Column:
    return F.round(value / F.lit(MILLION), digits)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; NULL when the whole is zero or missing."""
    return F.try_divide(F.lit(100.0) * part, whole)


def percent_change(now: Column, before: Column) -> Column:
    return percent(now - before, before)


def whole_number(text: Column) -> Column:
    """Number in a text field; NULL when absent or not a number."""
    return text.try_cast("long")


def whole_number_or_zero(text: Column) -> Column:
    return F.coalesce(whole_number(text), F.lit(0).cast("long"))


def grouped_number(text: Column) -> Column:
    """Number in a text, also one with commas between its thousands; else NULL."""
    grouped = text.cast("string").rlike(r"^\s*[+-]?\d{1,3}(,\d{3})+(\.\d*)?\s*$")
    return F.when(grouped, F.replace(text.cast("string"), F.lit(","), F.lit(""))).otherwise(text).try_cast("double")

"""Calendar rules: Sunday weeks, half-years, date parts, whole days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day``."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def half_label(day: Column) -> Column:
    """``2025H1`` for January to June, ``2025H2`` for July to December."""
    half = F.when(F.month(day) <= 6, "H1").otherwise("H2")
    return F.concat(F.year(day).cast("string"), half)


def half_start(day: Column) -> Column:
    """First day of the half-year holding ``day``."""
    return F.make_date(F.year(day), F.when(F.month(day) <= 6, 1).otherwise(7), F.lit(1))


def half_end(day: Column) -> Column:
    return F.date_sub(F.add_months(half_start(day), 6), 1)


def date_parts(day: Column) -> dict[str, Column]:
    """The columns of the date dimension for one date column.

    The week number is the ISO week of the date itself, so a Sunday carries
    the number of the week that ends on it.
    """
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "half_label": half_label(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "iso_week": F.weekofyear(day),
    }


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, cut towards zero."""
    span = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), span).cast("long")

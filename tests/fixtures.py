"""Small literal models: three dimensions and two facts built from tuples."""

from datetime import date, timedelta

from marquee import schemas
from marquee.plans import star as build
from marquee.sources.tables import Star

FIRST_SUNDAY = date(2024, 1, 7)


def week(number):
    """Sunday of week 0, 1, 2, ..."""
    return FIRST_SUNDAY + timedelta(days=7 * number)


def half_feed(spark, rows):
    """rows: (title, type, period, release, hours)."""
    full = []
    for title, kind, period, release, hours in rows:
        year, first = int(period[:4]), period.endswith("H1")
        start = date(year, 1 if first else 7, 1)
        end = date(year, 6, 30) if first else date(year, 12, 31)
        full.append((title, kind, period, start, end, "Yes", release, hours, None, None))
    return spark.createDataFrame(full, schemas.FEED_HALF)


def weekly_feed(spark, rows):
    """rows: (week number, region, title, type, rank) plus optional language,
    hours, cumulative weeks and show title."""
    full = []
    for row in rows:
        number, region, title, kind, rank, *more = row
        language, hours, weeks, show = [*more, None, None, None, None][:4]
        full.append(
            (
                week(number), region, None if region == "Global" else region[:2].upper(),
                title, show or title, "N/A", kind, language, rank, hours, None, None, weeks or 1,
            )
        )
    return spark.createDataFrame(full, schemas.FEED_WEEKLY)


def star(spark, half=(), weekly=()):
    """The model of both feeds, kept in memory only."""
    half_rows, weekly_rows = half_feed(spark, list(half)), weekly_feed(spark, list(weekly))
    titles = build.dim_title(half_rows, weekly_rows).coalesce(1).cache()
    regions = build.dim_region(weekly_rows).coalesce(1).cache()
    return Star(
        dates=build.dim_date(half_rows, weekly_rows).coalesce(1).cache(),
        titles=titles,
        regions=regions,
        weekly=build.fact_weekly(weekly_rows, titles, regions).coalesce(1).cache(),
        half=build.fact_half(half_rows, titles).coalesce(1).cache(),
    )


def tuples(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]

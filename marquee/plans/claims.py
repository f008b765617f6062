"""Checks behind the stated findings: climbs, re-entries, reach, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import text
from marquee.functions.numbers import in_millions
from marquee.operators import carried, movement
from marquee.plans.kpis import countries

TITLE = ["title_name", "content_type"]


def _named(
    rows: DataFrame, regions: DataFrame, titles: DataFrame, title_name: str | None = None
) -> DataFrame:
    """Country rows of a week with region and title names, or those of one title.

    Names are joined to the one week asked about, never to the history.
    """
    wanted = titles.select("title_id", "title_name")
    if title_name is not None:
        wanted = wanted.filter(F.col("title_name") == title_name)
    return countries(rows, regions).join(wanted, "title_id")


def _week(weekly: DataFrame, as_of: Column | None) -> Column:
    return movement.latest_week(weekly) if as_of is None else as_of


def climbers(
    weekly: DataFrame,
    regions: DataFrame,
    titles: DataFrame,
    as_of: Column | None = None,
    title_name: str | None = None,
) -> DataFrame:
    """Markets in which a title rose against the week before."""
    moved = movement.with_week_before(weekly, _week(weekly, as_of))
    return (
        _named(moved, regions, titles, title_name)
        .filter(movement.improvement() > 0)
        .select(
            *TITLE, "region_name", "weekly_rank", "prior_rank",
            movement.improvement().alias("improvement"),
        )
        .orderBy(F.desc("improvement"), *TITLE, "region_name")
    )


def climb_summary(
    weekly: DataFrame,
    regions: DataFrame,
    titles: DataFrame,
    as_of: Column | None = None,
    title_name: str | None = None,
) -> DataFrame:
    """Per title: markets it climbed in, and the range of the climbs."""
    return (
        climbers(weekly, regions, titles, as_of, title_name)
        .groupBy(*TITLE)
        .agg(
            F.count(F.lit(1)).alias("markets_climbed"),
            F.min("improvement").alias("smallest_climb"),
            F.max("improvement").alias("largest_climb"),
        )
        .orderBy(*TITLE)
    )


def reentries(
    weekly: DataFrame,
    regions: DataFrame,
    titles: DataFrame,
    as_of: Column | None = None,
    title_name: str | None = None,
) -> DataFrame:
    """Per title: markets it charts in without having charted the week before.

    A first appearance counts as well; :func:`movement_states` tells the two
    apart.
    """
    entered = movement.without_week_before(weekly, _week(weekly, as_of))
    return (
        _named(entered, regions, titles, title_name)
        .groupBy(*TITLE)
        .agg(F.count(F.lit(1)).alias("markets_entered"))
        .orderBy(*TITLE)
    )


def movement_states(
    weekly: DataFrame, regions: DataFrame, titles: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Country chart rows of one week by what happened to them.

    Telling a debut from a comeback takes the whole history.
    """
    moved = movement.in_week(movement.with_prior(weekly), _week(weekly, as_of))
    return (
        _named(moved, regions, titles)
        .groupBy("content_type", movement.state().alias("state"))
        .agg(F.count(F.lit(1)).alias("chart_rows"))
        .orderBy("content_type", "state")
    )


def carried_states(week: DataFrame, state: DataFrame, regions: DataFrame, titles: DataFrame) -> DataFrame:
    """:func:`movement_states` of one week from the state of the weeks before it."""
    moved = carried.with_carried(week, state)
    return (
        _named(moved, regions, titles)
        .groupBy("content_type", movement.state().alias("state"))
        .agg(F.count(F.lit(1)).alias("chart_rows"))
        .orderBy("content_type", "state")
    )


def market_reach(weekly: DataFrame, regions: DataFrame, titles: DataFrame) -> DataFrame:
    """Number of country charts holding a title in each week."""
    return (
        countries(weekly, regions)
        .groupBy("title_id", "date_key")
        .agg(F.count_distinct("region_id").alias("markets"))
        .join(titles, "title_id")
        .select(*TITLE, "date_key", "markets")
        .orderBy(*TITLE, "date_key")
    )


def premiere_lift(
    weekly: DataFrame, regions: DataFrame, titles: DataFrame, shows: DataFrame
) -> DataFrame:
    """Reach of a show's earlier seasons around each later season's premiere.

    ``shows`` maps ``title_id`` to ``show_title``. A market counts when any
    earlier season charts there. Instead of pairing seasons, each (show,
    market, week) keeps the oldest premiere charting in it: a season older
    than the new one charts there exactly if that oldest premiere is older.
    """
    worldwide = regions.filter("is_global").agg(F.max("region_id")).scalar()
    rows = weekly.filter(F.col("region_id") != worldwide).select("title_id", "date_key", "region_id")
    # One row per season, taken from the chart rows before any join to them.
    premieres = (
        rows.groupBy("title_id").agg(F.min("date_key").alias("premiere")).join(shows, "title_id")
    )
    offsets = {"before": -movement.WEEK_DAYS, "premiere": 0, "after": movement.WEEK_DAYS}
    looked_at = F.array(
        *[
            F.struct(F.lit(name).alias("moment"), F.date_add("premiere", days).alias("date_key"))
            for name, days in offsets.items()
        ]
    )
    first_season = premieres.groupBy("show_title").agg(F.min("premiere").alias("first_premiere"))
    later = premieres.join(first_season, "show_title").filter(
        F.col("premiere") > F.col("first_premiere")
    )
    asked = later.select(
        "show_title", "title_id", "premiere", F.inline(looked_at)
    )
    # Three weeks a season are asked about; other weeks of a show are dropped before the aggregate.
    oldest_on_chart = (
        rows.join(premieres, "title_id")
        .join(asked.select("show_title", "date_key").distinct(), ["show_title", "date_key"], "left_semi")
        .groupBy("show_title", "date_key", "region_id")
        .agg(F.min("premiere").alias("oldest"))
    )
    reached = asked.join(oldest_on_chart, ["show_title", "date_key"], "left").withColumn(
        "earlier", F.col("oldest") < F.col("premiere")
    )
    counts = [
        F.count_if((F.col("moment") == name) & F.col("earlier")).alias(f"markets_{name}")
        for name in offsets
    ]
    return (
        reached.groupBy("show_title", "title_id", "premiere")
        .agg(*counts)
        .join(titles.select("title_id", "title_name"), "title_id")
        .select(
            "show_title", "title_name", F.col("premiere").alias("premiere_week"),
            *[f"markets_{name}" for name in offsets],
        )
        .orderBy("show_title", "premiere_week", "title_name")
    )


def type_average(half: DataFrame, period: str) -> DataFrame:
    """Mean hours and rows by type in one half-year."""
    return (
        half.filter(F.col("period_label") == period)
        .groupBy("content_type")
        .agg(
            in_millions(F.avg("hours_viewed"), 2).alias("avg_m"),
            F.count(F.lit(1)).alias("titles"),
        )
        .orderBy("content_type")
    )


def type_ratio(half: DataFrame, period: str) -> DataFrame:
    """Hours per show over hours per movie in one half-year, in one pass."""

    def mean_of(kind: str) -> Column:
        return F.avg(F.when(F.col("content_type") == kind, F.col("hours_viewed")))

    return half.filter(F.col("period_label") == period).agg(
        F.round(F.try_divide(mean_of(text.SHOW), mean_of(text.MOVIE)), 2).alias(
            "show_movie_hours_per_title_ratio"
        )
    )


def chart_span(weekly: DataFrame) -> DataFrame:
    return weekly.agg(F.min("date_key").alias("first_week"), F.max("date_key").alias("last_week"))


def country_count(regions: DataFrame) -> DataFrame:
    return regions.filter(~F.col("is_global")).agg(F.count(F.lit(1)).alias("countries"))

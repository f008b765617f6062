"""Chart history: where a title stood the week before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------
WEEK_DAYS = 7
# ----------------------------------------------------------------------------


def latest(df: DataFrame, column: str = "date_key") -> Column:
    """Newest value of ``column`` as a scalar subquery, run once."""
    return df.agg(F.max(column)).scalar()


def latest_week(weekly: DataFrame) -> Column:
    """Newest week; where the table is split by year, only the newest year is read."""
    if "year" in weekly.columns:
        weekly = weekly.filter(F.col("year") == latest(weekly, "year"))
    return latest(weekly)


def in_week(weekly: DataFrame, week: Column) -> DataFrame:
    """Rows of one week; prunes to its year where the table is split by year."""
    rows = weekly.filter(F.col("date_key") == week)
    return rows.filter(F.col("year") == F.year(week)) if "year" in weekly.columns else rows


def since(weekly: DataFrame, first: Column) -> DataFrame:
    """Rows from ``first`` on, with the same pruning."""
    rows = weekly.filter(F.col("date_key") >= first)
    return rows.filter(F.col("year") >= F.year(first)) if "year" in weekly.columns else rows


def with_prior(weekly: DataFrame) -> DataFrame:
    """Rank and week of the title's previous chart row in the same market.

    Must see the whole history: filtering to a week first would leave one row
    per title and no prior at all. A group is one title in one market, so it
    holds at most one row per calendar week.
    """
    history = W.partitionBy("region_id", "title_id").orderBy("date_key")
    return weekly.withColumns(
        {
            "prior_rank": F.lag("weekly_rank").over(history),
            "prior_date": F.lag("date_key").over(history),
        }
    )


def is_consecutive() -> Column:
    return F.col("prior_date") == F.date_sub("date_key", WEEK_DAYS)


def improvement() -> Column:
    """Places gained; positive is up the chart."""
    return F.col("prior_rank") - F.col("weekly_rank")


def _week_before(weekly: DataFrame, week: Column) -> DataFrame:
    return in_week(weekly, F.date_sub(week, WEEK_DAYS)).select(
        "region_id", "title_id", F.col("weekly_rank").alias("prior_rank")
    )


def with_week_before(weekly: DataFrame, week: Column) -> DataFrame:
    """Rows of ``week`` joined to the same title and market seven days earlier.

    The two-week form of :func:`with_prior` for rows charted in both weeks: it
    reads two weeks instead of the whole history. Equal to the lag form as
    (market, title, week) is unique.
    """
    return in_week(weekly, week).join(_week_before(weekly, week), ["region_id", "title_id"])


def without_week_before(weekly: DataFrame, week: Column) -> DataFrame:
    """Rows of ``week`` whose title did not chart there seven days earlier."""
    return in_week(weekly, week).join(
        _week_before(weekly, week), ["region_id", "title_id"], "left_anti"
    )


def state() -> Column:
    """What happened to a chart row since the week before."""
    return (
        F.when(F.col("prior_date").isNull(), "debut")
        .when(~is_consecutive(), "comeback")
        .when(improvement() > 0, "climbed")
        .when(improvement() < 0, "fell")
        .otherwise("unchanged")
    )

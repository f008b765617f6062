"""Headline questions: hours, mix, trend, concentration, movers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.functions import text
from marquee.functions.numbers import in_billions, in_millions, percent, percent_change
from marquee.operators import movement

# Fixed values ---------------------------------------------------------------
TOP_TITLES = 10
REPORT_ROWS = 15
TREND_WEEKS = 26
TRAILING_ROWS = 4
# Both ends count, so this spans 53 chart weeks.
ALIGNMENT_DAYS = 364
# ----------------------------------------------------------------------------


def _before(column: str) -> Column:
    """Value one half-year earlier. This window, like the one of the weekly
    trend, has no partition keys: it runs after aggregation, over one row per
    period, so its input is bounded by the calendar."""
    return F.lag(column).over(W.orderBy("period_label"))


def worldwide(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows of the worldwide chart."""
    region = regions.filter(F.col("region_name") == text.GLOBAL_REGION).select("region_id")
    return weekly.join(region, "region_id")


def countries(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows of the country charts, with the market's name and code."""
    markets = regions.filter(~F.col("is_global")).select("region_id", "region_name", "iso2")
    return weekly.join(markets, "region_id")


# Totals ---------------------------------------------------------------------


def topline(half: DataFrame) -> DataFrame:
    """Titles, total hours and hours per row for each half-year."""
    return (
        half.groupBy("period_label")
        .agg(
            F.count_distinct("title_id").alias("titles_tracked"),
            in_billions(F.sum("hours_viewed")).alias("total_hours_billion"),
            in_millions(F.avg("hours_viewed"), 2).alias("avg_hours_per_title_million"),
        )
        .orderBy("period_label")
    )


def top_titles(half: DataFrame, titles: DataFrame, top: int = TOP_TITLES) -> DataFrame:
    """Best titles of each half-year and the share of hours they add up to.

    The rank filter sits directly on the window, so Spark limits each group
    before its shuffle, and names are joined to what is left of it. Every row
    ahead of a kept row is kept too, which lets the running sum follow the
    filter; period totals come from their own aggregate so that no window ever
    holds a whole period. Ids come from the dimension, so a row counts if it
    has one.
    """
    rows = half.filter(F.col("title_id").isNotNull()).select(
        "period_label", "title_id", "content_type", "hours_viewed"
    )
    by_hours = W.partitionBy("period_label").orderBy(F.desc_nulls_last("hours_viewed"))
    leading = (
        rows.withColumn("rank_in_period", F.rank().over(by_hours))
        .filter(F.col("rank_in_period") <= top)
        .join(titles.select("title_id", "title_name"), "title_id")
    )
    down_the_list = (
        W.partitionBy("period_label")
        .orderBy(F.desc_nulls_last("hours_viewed"), "title_name", "content_type")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    totals = rows.groupBy("period_label").agg(F.sum("hours_viewed").alias("period_hours"))
    return (
        leading.withColumn("running_hours", F.sum("hours_viewed").over(down_the_list))
        .join(totals, "period_label")
        .select(
            "period_label",
            F.col("rank_in_period").cast("long").alias("rank_in_period"),
            "title_name",
            "content_type",
            in_millions(F.col("hours_viewed")).alias("hours_viewed_million"),
            F.round(percent(F.col("running_hours"), F.col("period_hours")), 2).alias(
                "cumulative_pct_of_total_hours"
            ),
        )
        .orderBy(
            "period_label",
            "rank_in_period",
            "title_name",
            "content_type",
            "cumulative_pct_of_total_hours",
        )
    )


def _type_totals(half: DataFrame) -> DataFrame:
    """Hours, rows and mean hours per half-year and type: a handful of rows."""
    return half.groupBy("period_label", "content_type").agg(
        F.sum("hours_viewed").alias("hours"),
        F.avg("hours_viewed").alias("mean_hours"),
        F.count(F.lit(1)).alias("titles"),
    )


def content_type_mix(half: DataFrame) -> DataFrame:
    period = W.partitionBy("period_label")
    return (
        _type_totals(half)
        .select(
            "period_label",
            "content_type",
            in_billions(F.col("hours")).alias("hours_billion"),
            F.round(percent(F.col("hours"), F.sum("hours").over(period)), 1).alias(
                "pct_of_period_hours"
            ),
            in_millions(F.col("mean_hours"), 2).alias("avg_hours_per_title_million"),
            "titles",
        )
        .orderBy("period_label", "content_type")
    )


def _language_totals(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    return (
        worldwide(weekly, regions)
        .groupBy("language", "content_type")
        .agg(
            F.sum("hours_viewed").alias("hours"),
            F.count_distinct("title_id").alias("titles"),
        )
    )


def language_mix(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Worldwide chart hours by language and type."""
    return (
        _language_totals(weekly, regions)
        .select(
            "language",
            "content_type",
            in_billions(F.col("hours")).alias("hours_billion"),
            F.col("titles").alias("distinct_titles_in_top10"),
        )
        .orderBy(F.desc("hours_billion"), "language", "content_type")
    )


def language_yield(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Hours earned per charted title, by language and type."""
    return (
        _language_totals(weekly, regions)
        .select(
            "language",
            "content_type",
            F.col("titles").alias("distinct_titles_in_top10"),
            in_billions(F.col("hours")).alias("hours_billion"),
            in_millions(F.try_divide("hours", "titles"), 2).alias("hours_per_title_million"),
        )
        .orderBy("language", "content_type")
    )


# Trend ----------------------------------------------------------------------


def _period_totals(half: DataFrame) -> DataFrame:
    return half.groupBy("period_label").agg(F.sum("hours_viewed").alias("hours"))


def half_growth(half: DataFrame) -> DataFrame:
    """Hours of each half-year against the half before."""
    before = _before("hours")
    return (
        _period_totals(half)
        .select(
            "period_label",
            in_billions(F.col("hours")).alias("total_hours_billion"),
            in_billions(F.col("hours") - before).alias("change_vs_prior_half_billion"),
            F.round(percent_change(F.col("hours"), before), 2).alias("pct_change_vs_prior_half"),
        )
        .orderBy("period_label")
    )


def growth_acceleration(half: DataFrame) -> DataFrame:
    """How the growth rate itself changes from half to half."""
    grown = _period_totals(half).withColumn(
        "pct", percent_change(F.col("hours"), _before("hours"))
    )
    return grown.select(
        "period_label",
        F.round("pct", 2).alias("pct_change_vs_prior_half"),
        F.round(F.col("pct") - _before("pct"), 2).alias("acceleration_pct_points"),
    ).orderBy("period_label")


def yoy_growth(half: DataFrame) -> DataFrame:
    """Titles and hours against the same half of the year before.

    Joined on the label of that half, so a missing half gives NULL rather
    than a comparison with the wrong one.
    """
    now = half.groupBy("period_label").agg(
        F.count_distinct("title_id").alias("titles"), F.sum("hours_viewed").alias("hours")
    )
    next_year = (F.substring("period_label", 1, 4).cast("int") + 1).cast("string")
    year_ago = now.select(
        F.concat(next_year, F.substring("period_label", 5, 2)).alias("period_label"),
        F.col("titles").alias("titles_ago"),
        F.col("hours").alias("hours_ago"),
    )
    return (
        now.join(year_ago, "period_label", "left")
        .select(
            "period_label",
            "titles",
            F.col("titles_ago").alias("titles_year_ago"),
            F.round(percent_change(F.col("titles"), F.col("titles_ago")), 2).alias(
                "pct_change_titles"
            ),
            in_billions(F.col("hours")).alias("total_hours_billion"),
            F.round(percent_change(F.col("hours"), F.col("hours_ago")), 2).alias(
                "pct_change_hours"
            ),
        )
        .orderBy("period_label")
    )


def type_growth(half: DataFrame) -> DataFrame:
    """Each type against its own prior half, and its share of all titles."""
    of_type = W.partitionBy("content_type").orderBy("period_label")
    titles_in_period = F.sum("titles").over(W.partitionBy("period_label"))
    return (
        _type_totals(half)
        .select(
            "content_type",
            "period_label",
            in_billions(F.col("hours")).alias("hours_billion"),
            "titles",
            F.round(percent_change(F.col("hours"), F.lag("hours").over(of_type)), 2).alias(
                "pct_change_hours"
            ),
            F.round(percent_change(F.col("titles"), F.lag("titles").over(of_type)), 2).alias(
                "pct_change_titles"
            ),
            F.round(percent(F.col("titles"), titles_in_period), 1).alias("pct_of_titles"),
        )
        .orderBy("content_type", "period_label")
    )


def weekly_trend(weekly: DataFrame, regions: DataFrame, weeks: int = TREND_WEEKS) -> DataFrame:
    """Newest weeks of worldwide chart hours with a trailing four-row mean.

    The mean sees all weeks; the cut to the newest ones follows it.
    """
    totals = (
        worldwide(weekly, regions).groupBy("date_key").agg(F.sum("hours_viewed").alias("hours"))
    )
    trailing = W.orderBy("date_key").rowsBetween(1 - TRAILING_ROWS, W.currentRow)
    return (
        totals.select(
            "date_key",
            in_millions(F.col("hours")).alias("weekly_hours_million"),
            in_millions(F.avg("hours").over(trailing)).alias("trailing_4wk_avg_million"),
        )
        .orderBy(F.desc("date_key"))
        .limit(weeks)
    )


# Markets --------------------------------------------------------------------


def _stickiness(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Mean of the running week counter over chart rows, so that long runs
    weigh by their length."""
    return (
        countries(weekly, regions)
        .groupBy("region_name", "iso2")
        .agg(
            F.avg("cumulative_weeks_in_top10").alias("mean_weeks"),
            F.count_distinct("title_id").alias("distinct_titles_ever_in_top10"),
        )
    )


def stickiness(
    weekly: DataFrame,
    regions: DataFrame,
    bottom: bool = False,
    limit: int | None = REPORT_ROWS,
) -> DataFrame:
    """Markets by how long titles stay in their chart."""
    weeks = "avg_weeks_a_title_sticks_in_top10"
    ordered = (
        _stickiness(weekly, regions)
        .select(
            "region_name",
            "iso2",
            F.round("mean_weeks", 2).alias(weeks),
            "distinct_titles_ever_in_top10",
        )
        .orderBy(F.asc(weeks) if bottom else F.desc(weeks), "region_name")
    )
    return ordered if limit is None else ordered.limit(limit)


def stickiness_spread(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Longest against shortest mean stay over all markets."""
    return (
        _stickiness(weekly, regions)
        .agg(F.max("mean_weeks").alias("longest"), F.min("mean_weeks").alias("shortest"))
        .select(
            F.round("longest", 2).alias("longest_avg_weeks"),
            F.round("shortest", 2).alias("shortest_avg_weeks"),
            F.round(F.try_divide("longest", "shortest"), 2).alias("spread_ratio"),
        )
    )


def global_alignment(
    weekly: DataFrame,
    regions: DataFrame,
    content_type: str | None = None,
    days: int = ALIGNMENT_DAYS,
    limit: int | None = REPORT_ROWS,
) -> DataFrame:
    """How often a market's number one is the worldwide English number one."""
    matching = "pct_weeks_matching_global_no1"
    recent = movement.since(weekly, F.date_sub(movement.latest_week(weekly), days)).filter(
        F.col("weekly_rank") == 1
    )
    if content_type is not None:
        recent = recent.filter(F.col("content_type") == content_type)
    leaders = (
        worldwide(recent, regions)
        .filter(F.col("language") == text.ENGLISH)
        .select("date_key", "content_type", F.col("title_id").alias("worldwide_title"))
    )
    same: Column = F.col("title_id") == F.col("worldwide_title")
    ordered = (
        countries(recent, regions)
        .join(leaders, ["date_key", "content_type"])
        .groupBy("region_name", "content_type")
        .agg(
            F.round(F.lit(100.0) * F.count_if(same) / F.count(F.lit(1)), 1).alias(matching),
            F.count(F.lit(1)).alias("weeks_compared"),
        )
        .orderBy(F.desc(matching), "region_name", "content_type")
    )
    return ordered if limit is None else ordered.limit(limit)


def market_profile(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Stickiness beside alignment for every market and type."""
    aligned = global_alignment(weekly, regions, limit=None)
    sticky = stickiness(weekly, regions, limit=None)
    return (
        sticky.join(aligned, "region_name")
        .select(
            "region_name",
            "iso2",
            "content_type",
            "avg_weeks_a_title_sticks_in_top10",
            "distinct_titles_ever_in_top10",
            "pct_weeks_matching_global_no1",
            "weeks_compared",
        )
        .orderBy("region_name", "content_type")
    )


# Movers ---------------------------------------------------------------------


def _movers_report(
    moved: DataFrame, regions: DataFrame, titles: DataFrame, down: bool, limit: int | None
) -> DataFrame:
    gain = "rank_improvement"
    ordered = (
        moved.join(regions.select("region_id", "region_name"), "region_id")
        .join(titles.select("title_id", "title_name"), "title_id")
        .select(
            "region_name",
            "title_name",
            "weekly_rank",
            F.col("prior_rank").alias("prior_week_rank"),
            movement.improvement().alias(gain),
            "content_type",
        )
        .orderBy(F.asc(gain) if down else F.desc(gain), "region_name", "title_name", "content_type")
    )
    return (ordered if limit is None else ordered.limit(limit)).drop("content_type")


def movers(
    weekly: DataFrame,
    regions: DataFrame,
    titles: DataFrame,
    down: bool = False,
    include_global: bool = True,
    limit: int | None = REPORT_ROWS,
) -> DataFrame:
    """Largest rank changes of the newest week, in week-to-week chart runs.

    Only moves between consecutive weeks count, so the two newest weeks tell
    all of them and the history is not read.
    """
    charts = weekly if include_global else countries(weekly, regions).select(weekly.columns)
    moved = movement.with_week_before(charts, movement.latest_week(weekly))
    return _movers_report(moved, regions, titles, down, limit)


def movers_by_lag(
    weekly: DataFrame,
    regions: DataFrame,
    titles: DataFrame,
    down: bool = False,
    limit: int | None = REPORT_ROWS,
) -> DataFrame:
    """The same report from the previous chart row of every title, over the whole history."""
    moved = movement.in_week(movement.with_prior(weekly), movement.latest_week(weekly)).filter(
        F.col("prior_rank").isNotNull() & movement.is_consecutive()
    )
    return _movers_report(moved, regions, titles, down, limit)


# Cards ----------------------------------------------------------------------


def sliced_topline(
    half: DataFrame,
    weekly: DataFrame,
    regions: DataFrame,
    first_period: str | None = None,
    last_period: str | None = None,
    content_type: str | None = None,
    region_names: list[str] | None = None,
) -> DataFrame:
    """Card row under the report's slicers: period range, type, regions.

    Hours come from the half-year fact, which has no region; the region slicer
    acts on the count of charted regions.
    """
    from marquee.functions.calendar import half_label

    charts = weekly.join(regions.select("region_id", "region_name"), "region_id")
    label = half_label(F.col("date_key"))
    if first_period is not None:
        half = half.filter(F.col("period_label") >= first_period)
        charts = charts.filter(label >= first_period)
    if last_period is not None:
        half = half.filter(F.col("period_label") <= last_period)
        charts = charts.filter(label <= last_period)
    if content_type is not None:
        half = half.filter(F.col("content_type") == content_type)
        charts = charts.filter(F.col("content_type") == content_type)
    if region_names is not None:
        charts = charts.filter(F.col("region_name").isin(*region_names))
    charted = charts.agg(F.count_distinct("region_id")).scalar()
    return half.agg(
        in_billions(F.sum("hours_viewed")).alias("total_hours_billion"),
        F.count_distinct("title_id").alias("titles_tracked"),
        in_millions(F.avg("hours_viewed"), 2).alias("avg_hours_per_title_million"),
    ).withColumn("distinct_regions", charted)

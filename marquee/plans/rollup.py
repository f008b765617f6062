"""Roll-ups that merge: distinct titles as bitmaps beside the sums of each slice.

A distinct count of a union is not the sum of the counts, so counts cannot be stored. Title ids are
dense, so the titles of a slice are bitmaps of 32,768 ids each instead: bitmaps of any slices are merged by OR and
counted exactly, and no fact row is read. A new load is a roll-up of its own, appended. Slices are coarse (period, type,
market); a bitmap has 4 KB however few bits are set, so finer groups, such as a title's markets in a week, are better counted from the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.calendar import half_label
from marquee.functions.numbers import in_billions, in_millions

HALF_SLICE = ["period_label", "content_type"]
CHART_SLICE = ["period_label", "content_type", "region_id"]


def _titles() -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position("title_id")).alias("titles")


def _ids() -> Column:
    return F.bitmap_bucket_number("title_id").alias("ids")


def half_rollup(half: DataFrame) -> DataFrame:
    """Half-year fact by period and type: rows, hours, titles. ``ids`` numbers the bitmaps of a slice."""
    return half.groupBy(*HALF_SLICE, _ids()).agg(
        F.sum("hours_viewed").alias("hours"), F.count("hours_viewed").alias("rows"), _titles()
    )


def chart_rollup(weekly: DataFrame) -> DataFrame:
    """Weekly fact by half-year of the week, type and market: rows, weeks charted so far, titles."""
    period = half_label(F.col("date_key")).alias("period_label")
    return weekly.groupBy(period, *CHART_SLICE[1:], _ids()).agg(
        F.sum("cumulative_weeks_in_top10").alias("weeks"), F.count("cumulative_weeks_in_top10").alias("rows"), _titles()
    )


def merged(rollup: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """``keys``, the sums, and ``distinct_titles`` of all slices that share the keys."""
    added = [F.sum(name).alias(name) for name in sums]
    by_ids = rollup.groupBy(*keys, "ids").agg(*added, F.bitmap_or_agg("titles").alias("titles"))
    return by_ids.groupBy(*keys).agg(*added, F.coalesce(F.sum(F.bitmap_count("titles")), F.lit(0)).alias("distinct_titles"))


def topline(rollup: DataFrame) -> DataFrame:
    """:func:`marquee.plans.kpis.topline` from the roll-up."""
    return (
        merged(rollup, ["period_label"], ["hours", "rows"])
        .select(
            "period_label",
            F.col("distinct_titles").alias("titles_tracked"),
            in_billions(F.col("hours")).alias("total_hours_billion"),
            in_millions(F.try_divide("hours", "rows"), 2).alias("avg_hours_per_title_million"),
        )
        .orderBy("period_label")
    )


def stickiness(rollup: DataFrame, regions: DataFrame, limit: int) -> DataFrame:
    """:func:`marquee.plans.kpis.stickiness` from the roll-up."""
    weeks = "avg_weeks_a_title_sticks_in_top10"
    markets = regions.filter(~F.col("is_global")).select("region_id", "region_name", "iso2")
    return (
        merged(rollup, ["region_id"], ["weeks", "rows"])
        .join(markets, "region_id")
        .select(
            "region_name",
            "iso2",
            F.round(F.try_divide("weeks", "rows"), 2).alias(weeks),
            F.col("distinct_titles").alias("distinct_titles_ever_in_top10"),
        )
        .orderBy(F.desc(weeks), "region_name")
        .limit(limit)
    )


def sliced_topline(
    half: DataFrame,
    charts: DataFrame,
    regions: DataFrame,
    first_period: str | None = None,
    last_period: str | None = None,
    content_type: str | None = None,
    region_names: list[str] | None = None,
) -> DataFrame:
    """:func:`marquee.plans.kpis.sliced_topline` from the roll-ups."""
    keep = F.lit(True)
    if first_period is not None:
        keep = keep & (F.col("period_label") >= first_period)
    if last_period is not None:
        keep = keep & (F.col("period_label") <= last_period)
    if content_type is not None:
        keep = keep & (F.col("content_type") == content_type)
    charted = charts.filter(keep).join(regions.select("region_id", "region_name"), "region_id")
    if region_names is not None:
        charted = charted.filter(F.col("region_name").isin(*region_names))
    return merged(half.filter(keep), [], ["hours", "rows"]).select(
        in_billions(F.col("hours")).alias("total_hours_billion"),
        F.col("distinct_titles").alias("titles_tracked"),
        in_millions(F.try_divide("hours", "rows"), 2).alias("avg_hours_per_title_million"),
        charted.agg(F.count_distinct("region_id")).scalar().alias("distinct_regions"),
    )

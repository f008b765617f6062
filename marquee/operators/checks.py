"""Data-quality reports to run after a load, in place of enforced keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import numbers, text
from marquee.sources.tables import Star


def title_collisions(half: DataFrame) -> DataFrame:
    """Titles standing for several works in one half-year."""
    return (
        half.groupBy("title_id", "period_label")
        .agg(
            F.count(F.lit(1)).alias("works"),
            F.count_distinct("release_date").alias("release_dates"),
        )
        .filter(F.col("works") > 1)
    )


def chart_slots(weekly: DataFrame, regions: DataFrame, slots: int = 10) -> DataFrame:
    """Country charts that do not hold exactly ``slots`` rows, empty ones too.

    Every chart week has one chart per market and type. The markets are a
    short list, put beside each week, so the charts due are bounded by the
    calendar.
    """
    markets = regions.filter(~F.col("is_global")).select("region_id", "region_name")
    listed = markets.agg(F.collect_list(F.struct("region_id", "region_name"))).scalar()
    types = F.array(F.lit(text.SHOW), F.lit(text.MOVIE))
    due = (
        weekly.select("date_key")
        .distinct()
        .select("date_key", F.explode(listed).alias("market"))
        .select("date_key", "market.*", F.explode(types).alias("content_type"))
    )
    chart = ["date_key", "region_id", "content_type"]
    filled = weekly.groupBy(*chart).agg(F.count(F.lit(1)).alias("filled"))
    return (
        due.join(filled, chart, "left")
        .select(
            "date_key",
            "region_name",
            "content_type",
            F.coalesce("filled", F.lit(0)).cast("long").alias("slots_filled"),
        )
        .filter(F.col("slots_filled") != slots)
    )


def orphans(star: Star) -> DataFrame:
    """Fact rows whose key is NULL or finds no dimension row; each fact is read once."""
    found = [
        _orphans("fact_top10_weekly", star.weekly, {"title_id": star.titles, "region_id": star.regions, "date_key": star.dates}),
        _orphans("fact_engagement_half", star.half, {"title_id": star.titles, "date_key": star.dates}),
    ]
    return reduce(DataFrame.unionByName, found)


def _orphans(name: str, fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    # Dimension keys are distinct, so the joins neither lose nor multiply rows.
    rows = fact.select(*dimensions)
    for key, dimension in dimensions.items():
        known = dimension.select(F.col(key).alias(f"_{key}"))
        rows = rows.join(known, F.col(key) == F.col(f"_{key}"), "left")
    lost = [F.count_if(F.col(f"_{key}").isNull()).alias(key) for key in dimensions]
    listed = F.inline(F.array(*(F.struct(F.lit(key).alias("key_name"), F.col(key).alias("orphan_rows")) for key in dimensions)))
    return rows.agg(*lost).select(F.lit(name).alias("table_name"), listed)


def key_compare(feed: DataFrame) -> DataFrame:
    """Chart rows sharing one key in one chart, under the season-aware title
    key and under the generic show title."""
    chart = ["region_name", "week_start_date", "content_type", "language"]
    keys = {"season_title": F.col("title_name"), "show_title": text.strip(F.col("show_title"))}

    def report(kind: str) -> DataFrame:
        return (
            feed.groupBy(*chart, keys[kind].alias("key"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .agg(
                F.count_if(F.col("rows") > 1).alias("merged_groups"),
                F.coalesce(
                    F.sum(F.when(F.col("rows") > 1, F.col("rows") - 1)), F.lit(0)
                ).alias("merged_rows"),
            )
            .select(F.lit(kind).alias("key_kind"), "merged_groups", "merged_rows")
        )

    return report("season_title").unionByName(report("show_title"))


def feed_overlap(star: Star) -> DataFrame:
    """Titles by the feed they occur in: both, half-year only, charts only."""
    seen = (
        star.half.select("title_id", F.lit(1).alias("in_half"), F.lit(0).alias("in_charts"))
        .unionByName(
            star.weekly.select("title_id", F.lit(0).alias("in_half"), F.lit(1).alias("in_charts"))
        )
        .groupBy("title_id")
        .agg(F.max("in_half").alias("in_half"), F.max("in_charts").alias("in_charts"))
    )
    half, charts = F.col("in_half") == 1, F.col("in_charts") == 1
    return (
        seen.join(star.titles, "title_id")
        .groupBy("content_type")
        .agg(
            F.count_if(half & charts).alias("in_both"),
            F.count_if(half & ~charts).alias("half_only"),
            F.count_if(~half & charts).alias("charts_only"),
        )
    )


def table_counts(star: Star) -> DataFrame:
    """Rows per modelled table and of both facts together."""
    tables = {
        "dim_date": star.dates,
        "dim_title": star.titles,
        "dim_region": star.regions,
        "fact_top10_weekly": star.weekly,
        "fact_engagement_half": star.half,
    }
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ],
    )
    both = (
        counts.filter(F.col("table_name").startswith("fact_"))
        .agg(F.sum("row_count").alias("row_count"))
        .select(F.lit("both facts").alias("table_name"), "row_count")
    )
    return counts.unionByName(both)


def unparsed(
    half: DataFrame | None = None,
    worldwide: DataFrame | None = None,
    country: DataFrame | None = None,
) -> DataFrame:
    """Landed values that are there but did not parse or map, by feed and rule.

    Parsing turns them into NULL or into the default category, so sums and
    mixes shrink or shift without any error. Each feed is read once.
    """

    def lost(raw: str, parsed: Column) -> Column:
        return text.present(F.col(raw).cast("string")).isNotNull() & parsed.isNull()

    number = numbers.grouped_number
    rules: list[tuple[str, DataFrame | None, dict[str, Column]]] = [
        (
            "half-year",
            half,
            {
                "runtime": lost("Runtime", text.runtime_minutes(F.col("Runtime"))),
                "hours": lost("Hours Viewed", number(F.col("Hours Viewed"))),
                "views": lost("Views", number(F.col("Views"))),
                "release date": lost("Release Date", F.col("Release Date").try_cast("date")),
            },
        ),
        ("worldwide", worldwide, {"category": ~F.coalesce("category", F.lit("")).isin(*text.WORLDWIDE_CATEGORIES)}),
        ("country", country, {"category": ~F.coalesce("category", F.lit("")).isin(*text.COUNTRY_CATEGORIES)}),
    ]
    found = [
        df.agg(*(F.count_if(rule).alias(name) for name, rule in own.items())).select(
            F.lit(feed).alias("feed"),
            F.inline(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("values")) for n in own))),
        )
        for feed, df, own in rules
        if df is not None
    ]
    return reduce(DataFrame.unionByName, found)


def record_counts(feeds: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """``feed, good_records, rejected_records`` of landed feeds, each with what tells its good records."""
    counts = [
        landed.agg(F.count_if(good).alias("good_records"), F.count_if(~good).alias("rejected_records")).select(
            F.lit(feed).alias("feed"), "good_records", "rejected_records"
        )
        for feed, (landed, good) in feeds.items()
    ]
    return reduce(DataFrame.unionByName, counts)

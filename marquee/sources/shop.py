"""Commerce tables read as viewing data.

The feeds this library conforms are not public downloads we can ship, so the
same feeds are derived from order lines: a line is a viewing of a title, its
quantity the hours, the customer's nation the market, the order date the day.
Every function returns a feed in its *landed* form, so all conforming steps
run on it as they would on the real files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.functions import calendar, text
from marquee.session import sized

# Fixed values ---------------------------------------------------------------
HOURS_PER_UNIT = 10_000.0
SHOW_PART_TYPES = ("STANDARD", "ECONOMY", "MEDIUM")
NON_ENGLISH_WORDS = ("blue", "cold", "red")
CHART_SLOTS = 10
TABLES = ("lineitem", "orders", "customer", "nation", "part", "events")
# ----------------------------------------------------------------------------


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def part_type_kind(part_type: Column) -> Column:
    return F.when(part_type.isin(*SHOW_PART_TYPES), text.SHOW).otherwise(text.MOVIE)


def first_word(name: Column) -> Column:
    return F.substring_index(name, " ", 1)


def name_language(name: Column) -> Column:
    return F.when(first_word(name).isin(*NON_ENGLISH_WORDS), text.NON_ENGLISH).otherwise(
        text.ENGLISH
    )


def runtime_text(size: Column) -> Column:
    minutes = F.lpad((size % 10 * 6).cast("string"), 2, "0")
    return F.concat(F.floor(size / 10).cast("string"), F.lit(":"), minutes)


def viewing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours per week, half, market and work: the one pass over the lines.

    Both feeds are roll-ups of this grain, so the large join runs once. Its
    size is bounded by calendar x markets x works whatever the number of
    lines, and the map-side half of the aggregate shrinks every task's output
    to that before the last shuffle. No side is marked for broadcast: Catalyst
    does that under its size threshold, and beyond it the joins are sort-merge
    joins that adaptive execution splits on a hot order, customer or part.
    The number of tasks follows the rows (:func:`sized`), so that what one
    task sorts and aggregates does not grow with them; of many rows the frame
    belongs to a session beside ``spark``.
    """
    spark = sized(spark, sum(table(spark, sf_dir, name).count() for name in ("lineitem", "orders")))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day")
    )
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    day = F.col("day")
    grain = (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            calendar.week_start(day).alias("week"),
            calendar.half_start(day).alias("half_start"),
            "c_nationkey",
            "p_name",
            "p_type",
        )
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.count(F.lit(1)).alias("lines"),
            F.min("day").alias("first_day"),
            F.max("p_size").alias("longest"),
        )
    )
    # Names and texts are added to the grain, not to every line.
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return grain.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "week",
        "half_start",
        F.col("n_name").alias("market"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("market_code"),
        "p_name",
        "p_type",
        (F.col("quantity") * HOURS_PER_UNIT).alias("hours"),
        F.col("lines").cast("double").alias("views"),
        "first_day",
        "longest",
    )


def half_report(viewed: DataFrame, nation: DataFrame) -> DataFrame:
    """Half-year report: one row per work (name and part type) and half."""
    markets = nation.agg(F.count(F.lit(1))).scalar()
    start = F.col("half_start")
    return (
        viewed.groupBy("half_start", "p_name", "p_type")
        .agg(
            F.sum("hours").alias("Hours Viewed"),
            F.sum("views").alias("Views"),
            F.min("first_day").alias("Release Date"),
            F.max("longest").alias("longest"),
            F.count_distinct("market").alias("markets"),
        )
        .select(
            F.col("p_name").alias("Title"),
            F.when(F.col("markets") == markets, "Yes")
            .otherwise("No")
            .alias("Available Globally?"),
            "Release Date",
            "Hours Viewed",
            runtime_text(F.col("longest")).alias("Runtime"),
            "Views",
            part_type_kind(F.col("p_type")).alias("content_type"),
            calendar.half_label(start).alias("period_label"),
            start.alias("period_start"),
            calendar.half_end(start).alias("period_end"),
        )
    )


def _title_weeks(viewed: DataFrame, *grain: str) -> DataFrame:
    return viewed.groupBy(
        "week",
        *grain,
        F.col("p_name").alias("title"),
        part_type_kind(F.col("p_type")).alias("kind"),
    ).agg(F.sum("hours").alias("hours"), F.sum("views").alias("views"))


def _chart(title_weeks: DataFrame, chart_of: list[str], market_of: list[str]) -> DataFrame:
    """Ten best titles of each chart, with their running count of chart weeks.

    The rank filter becomes a group limit before the shuffle, so each task
    sends at most ten rows per chart however many titles it holds.
    """
    place = W.partitionBy(*chart_of).orderBy(F.desc("hours"), "title")
    history = W.partitionBy(*market_of, "title", "kind").orderBy("week")
    is_show = F.col("kind") == text.SHOW
    return (
        title_weeks.withColumn("weekly_rank", F.row_number().over(place))
        .filter(F.col("weekly_rank") <= CHART_SLOTS)
        .withColumn("cumulative_weeks_in_top_10", F.row_number().over(history))
        .withColumn("category", F.when(is_show, "TV").otherwise("Films"))
        # Series come as show plus season, films as a plain title.
        .withColumn("show_title", F.when(is_show, first_word(F.col("title"))).otherwise(F.col("title")))
        .withColumn("season_title", F.when(is_show, F.col("title")).otherwise("N/A"))
    )


def global_chart(viewed: DataFrame) -> DataFrame:
    """Worldwide weekly chart, one per type and language."""
    weeks = _title_weeks(viewed).withColumn("tongue", name_language(F.col("title")))
    return _chart(weeks, ["week", "kind", "tongue"], []).select(
        "week",
        F.concat("category", F.lit(" ("), "tongue", F.lit(")")).alias("category"),
        "weekly_rank",
        "show_title",
        "season_title",
        F.col("hours").alias("weekly_hours_viewed"),
        F.lit(None).cast("double").alias("runtime"),
        F.col("views").alias("weekly_views"),
        "cumulative_weeks_in_top_10",
    )


def country_chart(viewed: DataFrame) -> DataFrame:
    """Weekly chart of each market, one per type."""
    market = ["market", "market_code"]
    weeks = _title_weeks(viewed, *market)
    return _chart(weeks, ["week", "market", "kind"], ["market"]).select(
        F.col("market").alias("country_name"),
        F.col("market_code").alias("country_iso2"),
        "week",
        "category",
        "weekly_rank",
        "show_title",
        "season_title",
        "cumulative_weeks_in_top_10",
    )


def trailer_map(spark: SparkSession, sf_dir: str, dim_title: DataFrame) -> DataFrame:
    """Title-to-video map: one video per customer, spread over all titles."""
    videos = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("video"))
    titles = dim_title.agg(F.max("title_id")).scalar()
    numbered = videos.withColumn("number", F.col("video") * 7 % titles + 1)
    return numbered.join(dim_title, F.col("number") == F.col("title_id")).select(
        "title_id",
        "title_name",
        "content_type",
        F.col("video").cast("string").alias("video_id"),
    )


def video_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily fetches of video statistics, in the form of the landed items.

    A user is a video; a fetch at midnight reports every video active on the
    day before, with its views and clicks so far. Events are counted per video
    and day before the running sums, whose groups then hold one row per day.
    """
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    daily = events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
    )
    so_far = W.partitionBy("user_id").orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    views = F.sum("views").over(so_far)
    clicks = F.sum("clicks").over(so_far)
    first_day = F.min("day").over(so_far)
    return daily.select(
        F.col("user_id").cast("string").alias("id"),
        F.struct(
            F.when(views > 0, views.cast("string")).alias("viewCount"),
            F.when(clicks > 0, clicks.cast("string")).alias("likeCount"),
        ).alias("statistics"),
        F.struct(
            F.concat(first_day.cast("string"), F.lit("T00:00:00Z")).alias("publishedAt")
        ).alias("snippet"),
        F.date_add("day", 1).cast("timestamp_ntz").alias("fetched_at"),
    )

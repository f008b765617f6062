"""Trailer statistics: snapshots, retention, and views beside viewing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.calendar import days_between
from marquee.functions.numbers import in_millions, whole_number, whole_number_or_zero
from marquee.operators.movement import latest
from marquee.operators.spread import ranks_desc
from marquee.plans.kpis import worldwide
from marquee.sources import files

# Fixed values ---------------------------------------------------------------
KEEP_DAYS = 30
SNAPSHOT_KEY = ["title_id", "video_id", "fetched_at"]
PARTITIONS = ["fetch_day", "fetch"]
# ----------------------------------------------------------------------------


def snapshot(items: DataFrame, trailer_map: DataFrame, titles: DataFrame) -> DataFrame:
    """Fact rows of the mapped videos found in a fetch.

    The map names its titles, so ids are looked up by name and type; a title
    id written into the map could go stale at any reload. Where a fetch returns
    a video several times, the row with most views counts, then most likes.
    """
    videos = trailer_map.select("title_name", "content_type", "video_id").join(
        titles, ["title_name", "content_type"]
    )
    counts = F.struct(
        whole_number_or_zero(F.col("statistics.viewCount")).alias("view_count"),
        whole_number(F.col("statistics.likeCount")).alias("like_count"),
        F.substring("snippet.publishedAt", 1, 10).cast("date").alias("published_at"),
    )
    return (
        items.withColumnRenamed("id", "video_id")
        .join(videos, "video_id")
        .groupBy(*SNAPSHOT_KEY[:2], F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"))
        .agg(F.max(counts).alias("counts"))
        .select(*SNAPSHOT_KEY, "counts.*")
        .select(*schemas.columns(schemas.FACT_TRAILER))
    )


def latest_snapshot(trailers: DataFrame) -> DataFrame:
    """Rows of the newest fetch overall; a video missing from it is left out."""
    return trailers.filter(F.col("fetched_at") == latest(trailers, "fetched_at"))


def missing_trailers(trailer_map: DataFrame, fetched: DataFrame) -> DataFrame:
    """Mapped videos that a fetch did not return."""
    return trailer_map.select("title_name", "content_type", "video_id").join(
        fetched.select("video_id"), "video_id", "left_anti"
    )


def retained(trailers: DataFrame, now: Column, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Rows not older than ``keep_days``; exactly that old is kept.

    Where the log is split by fetch day, whole expired days are not read.
    """
    oldest = now.cast("timestamp_ntz") - F.make_dt_interval(F.lit(keep_days))
    rows = trailers.filter(F.col("fetched_at") >= oldest)
    return rows.filter(F.col("fetch_day") >= F.to_date(oldest)) if "fetch_day" in rows.columns else rows


def append_snapshot(rows: DataFrame, folder: str) -> None:
    """Add fetches to the log; the first one creates it. A fetch that the log holds is written whole again,
    joined with what is there, so that a replay adds nothing.

    A fetch is one partition, replaced as one when its job ends. Batch and stream may thus add
    the same fetch at once: either leaves it there once. Two writers must not bring different
    parts of one fetch at the same time, as the later would keep only what it had read.
    """
    spark = rows.sparkSession
    files.make(spark, folder)
    added = _with_partitions(rows)
    own = added.select(*PARTITIONS).distinct()
    held = read_log(spark, folder).join(own, PARTITIONS, "left_semi")
    counts = F.max(F.struct("view_count", "like_count", "published_at")).alias("counts")
    once = added.unionByName(held).groupBy(*SNAPSHOT_KEY, *PARTITIONS).agg(counts)
    write_log(once.select("*", "counts.*"), folder, "overwrite")


def write_retained(
    trailers: DataFrame, now: Column, folder: str, keep_days: int = KEEP_DAYS
) -> DataFrame:
    """New version of the log without its expired rows.

    Written beside the old one, never over it: a failed run leaves the old
    version whole. The caller drops that once it has switched over.
    """
    write_log(retained(trailers, now, keep_days), folder, "errorifexists")
    return read_log(trailers.sparkSession, folder)


def drop_expired(spark: SparkSession, folder: str, now: Column, keep_days: int = KEEP_DAYS) -> int:
    """Delete the fetches older than ``keep_days`` from the log, and nothing else; returns how many.

    All rows of a fetch expire together, so its folder goes and no other file is read or written
    again. A run that fails half-way has deleted expired fetches only; the next one goes on.
    """
    oldest = now.cast("timestamp_ntz") - F.make_dt_interval(F.lit(keep_days))
    log = read_log(spark, folder).filter((F.col("fetched_at") < oldest) & (F.col("fetch_day") <= F.to_date(oldest)))
    # One name per expired fetch.
    expired = log.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("uri")).distinct().collect()
    for row in expired:
        files.remove_uri(spark, row.uri)
    return len(expired)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.FACT_TRAILER + ", fetch_day date, fetch string").parquet(folder)


def _with_partitions(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.columns(schemas.FACT_TRAILER)).withColumns(
        {"fetch_day": F.to_date("fetched_at"), "fetch": F.date_format("fetched_at", "yyyyMMddHHmmssSSSSSS")}
    )


def write_log(rows: DataFrame, folder: str, mode: str) -> None:
    """Log rows split by fetch day and fetch; ``overwrite`` replaces the fetches it writes, whole. Fetches are gathered
    by range, so one large fetch is written by many tasks."""
    (
        _with_partitions(rows)
        .repartitionByRange(*PARTITIONS, "video_id")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(folder)
    )


def chart_history(weekly: DataFrame, regions: DataFrame) -> DataFrame:
    """Best worldwide place and number of charted weeks of every title."""
    return (
        worldwide(weekly, regions)
        .groupBy("title_id")
        .agg(
            F.min("weekly_rank").alias("peak_global_rank"),
            F.count_distinct("date_key").alias("weeks_in_global_top10"),
        )
    )


def trailer_vs_engagement(
    trailers: DataFrame,
    half: DataFrame,
    weekly: DataFrame,
    titles: DataFrame,
    regions: DataFrame,
    period: str,
    released_from: Column,
) -> DataFrame:
    """Trailer views beside viewing, ranked within each content type.

    Several works may share a title; the release guard picks the ones of this
    period, and a title with two of them keeps both.
    """
    works = half.filter(
        (F.col("period_label") == period) & (F.col("release_date") >= released_from)
    ).select("title_id", "hours_viewed")
    ranked = (
        latest_snapshot(trailers)
        .join(titles, "title_id")
        .join(works, "title_id")
        .join(chart_history(weekly, regions), "title_id", "left")
    )
    ranks = {"view_count": "trailer_rank_in_type", "hours_viewed": "hours_rank_in_type"}
    ranked = ranks_desc(ranked, ["content_type"], ranks)
    return ranked.select(
        "title_name",
        "content_type",
        F.col("view_count").alias("trailer_views"),
        days_between(F.col("fetched_at"), F.col("published_at")).alias("days_since_trailer"),
        in_millions(F.col("hours_viewed")).alias("hours_viewed_million"),
        "peak_global_rank",
        "weeks_in_global_top10",
        "trailer_rank_in_type",
        "hours_rank_in_type",
    ).orderBy("content_type", F.desc("trailer_views"), "title_name", "hours_rank_in_type")

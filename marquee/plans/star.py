"""Build job: conformed feeds to dimensions, facts and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import calendar, text
from marquee.operators import checks
from marquee.operators.spread import dense_ids, stable_ids
from marquee.session import together
from marquee.sources import charts
from marquee.sources.tables import Star, read_star

TITLE_KEY = ["title_name", "content_type"]


def _ids(keys: DataFrame, order_by: list[str], id_name: str, store: str | None) -> DataFrame:
    return dense_ids(keys, order_by, id_name) if store is None else stable_ids(keys, order_by, id_name, store)


def dim_title(half_feed: DataFrame, weekly_feed: DataFrame, store: str | None = None) -> DataFrame:
    """Every (name, type) of either feed.

    Name and type together, as a film and a series may share a name. Ids
    follow the sorted key, so a reload of the same titles gives the same ids; with
    ``store`` they also stay when titles are added.
    """
    titles = (
        half_feed.select(*TITLE_KEY)
        .unionByName(weekly_feed.select(*TITLE_KEY))
        .dropna(subset=["title_name"])
        .distinct()
    )
    return _ids(titles, ["content_type", "title_name"], "title_id", store)


def dim_region(weekly_feed: DataFrame, store: str | None = None) -> DataFrame:
    """Every market of the charts plus the worldwide row, numbered by name, or as ``store`` knows them."""
    named = weekly_feed.select("region_name", "iso2").dropna(subset=["region_name"])
    spark = weekly_feed.sparkSession
    worldwide = spark.range(1).select(
        F.lit(text.GLOBAL_REGION).alias("region_name"), F.lit(None).cast("string").alias("iso2")
    )
    regions = (
        named.unionByName(worldwide)
        .groupBy("region_name")
        .agg(F.min("iso2").alias("iso2"))
        .withColumn("is_global", F.col("region_name") == text.GLOBAL_REGION)
    )
    ids = _ids(regions.select("region_name"), ["region_name"], "region_id", store)
    return ids.join(regions, "region_name").select(*schemas.columns(schemas.DIM_REGION))


def dim_date(half_feed: DataFrame, weekly_feed: DataFrame) -> DataFrame:
    """Every chart week and every half start."""
    days = (
        weekly_feed.select(F.col("week_start_date").alias("date_key"))
        .unionByName(half_feed.select(F.col("period_start").alias("date_key")))
        .dropna()
        .distinct()
    )
    return (
        days.withColumns(calendar.date_parts(F.col("date_key")))
        .withColumn("full_date", F.col("date_key"))
        .select(*schemas.columns(schemas.DIM_DATE))
    )


def fact_weekly(weekly_feed: DataFrame, titles: DataFrame, regions: DataFrame) -> DataFrame:
    """Chart rows with their keys; a key that finds nothing stays NULL."""
    return (
        weekly_feed.join(titles, TITLE_KEY, "left")
        .join(regions.select("region_id", "region_name"), "region_name", "left")
        .withColumnRenamed("week_start_date", "date_key")
        .select(*schemas.columns(schemas.FACT_WEEKLY))
    )


def fact_half(half_feed: DataFrame, titles: DataFrame) -> DataFrame:
    """One row per work and half; a title may hold several works."""
    return (
        half_feed.join(titles, TITLE_KEY, "left")
        .withColumnRenamed("period_start", "date_key")
        .select(*schemas.columns(schemas.FACT_HALF))
    )


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Full replace, then read back with the written schema."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_star(half_feed: DataFrame, weekly_feed: DataFrame, folder: str, keys: str | None = None) -> Star:
    """Replace the five tables under ``folder`` and return them.

    ``keys`` is a folder that outlives the builds: ids given once are kept there (:func:`stable_ids`).
    The layout of the two facts stands in for indexes.
    """
    title_keys, region_keys = (None if keys is None else f"{keys}/{name}" for name in ("title_keys", "region_keys"))
    titles, regions, _ = together(
        lambda: write_table(dim_title(half_feed, weekly_feed, title_keys), f"{folder}/dim_title"),
        lambda: write_table(dim_region(weekly_feed, region_keys), f"{folder}/dim_region"),
        lambda: write_table(dim_date(half_feed, weekly_feed), f"{folder}/dim_date"),
    )
    together(
        lambda: write_weekly(fact_weekly(weekly_feed, titles, regions), folder),
        lambda: write_half(fact_half(half_feed, titles), folder),
    )
    return read_star(half_feed.sparkSession, folder)


def write_weekly(fact: DataFrame, folder: str) -> None:
    """Split by year and ranged by week and market within it, so that one year is
    written by many tasks and file statistics skip to the wanted weeks."""
    (
        fact.withColumn("year", F.year("date_key"))
        .repartitionByRange("year", "date_key", "region_id", "title_id")
        .sortWithinPartitions("year", "date_key", "region_id", "weekly_rank")
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(f"{folder}/fact_top10_weekly")
    )


def write_half(fact: DataFrame, folder: str) -> None:
    """Split by period and ranged by title within it, so that a period holding
    most rows is written by many tasks; the further columns let the range
    divide one title of very many works, too."""
    (
        fact.repartitionByRange("period_label", "title_id", "release_date", "hours_viewed", "views")
        .sortWithinPartitions("period_label", "title_id")
        .write.mode("overwrite")
        .partitionBy("period_label")
        .parquet(f"{folder}/fact_engagement_half")
    )


def export_csv(star: Star, folder: str) -> None:
    """Header CSV of every table, for reporting tools."""
    tables = {
        "dim_date": (star.dates, schemas.DIM_DATE),
        "dim_title": (star.titles, schemas.DIM_TITLE),
        "dim_region": (star.regions, schemas.DIM_REGION),
        "fact_top10_weekly": (star.weekly, schemas.FACT_WEEKLY),
        "fact_engagement_half": (star.half, schemas.FACT_HALF),
    }
    for name, (df, schema) in tables.items():
        (
            df.select(*schemas.columns(schema))
            .write.mode("overwrite")
            .option("header", True)
            .csv(f"{folder}/{name}")
        )


def build_from_files(
    half_feed: DataFrame,
    global_raw: DataFrame,
    country_raw: DataFrame,
    folder: str,
    half_raw: DataFrame | None = None,
    keys: str | None = None,
) -> Star:
    """Conform both charts, stage the feeds once, then build the tables.

    ``load_report`` beside them counts the landed values that did not parse.
    """
    write_table(checks.unparsed(half_raw, global_raw, country_raw), f"{folder}/load_report")
    half, weekly = together(
        lambda: write_table(half_feed, f"{folder}/feed_half"),
        lambda: write_table(charts.weekly_feed(global_raw, country_raw), f"{folder}/feed_weekly"),
    )
    return build_star(half, weekly, folder, keys)

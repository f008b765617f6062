"""Weekly top-10 charts: the worldwide one and one per country."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import text
from marquee.sources import records

# Fixed values ---------------------------------------------------------------
CHART_COLUMNS = {
    "week": "week_start_date",
    "weekly_hours_viewed": "hours_viewed",
    "runtime": "runtime_hours",
    "weekly_views": "views",
    "cumulative_weeks_in_top_10": "cumulative_weeks_in_top10",
    "country_name": "region_name",
    "country_iso2": "iso2",
}
# ----------------------------------------------------------------------------


def read_global_chart(spark: SparkSession, path: str) -> DataFrame:
    return records.good_records(records.landed_tsv(spark, path, schemas.GLOBAL_CHART), schemas.GLOBAL_CHART)


def read_country_chart(spark: SparkSession, path: str) -> DataFrame:
    return records.good_records(records.landed_tsv(spark, path, schemas.COUNTRY_CHART), schemas.COUNTRY_CHART)


def _conform(chart: DataFrame) -> DataFrame:
    return chart.withColumn(
        "title_name", text.title_key(F.col("show_title"), F.col("season_title"))
    ).select(*schemas.columns(schemas.FEED_WEEKLY))


def conform_global(raw: DataFrame) -> DataFrame:
    """Worldwide chart: the category carries both type and language."""
    category = F.col("category")
    return _conform(
        raw.withColumnsRenamed(CHART_COLUMNS).withColumns(
            {
                "content_type": text.category_type(category),
                "language": text.category_language(category),
                "region_name": F.lit(text.GLOBAL_REGION),
                "iso2": F.lit(None).cast("string"),
            }
        )
    )


def conform_country(raw: DataFrame) -> DataFrame:
    """Country charts: rank only, so hours, views and language stay NULL."""
    return _conform(
        raw.withColumnsRenamed(CHART_COLUMNS).withColumns(
            {
                "content_type": text.recode(F.col("category"), text.COUNTRY_CATEGORIES),
                "language": F.lit(None).cast("string"),
                "hours_viewed": F.lit(None).cast("double"),
                "views": F.lit(None).cast("double"),
                "runtime_hours": F.lit(None).cast("double"),
            }
        )
    )


def weekly_feed(global_raw: DataFrame, country_raw: DataFrame) -> DataFrame:
    return conform_global(global_raw).unionByName(conform_country(country_raw))

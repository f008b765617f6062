"""Reading the modelled tables back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marquee import schemas


@dataclass(frozen=True)
class Star:
    """Three dimensions shared by two facts of different grain."""

    dates: DataFrame
    titles: DataFrame
    regions: DataFrame
    weekly: DataFrame
    half: DataFrame


def read_star(spark: SparkSession, folder: str) -> Star:
    def read(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{folder}/{name}")

    return Star(
        dates=read("dim_date", schemas.DIM_DATE),
        titles=read("dim_title", schemas.DIM_TITLE),
        regions=read("dim_region", schemas.DIM_REGION),
        # The partition column is kept for pruning beside the fact's own columns.
        weekly=read("fact_top10_weekly", schemas.FACT_WEEKLY + ", year int"),
        half=read("fact_engagement_half", schemas.FACT_HALF),
    )

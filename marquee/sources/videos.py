"""Trailer map and landed video statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.sources import records


def read_trailer_map(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV whose notes hold quoted commas."""
    return records.good_records(records.landed_csv(spark, path, schemas.TRAILER_MAP), schemas.TRAILER_MAP)


def landed_responses(spark: SparkSession, path: str, schema: str = schemas.VIDEO_RESPONSE, lines: bool = False) -> DataFrame:
    """JSON documents, one a file or one a line, with the file and, where it does not parse, the text."""
    options = {"multiLine": not lines, "columnNameOfCorruptRecord": records.CORRUPT}
    documents = spark.read.schema(f"{schema}, {records.CORRUPT} string").options(**options).json(path)
    return documents.select("*", records.file_name().alias("_file"))


def video_items(responses: DataFrame, fetched_at) -> DataFrame:
    """One row per video of the landed responses, stamped with the fetch time."""
    return (
        responses.select(F.explode("items").alias("item"))
        .select("item.*")
        .withColumn("fetched_at", fetched_at.cast("timestamp_ntz"))
    )


def read_video_items(spark: SparkSession, path: str, fetched_at: datetime) -> DataFrame:
    """One fetch: JSON documents, each an ``items`` list of videos; those that do not parse are
    left for :func:`marquee.sources.records.rejected_records`."""
    landed = landed_responses(spark, path)
    return video_items(landed.filter(records.is_record(landed)), F.lit(fetched_at.isoformat(sep=" ")))

"""Landed video statistics appended to the snapshot log, each file once.

A run takes what has landed since the last one and stops, so it can be
scheduled like the batch job it replaces; the stream's own checkpoint remembers
which files were taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee import schemas
from marquee.plans.trailers import append_snapshot, snapshot
from marquee.sources import records

LANDED = schemas.VIDEO_RESPONSE + ", fetched_at string"


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of responses, one JSON document per line with its fetch time, and the lines that do not parse."""
    stream = spark.readStream.schema(f"{LANDED}, {records.CORRUPT} string").option("columnNameOfCorruptRecord", records.CORRUPT)
    return stream.json(folder).select("*", records.file_name().alias("_file"))


def ingest_landed(
    spark: SparkSession,
    landed: str,
    log: str,
    trailer_map: DataFrame,
    titles: DataFrame,
    checkpoint: str,
    rejected: str | None = None,
) -> StreamingQuery:
    """Add every newly landed fetch to ``log``; returns the running query.

    ``checkpoint`` is the shared folder in which this source and log remember
    what was taken; no other stream may use it. The log has the layout of the
    batch job, which may feed it too. A batch replayed after a failure finds its
    rows in the log and adds nothing. Lines that do not parse go to ``rejected``, with
    their file, a folder for each batch that has any.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        if rejected is not None:
            lost = records.rejected_records(batch)
            if not lost.isEmpty():
                lost.write.mode("overwrite").json(f"{rejected}/batch={batch_id}")
        items = batch.filter(records.is_record(batch)).select(F.explode("items").alias("item"), "fetched_at").select(
            "item.*", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at")
        )
        append_snapshot(snapshot(items, trailer_map, titles), log)

    return (
        read_landed(spark, landed)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Half-year viewing reports: one export per half and kind."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import numbers, text
from marquee.sources import records

# Fixed values ---------------------------------------------------------------
PREAMBLE_LINES = 5
UNNAMED_PREFIX = "Unnamed"
REPORT_COLUMNS = {
    "Title": "title_name",
    "Available Globally?": "is_available_globally",
    "Release Date": "release_date",
    "Hours Viewed": "hours_viewed",
    "Runtime": "runtime_raw",
    "Views": "views",
}
# ----------------------------------------------------------------------------


TAGS = ["content_type", "period_label", "period_start", "period_end"]


@dataclass(frozen=True)
class HalfReport:
    """One export: where it lies and what its rows are about."""

    path: str
    content_type: str
    period_label: str
    period_start: str
    period_end: str


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[name for name in df.columns if not name or name.startswith(prefix)])


def read_report_csv(spark: SparkSession, path: str, preamble: int = PREAMBLE_LINES) -> DataFrame:
    """CSV export, one file or a folder of parts, with a fixed number of lines above its header.

    Columns as the header names them, all text; those named ``Unnamed: n`` or not at all are
    dropped. The lines above are skipped by their place, so a data row may read like one of
    them, and a title may hold line breaks. Only the header reaches the driver.
    Records that do not fit the header are left out: see :func:`rejected_records`.
    """
    top = spark.read.options(lineSep="\n", recursiveFileLookup=True).text(path).head(preamble + 1)
    header = next(csv.reader([top[-1].value.rstrip("\r")] if len(top) > preamble else [""]), [])
    if not header:
        raise ValueError(f"{path}: no header below {preamble} lines")
    named = [name if name else f"{UNNAMED_PREFIX}: {i}" for i, name in enumerate(header)]
    rows = records.headed_records(spark, path, preamble).filter("good")
    columns = [
        F.get("fields", F.lit(i)).alias(name) if name.startswith(UNNAMED_PREFIX) else records.field(name).alias(name)
        for i, name in enumerate(named)
    ]
    return drop_prefixed(rows.select(*columns), UNNAMED_PREFIX)


def rejected_records(
    spark: SparkSession, paths: str | Sequence[str], preamble: int = PREAMBLE_LINES
) -> DataFrame:
    """``file, place, record`` of what has fewer or more fields than its header, or a quote left open."""
    return records.headed_records(spark, paths, preamble).filter("not good").select("file", "place", "record")


def tag_report(df: DataFrame, report: HalfReport) -> DataFrame:
    return df.withColumns(
        {
            "content_type": F.lit(report.content_type),
            "period_label": F.lit(report.period_label),
            "period_start": F.lit(report.period_start).cast("date"),
            "period_end": F.lit(report.period_end).cast("date"),
        }
    )


def read_raw_reports(
    spark: SparkSession, reports: Iterable[HalfReport], preamble: int = PREAMBLE_LINES
) -> DataFrame:
    """All exports as landed, the CSV ones in one scan; ``.parquet`` paths are read as Parquet."""
    reports = list(reports)
    landed = [report for report in reports if not report.path.endswith(".parquet")]
    frames = [tag_report(spark.read.parquet(r.path), r) for r in reports if r not in landed]
    if landed:
        frames.append(_read_landed(spark, landed, preamble))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _report_columns() -> list[Column]:
    return [records.field(name).alias(name) for name in REPORT_COLUMNS]


def _read_landed(spark: SparkSession, reports: list[HalfReport], preamble: int) -> DataFrame:
    """A file belongs to the report that names it or the nearest folder around it."""
    rows = records.headed_records(spark, [report.path for report in reports], preamble).filter("good")
    tags = [(records.path_of(spark, r.path), r.content_type, r.period_label, r.period_start, r.period_end) for r in reports]
    named = spark.createDataFrame(tags, "path string, content_type string, period_label string, period_start string, period_end string")
    parts = F.split("file", "/")
    around = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    # One row per file, and few reports.
    files = rows.select("file").distinct().select("file", F.explode(around).alias("path")).join(named, "path")
    owner = files.groupBy("file").agg(F.max_by(F.struct(*TAGS), F.length("path")).alias("report"))
    return rows.join(owner, "file").select(
        *_report_columns(),
        "report.content_type",
        "report.period_label",
        F.col("report.period_start").cast("date").alias("period_start"),
        F.col("report.period_end").cast("date").alias("period_end"),
    )


def read_report_folder(spark: SparkSession, folder: str, preamble: int = PREAMBLE_LINES) -> DataFrame:
    """All exports under a folder laid out as ``period_label=../content_type=..``, in one scan.

    The folders say what the rows are about; a half begins in January or July.
    """
    rows = records.headed_records(spark, folder, preamble).filter("good")

    def tag(name: str) -> Column:
        return F.url_decode(F.regexp_extract("file", f"/{name}=([^/]*)/", 1))

    label = tag("period_label")
    start = F.make_date(F.substring(label, 1, 4).try_cast("int"), F.when(label.endswith("H1"), 1).otherwise(7), F.lit(1))
    return rows.select(
        *_report_columns(), tag("content_type").alias("content_type"), label.alias("period_label"), start.alias("period_start")
    ).withColumn("period_end", F.date_sub(F.add_months("period_start", 6), 1))


def read_half_reports(spark: SparkSession, reports: Iterable[HalfReport]) -> DataFrame:
    """All exports as one feed."""
    return conform_half(read_raw_reports(spark, reports))


def conform_half(raw: DataFrame) -> DataFrame:
    """Canonical names and types; rows without a title are dropped."""
    renamed = raw.dropna(subset=["Title"]).withColumnsRenamed(REPORT_COLUMNS)
    return (
        renamed.withColumns(
            {
                "title_name": text.strip(F.col("title_name")),
                "release_date": F.col("release_date").try_cast("date"),
                "hours_viewed": numbers.grouped_number(F.col("hours_viewed")),
                "views": numbers.grouped_number(F.col("views")),
                "runtime_minutes": text.runtime_minutes(F.col("runtime_raw")),
            }
        )
        .select(*schemas.columns(schemas.FEED_HALF))
    )

"""Derived feeds written as the files the readers expect."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import text
from marquee.sources.reports import PREAMBLE_LINES, REPORT_COLUMNS, HalfReport

# Rows of an export's file, about; each file has the lines above the header and the header itself.
EXPORT_ROWS = 1_000_000
EXPORT_KEY = ["period_label", "content_type", "part"]


def write_tsv(chart: DataFrame, folder: str) -> None:
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "emptyValue": ""}
    chart.write.options(**options).csv(folder)


def _noted(mapped: DataFrame) -> DataFrame:
    return mapped.select(
        "title_id",
        "title_name",
        "content_type",
        "video_id",
        F.lit("channel").alias("channel"),
        F.concat(F.lit("number "), "video_id", F.lit(', "derived"')).alias("note"),
    )


def write_trailer_map(mapped: DataFrame, folder: str) -> None:
    _noted(mapped).write.options(header=True, quote='"', escape='"').csv(folder)


def _response() -> list[Column]:
    """One item as a response of its own, with its fetch time."""
    item = F.struct("id", "statistics", "snippet")
    return [F.array(item).alias("items"), F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at")]


def write_responses(items: DataFrame, folder: str) -> None:
    """One response per line, with its fetch time."""
    items.select(*_response()).write.json(folder)


def _write_headed(rows: DataFrame, keys: list[str], top: list[str], folder: str) -> None:
    """``value`` of the rows as lines, a file for each combination of keys; ``top`` stands above them in every file.

    The lines of a file are sorted, the top first.
    """
    lines = F.posexplode(F.array(*(F.lit(line) for line in top))).alias("place", "value")
    heads = rows.select(*keys).distinct().select(*keys, lines)
    (
        heads.unionByName(rows.select(*keys, F.lit(len(top)).alias("place"), "value"))
        .repartition(*keys)
        .sortWithinPartitions(*keys, "place")
        .drop("place")
        .write.partitionBy(*keys)
        .text(folder)
    )


def _export_lines(report: DataFrame) -> DataFrame:
    """``period_label, content_type, part, value``: an export is cut into files of about ``EXPORT_ROWS`` rows."""
    line = F.to_csv(F.struct(F.lit("").alias("_"), *(F.col(n).cast("string").alias(n) for n in REPORT_COLUMNS)), {"escape": '"'})
    export = EXPORT_KEY[:-1]
    parts = report.groupBy(*export).agg(F.ceil(F.count(F.lit(1)) / EXPORT_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("Title", "content_type", "Hours Viewed", "Release Date"), "parts").cast("int")
    return report.join(parts, export).select(*export, part.alias("part"), "Views", line.alias("value"))


EXPORT_TOP = [f"{n} lines above the header" for n in range(PREAMBLE_LINES)] + [",".join(["", *REPORT_COLUMNS])]


def write_exports(report: DataFrame, folder: str) -> None:
    """Half-year exports: lines above the header, the header, one line per work."""
    _write_headed(_export_lines(report), EXPORT_KEY, EXPORT_TOP, folder)


def write_damaged(
    report: DataFrame, worldwide: DataFrame, country: DataFrame, mapped: DataFrame, items: DataFrame, folder: str
) -> None:
    """The feeds as files in which some records are cut short or run on, as broken transfers leave them.

    Cut after two fields: works with a multiple of five views, chart lines of rank 7, map rows
    of every fourth title. A field too many: worldwide lines of rank 9. Cut in half: responses
    fetched on every fifth day of a month.
    """

    def cut(line: str, sep: str) -> Column:
        return F.substring_index(line, sep, 2)

    def tsv(chart: DataFrame, broken: Column, name: str) -> None:
        line = F.to_csv(F.struct(*chart.columns), {"sep": "\t", "escape": '"', "emptyValue": ""})
        rows = chart.withColumn("line", line).select(F.year("week").alias("year"), broken.alias("value"))
        _write_headed(rows, ["year"], ["\t".join(chart.columns)], f"{folder}/{name}")

    rank = F.col("weekly_rank")
    short = F.when(rank == 7, cut("line", "\t"))
    works = _export_lines(report).withColumn("value", F.when(F.col("Views") % 5 == 0, cut("value", ",")).otherwise(F.col("value")))
    _write_headed(works, EXPORT_KEY, EXPORT_TOP, f"{folder}/exports")
    tsv(worldwide, short.when(rank == 9, F.concat("line", F.lit("\tmore"))).otherwise(F.col("line")), "global")
    tsv(country, short.otherwise(F.col("line")), "countries")
    noted = _noted(mapped)
    line = F.to_csv(F.struct(*noted.columns), {"escape": '"'})
    line = F.when(F.col("title_id") % 4 == 0, cut(line, ",")).otherwise(line)
    _write_headed(noted.select("content_type", line.alias("value")), ["content_type"], [",".join(noted.columns)], f"{folder}/map")
    document = F.to_json(F.struct(*_response()))
    half = F.substr(document, F.lit(1), F.floor(F.char_length(document) / 2).cast("int"))
    landed = items.select(F.when(F.dayofmonth("fetched_at") % 5 == 0, half).otherwise(document))
    landed.write.text(f"{folder}/responses")


def exports(spark: SparkSession, folder: str, periods: list[str]) -> Iterator[HalfReport]:
    """What :func:`write_exports` has written for the named halves."""
    for label in periods:
        year, half = label[:4], label[4:]
        start, end = ("01-01", "06-30") if half == "H1" else ("07-01", "12-31")
        for kind in (text.SHOW, text.MOVIE):
            path = f"{folder}/period_label={label}/content_type={kind}"
            yield HalfReport(path, kind, label, f"{year}-{start}", f"{year}-{end}")

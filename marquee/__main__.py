"""Command line.

    build OUT --data DIR [--csv DIR] [--keys DIR]  tables from commerce tables, ids kept in keys
    build OUT --report PATH KIND LABEL START END ... --global-chart TSV
              --country-chart TSV [--csv DIR] [--keys DIR]  tables from the landed files
    ask STAR [NAME ...] --period P            questions on built tables
    show DIR [NAME ...]                       questions on commerce tables
    snapshot STAR --map CSV --response JSON --log NEW [--previous OLD]
             --period P --released-from DAY   one fetch of video statistics
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans import trailers
from marquee.plans.report import as_report
from marquee.plans.star import build_from_files, build_star, export_csv
from marquee.plans.warehouse import warehouse
from marquee.queries import STAR_QUESTIONS, Parameters, all_queries, beside_hours
from marquee.sources import charts, reports, videos
from marquee.sources.tables import read_star

SHOWN_ROWS = 20


def show_all(questions: Iterable[tuple[str, Callable[[], DataFrame]]]) -> list[str]:
    """Print the first rows of each question. One that fails is reported and
    does not stop the others; the names of those that failed are returned."""
    failed = []
    for name, ask in questions:
        print(f"=== {name}")
        try:
            ask().show(SHOWN_ROWS, truncate=False)
        except Exception as error:  # noqa: BLE001 - one question must not stop the others
            failed.append(name)
            print(f"failed: {error}")
    return failed


def build(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.data:
        source = warehouse(spark, options.data)
        star = build_star(source.half_feed, source.weekly_feed, options.out, options.keys)
    else:
        raw = reports.read_raw_reports(spark, [reports.HalfReport(*r) for r in options.report])
        star = build_from_files(
            reports.conform_half(raw),
            charts.read_global_chart(spark, options.global_chart),
            charts.read_country_chart(spark, options.country_chart),
            options.out,
            raw,
            options.keys,
        )
        spark.read.parquet(f"{options.out}/load_report").show(truncate=False)
    if options.csv:
        export_csv(star, options.csv)


def ask(spark: SparkSession, options: argparse.Namespace) -> list[str]:
    star = read_star(spark, options.star)
    parameters = Parameters(options.period, options.released_from or "")
    return show_all(
        (name, lambda name=name: as_report(STAR_QUESTIONS[name](star, parameters)))
        for name in options.names or STAR_QUESTIONS
    )


def show(spark: SparkSession, options: argparse.Namespace) -> list[str]:
    queries = all_queries()
    return show_all(
        (name, lambda name=name: queries[name](spark, options.data))
        for name in options.names or queries
    )


def snapshot(spark: SparkSession, options: argparse.Namespace) -> None:
    """Add a fetch, drop expired rows, list missing videos, compare with hours."""
    fetched_at = options.fetched_at or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    star = read_star(spark, options.star)
    trailer_map = videos.read_trailer_map(spark, options.map)
    items = videos.read_video_items(spark, options.response, fetched_at)
    fetched = trailers.snapshot(items, trailer_map, star.titles)
    now = F.lit(fetched_at.isoformat(sep=" "))
    if options.previous:
        trailers.write_retained(trailers.read_log(spark, options.previous), now, options.log)
    trailers.append_snapshot(fetched, options.log)
    trailers.drop_expired(spark, options.log, now)
    log = trailers.read_log(spark, options.log)
    parameters = Parameters(options.period, options.released_from)
    show_all(
        [
            ("missing", lambda: trailers.missing_trailers(trailer_map, fetched)),
            ("trailer_vs_engagement", lambda: as_report(beside_hours(log, star, parameters))),
        ]
    )


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="marquee")
    commands = parser.add_subparsers(required=True)

    command = commands.add_parser("build")
    command.set_defaults(run=build)
    command.add_argument("out")
    command.add_argument("--data")
    command.add_argument(
        "--report", nargs=5, action="append", default=[],
        metavar=("PATH", "KIND", "LABEL", "START", "END"),
    )
    command.add_argument("--global-chart")
    command.add_argument("--country-chart")
    command.add_argument("--csv")
    command.add_argument("--keys")

    command = commands.add_parser("ask")
    command.set_defaults(run=ask)
    command.add_argument("star")
    command.add_argument("names", nargs="*")
    command.add_argument("--period", required=True)
    command.add_argument("--released-from")

    command = commands.add_parser("show")
    command.set_defaults(run=show)
    command.add_argument("data")
    command.add_argument("names", nargs="*")

    command = commands.add_parser("snapshot")
    command.set_defaults(run=snapshot)
    command.add_argument("star")
    for name in ("--map", "--response", "--log", "--period", "--released-from"):
        command.add_argument(name, required=True)
    command.add_argument("--previous")
    command.add_argument("--fetched-at", type=datetime.fromisoformat)
    return parser.parse_args(argv)


def main() -> None:
    options = arguments()
    spark = SparkSession.builder.appName("marquee").getOrCreate()
    try:
        options.run(spark, options)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

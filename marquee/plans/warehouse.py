"""The modelled tables of one data folder, built once per application.

Questions read the built tables, not the order lines: the one pass over the
lines happens in the build, and each question then scans a few columns of
tables bounded by calendar, markets and works.
"""

from __future__ import annotations

import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import text
from marquee.operators import carried, movement
from marquee.plans import rollup, trailers
from marquee.plans.star import build_star, write_table
from marquee.session import shared_dir, sized, together
from marquee.sources import charts, files, landing, reports, shop, videos
from marquee.sources.tables import Star
from marquee.streaming.snapshots import ingest_landed


_lock = threading.RLock()


class Warehouse:
    """Tables derived from ``sf_dir``, written under the shared folder.

    Each step is a written table, so losing an executor never repeats more
    than the step at hand.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        application = spark.sparkContext.applicationId
        # A folder per build: frames of an earlier build keep their files.
        self.folder = f"{shared_dir(spark)}/marquee/{application}/{uuid.uuid4()}"
        self._trailers: DataFrame | None = None

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """Written in the session of ``df``, read back in the warehouse's."""
        path = f"{self.folder}/{name}"
        return self.spark.read.schema(write_table(df, path).schema).parquet(path)

    @cached_property
    def viewing(self) -> DataFrame:
        """What is made of it runs in tasks that follow its rows, too."""
        staged = self._staged(shop.viewing(self.spark, self.sf_dir), "viewing")
        return sized(self.spark, staged.count()).read.schema(staged.schema).parquet(f"{self.folder}/viewing")

    @cached_property
    def half_feed(self) -> DataFrame:
        nation = shop.table(self.spark, self.sf_dir, "nation")
        return self._staged(
            reports.conform_half(shop.half_report(self.viewing, nation)), "feed_half"
        )

    @cached_property
    def weekly_feed(self) -> DataFrame:
        feed = charts.weekly_feed(
            shop.global_chart(self.viewing), shop.country_chart(self.viewing)
        )
        return self._staged(feed, "feed_weekly")

    @cached_property
    def star(self) -> Star:
        self.viewing  # noqa: B018 - both feeds roll it up
        half, weekly = together(lambda: self.half_feed, lambda: self.weekly_feed)
        return build_star(half, weekly, self.folder)

    @cached_property
    def trailer_map(self) -> DataFrame:
        return self._staged(
            shop.trailer_map(self.spark, self.sf_dir, self.star.titles), "trailer_map"
        )

    @cached_property
    def landed(self) -> str:
        """The derived feeds as files in their landed forms."""
        folder = f"{self.folder}/landed"
        nation = shop.table(self.spark, self.sf_dir, "nation")
        items = shop.video_snapshots(self.spark, self.sf_dir)
        together(
            lambda: landing.write_exports(shop.half_report(self.viewing, nation), f"{folder}/exports"),
            lambda: landing.write_tsv(shop.global_chart(self.viewing), f"{folder}/global"),
            lambda: landing.write_tsv(shop.country_chart(self.viewing), f"{folder}/countries"),
            lambda: landing.write_trailer_map(self.trailer_map, f"{folder}/map"),
            lambda: landing.write_responses(items, f"{folder}/responses"),
        )
        return folder

    @cached_property
    def damaged(self) -> str:
        """The same files with records that do not parse among them."""
        folder = f"{self.folder}/damaged"
        nation = shop.table(self.spark, self.sf_dir, "nation")
        landing.write_damaged(
            shop.half_report(self.viewing, nation),
            shop.global_chart(self.viewing),
            shop.country_chart(self.viewing),
            self.trailer_map,
            shop.video_snapshots(self.spark, self.sf_dir),
            folder,
        )
        return folder

    @cached_property
    def landed_log(self) -> DataFrame:
        """The snapshot log fed by the stream from landed responses."""
        log = f"{self.folder}/landed_log"
        mapped = videos.read_trailer_map(self.spark, f"{self.landed}/map")
        stream = ingest_landed(
            self.spark, f"{self.landed}/responses", log, mapped, self.star.titles, f"{self.folder}/landed_stream"
        )
        stream.awaitTermination()
        return trailers.read_log(self.spark, log)

    @cached_property
    def last_seen(self) -> DataFrame:
        """Movement state behind all weeks but the newest."""
        weekly = self.star.weekly
        older = weekly.filter(F.col("date_key") < movement.latest_week(weekly))
        return self._staged(carried.last_seen(older), "last_seen")

    @cached_property
    def half_rollup(self) -> DataFrame:
        return self._staged(rollup.half_rollup(self.star.half), "half_rollup")

    @cached_property
    def chart_rollup(self) -> DataFrame:
        return self._staged(rollup.chart_rollup(self.star.weekly), "chart_rollup")

    def close(self) -> None:
        """Delete everything this build wrote; its frames must not be used any more."""
        files.remove(self.spark, self.folder)

    @property
    def trailers(self) -> DataFrame:
        """The snapshot log, appended to once per build."""
        with _lock:
            if self._trailers is None:
                log = f"{self.folder}/fact_trailer_engagement"
                items = shop.video_snapshots(self.spark, self.sf_dir)
                trailers.append_snapshot(
                    trailers.snapshot(items, self.trailer_map, self.star.titles), log
                )
                self._trailers = trailers.read_log(self.spark, log)
        return self._trailers

    @cached_property
    def shows(self) -> DataFrame:
        """Show of every season: ``title_id`` to ``show_title``."""
        named = (
            self.weekly_feed.filter(F.col("content_type") == text.SHOW)
            .select("title_name", "content_type", "show_title")
            .distinct()
        )
        titled = named.join(self.star.titles, ["title_name", "content_type"])
        return self._staged(titled.select("title_id", "show_title"), "title_show")


_open: dict[tuple[str, str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str, version: str = "") -> Warehouse:
    """The application's warehouse for ``sf_dir``, star built on first use.

    The inputs are not looked at again: a caller whose tables have changed
    names another ``version``, or calls :func:`forget`.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), version)
    with _lock:
        if key not in _open:
            fresh = Warehouse(spark, sf_dir)
            fresh.star  # noqa: B018 - built under the lock
            _open[key] = fresh
        return _open[key]


def forget(spark: SparkSession, sf_dir: str, version: str = "") -> Warehouse | None:
    """Make the next use build again; returns the build, for the caller to close."""
    with _lock:
        return _open.pop((spark.sparkContext.applicationId, sf_dir.rstrip("/"), version), None)

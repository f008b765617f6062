"""Every question by name.

``STAR_QUESTIONS`` take the modelled tables, wherever they came from;
``all_queries`` runs everything as ``(spark, sf_dir) -> DataFrame`` on the
commerce tables of a folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import text
from marquee.operators import checks, movement
from marquee.plans import claims, kpis, rollup, scalars, trailers
from marquee.plans.report import as_report
from marquee.plans.warehouse import Warehouse, warehouse
from marquee.sources import charts, records, reports, shop, videos
from marquee.sources.tables import Star
from marquee.streaming.snapshots import LANDED

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Parameters:
    """What the questions are asked about: the half-year under study, the
    release guard of its works, one week and one title, and the report's slicers."""

    period: str
    released_from: str
    week: str = ""
    title_name: str = ""
    slicers: dict[str, Any] = field(default_factory=dict)


# The questions registered for the commerce tables.
REGISTERED = Parameters(
    period="2001H1",
    released_from="2001-01-08",
    week="1996-02-18",
    title_name="blue widget",
    slicers={
        "first_period": "1998H1",
        "last_period": "2000H2",
        "content_type": "Show",
        "region_names": ["NATION_1", "NATION_7", "NATION_12", "Global"],
    },
)
RETENTION_NOW = "2024-02-15 00:00:00"

STAR_QUESTIONS: dict[str, Callable[[Star, Parameters], DataFrame]] = {
    # Headline questions
    "k00_topline": lambda s, p: kpis.topline(s.half),
    "k01_top_titles": lambda s, p: kpis.top_titles(s.half, s.titles),
    "k02_content_type_mix": lambda s, p: kpis.content_type_mix(s.half),
    "k03_language_mix": lambda s, p: kpis.language_mix(s.weekly, s.regions),
    "k04_half_growth": lambda s, p: kpis.half_growth(s.half),
    "k05_weekly_trend": lambda s, p: kpis.weekly_trend(s.weekly, s.regions),
    "k06_stickiness_top": lambda s, p: kpis.stickiness(s.weekly, s.regions),
    "k06_stickiness_bottom": lambda s, p: kpis.stickiness(s.weekly, s.regions, bottom=True),
    "k07_global_alignment": lambda s, p: kpis.global_alignment(s.weekly, s.regions),
    "k08_movers_up": lambda s, p: kpis.movers(s.weekly, s.regions, s.titles),
    "k08_movers_down": lambda s, p: kpis.movers(s.weekly, s.regions, s.titles, down=True),
    "t02_chart_history": lambda s, p: trailers.chart_history(s.weekly, s.regions),
    # Claim checks
    "v01_climbers": lambda s, p: claims.climbers(s.weekly, s.regions, s.titles),
    "v02_reentries": lambda s, p: claims.reentries(s.weekly, s.regions, s.titles),
    "v01_climbers_of_title": lambda s, p: claims.climbers(
        s.weekly, s.regions, s.titles, F.lit(p.week).cast("date"), p.title_name
    ),
    "v02_reentries_of_title": lambda s, p: claims.reentries(
        s.weekly, s.regions, s.titles, F.lit(p.week).cast("date"), p.title_name
    ),
    "k07_alignment_of_movies": lambda s, p: kpis.global_alignment(s.weekly, s.regions, text.MOVIE),
    "v03_type_avg": lambda s, p: claims.type_average(s.half, p.period),
    "v04_type_ratio": lambda s, p: claims.type_ratio(s.half, p.period),
    "v05_fact_counts": lambda s, p: checks.table_counts(s),
    "v06_chart_span": lambda s, p: claims.chart_span(s.weekly),
    "v07_country_count": lambda s, p: claims.country_count(s.regions),
    "v08_climb_summary": lambda s, p: claims.climb_summary(s.weekly, s.regions, s.titles),
    "v09_market_reach": lambda s, p: claims.market_reach(s.weekly, s.regions, s.titles),
    "v10_movement_states": lambda s, p: claims.movement_states(s.weekly, s.regions, s.titles),
    # Findings in prose
    "p01_movers_selfjoin": lambda s, p: kpis.movers_by_lag(s.weekly, s.regions, s.titles),
    "p02_yoy_growth": lambda s, p: kpis.yoy_growth(s.half),
    "p03_type_growth": lambda s, p: kpis.type_growth(s.half),
    "p04_sliced_topline": lambda s, p: kpis.sliced_topline(
        s.half, s.weekly, s.regions, **p.slicers
    ),
    "p05_language_yield": lambda s, p: kpis.language_yield(s.weekly, s.regions),
    "p06_growth_acceleration": lambda s, p: kpis.growth_acceleration(s.half),
    "p07_stickiness_spread": lambda s, p: kpis.stickiness_spread(s.weekly, s.regions),
    "p08_market_profile": lambda s, p: kpis.market_profile(s.weekly, s.regions),
    # Built tables
    "b01_dim_date": lambda s, p: s.dates,
    "b02_dim_title": lambda s, p: s.titles,
    "b03_dim_region": lambda s, p: s.regions,
    "b04_fact_top10_weekly": lambda s, p: _columns(s.weekly, schemas.FACT_WEEKLY),
    "b05_fact_engagement_half": lambda s, p: _columns(s.half, schemas.FACT_HALF),
    # Data quality
    "d01_title_collisions": lambda s, p: checks.title_collisions(s.half),
    "d02_chart_slots": lambda s, p: checks.chart_slots(s.weekly, s.regions),
    "d03_orphans": lambda s, p: checks.orphans(s),
    "d05_feed_overlap": lambda s, p: checks.feed_overlap(s),
}

# Questions that need more than the star: its feeds, or the trailer log.
WAREHOUSE_QUESTIONS: dict[str, Callable[[Warehouse, Parameters], DataFrame]] = {
    "t01_trailer_vs_engagement": lambda w, p: beside_hours(w.trailers, w.star, p),
    "v11_premiere_lift": lambda w, p: claims.premiere_lift(
        w.star.weekly, w.star.regions, w.star.titles, w.shows
    ),
    # The same answers without the history or the facts: from carried state and from roll-ups
    "v12_movement_carried": lambda w, p: claims.carried_states(
        movement.in_week(w.star.weekly, movement.latest_week(w.star.weekly)), w.last_seen, w.star.regions, w.star.titles
    ),
    "k00_topline_rollup": lambda w, p: rollup.topline(w.half_rollup),
    "k06_stickiness_rollup": lambda w, p: rollup.stickiness(w.chart_rollup, w.star.regions, kpis.REPORT_ROWS),
    "p04_sliced_rollup": lambda w, p: rollup.sliced_topline(w.half_rollup, w.chart_rollup, w.star.regions, **p.slicers),
    "b06_trailer_snapshot": lambda w, p: _columns(w.trailers, schemas.FACT_TRAILER),
    "b07_latest_snapshot": lambda w, p: _columns(
        trailers.latest_snapshot(w.trailers), schemas.FACT_TRAILER
    ),
    "b08_snapshot_retention": lambda w, p: _columns(
        trailers.retained(w.trailers, F.lit(RETENTION_NOW)), schemas.FACT_TRAILER
    ),
    "b09_missing_trailers": lambda w, p: trailers.missing_trailers(
        w.trailer_map, trailers.latest_snapshot(w.trailers)
    ),
    "d04_key_compare": lambda w, p: checks.key_compare(w.weekly_feed),
    # The derived feeds, written as landed files and read back
    "r01_half_exports": lambda w, p: landed_half(w),
    "r02_chart_files": lambda w, p: landed_charts(w),
    "r03_trailer_map": lambda w, p: videos.read_trailer_map(w.spark, f"{w.landed}/map"),
    "d07_rejected_records": lambda w, p: landed_records(w),
    "r04_landed_statistics": lambda w, p: _columns(w.landed_log, schemas.FACT_TRAILER),
}

# Column expressions over whole raw tables.
TABLE_QUESTIONS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "s01_runtime_parse": ("part", scalars.runtime_parse),
    "s02_category_split": ("part", scalars.category_split),
    "s03_title_key": ("part", scalars.title_key),
    "s04_half_label": ("orders", scalars.half_labels),
    "s05_date_parts": ("orders", scalars.date_parts),
    "s06_days_between": ("events", scalars.days_between),
    "s07_json_extract": ("events", scalars.json_extract),
    "s08_round": ("part", scalars.rounding),
    "d06_unparsed_values": ("part", scalars.unparsed_values),
}


def _columns(df: DataFrame, schema: str) -> DataFrame:
    return df.select(*schemas.columns(schema))


def landed_half(source: Warehouse) -> DataFrame:
    return reports.conform_half(reports.read_report_folder(source.spark, f"{source.landed}/exports"))


def landed_charts(source: Warehouse) -> DataFrame:
    return charts.weekly_feed(
        charts.read_global_chart(source.spark, f"{source.landed}/global"),
        charts.read_country_chart(source.spark, f"{source.landed}/countries"),
    )


def landed_records(source: Warehouse) -> DataFrame:
    """Good and rejected records of every landed feed, from files with broken records among them."""
    spark, folder = source.spark, source.damaged
    exports = records.headed_records(spark, f"{folder}/exports", reports.PREAMBLE_LINES)
    landed = {
        "worldwide": records.landed_tsv(spark, f"{folder}/global", schemas.GLOBAL_CHART),
        "country": records.landed_tsv(spark, f"{folder}/countries", schemas.COUNTRY_CHART),
        "trailer map": records.landed_csv(spark, f"{folder}/map", schemas.TRAILER_MAP),
        "statistics": videos.landed_responses(spark, f"{folder}/responses", LANDED, lines=True),
    }
    good = {feed: (rows, records.is_record(rows)) for feed, rows in landed.items()}
    return checks.record_counts({"half-year": (exports, F.col("good")), **good})


def beside_hours(log: DataFrame, star: Star, parameters: Parameters) -> DataFrame:
    return trailers.trailer_vs_engagement(
        log,
        star.half,
        star.weekly,
        star.titles,
        star.regions,
        period=parameters.period,
        released_from=F.lit(parameters.released_from).cast("date"),
    )


def _on_star(ask: Callable[[Star, Parameters], DataFrame]) -> Query:
    return lambda spark, sf_dir: as_report(ask(warehouse(spark, sf_dir).star, REGISTERED))


def _on_warehouse(ask: Callable[[Warehouse, Parameters], DataFrame]) -> Query:
    return lambda spark, sf_dir: as_report(ask(warehouse(spark, sf_dir), REGISTERED))


def _on_table(name: str, ask: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: as_report(ask(shop.table(spark, sf_dir, name)))


def all_queries() -> dict[str, Query]:
    return {
        **{name: _on_star(ask) for name, ask in STAR_QUESTIONS.items()},
        **{name: _on_warehouse(ask) for name, ask in WAREHOUSE_QUESTIONS.items()},
        **{name: _on_table(table, ask) for name, (table, ask) in TABLE_QUESTIONS.items()},
    }

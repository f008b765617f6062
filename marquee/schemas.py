"""Schemas of the landed feeds and of the modelled tables.

Text dates of the feeds become ``date``; fetch times are UTC wall-clock
``timestamp_ntz`` so that no session time zone can shift them.
"""

# Names of the feeds' and the model's columns, all of this file.

# Landed feeds ---------------------------------------------------------------

GLOBAL_CHART = (
    "week date, category string, weekly_rank int, show_title string, "
    "season_title string, weekly_hours_viewed double, runtime double, "
    "weekly_views double, cumulative_weeks_in_top_10 int"
)

COUNTRY_CHART = (
    "country_name string, country_iso2 string, week date, category string, "
    "weekly_rank int, show_title string, season_title string, "
    "cumulative_weeks_in_top_10 int"
)

TRAILER_MAP = (
    "title_id long, title_name string, content_type string, video_id string, "
    "channel string, note string"
)

VIDEO_ITEM = (
    "struct<id: string, statistics: struct<viewCount: string, likeCount: string>, "
    "snippet: struct<publishedAt: string>>"
)

VIDEO_RESPONSE = f"items array<{VIDEO_ITEM}>"

# Conformed feeds ------------------------------------------------------------

FEED_HALF = (
    "title_name string, content_type string, period_label string, period_start date, "
    "period_end date, is_available_globally string, release_date date, "
    "hours_viewed double, views double, runtime_minutes int"
)

FEED_WEEKLY = (
    "week_start_date date, region_name string, iso2 string, title_name string, "
    "show_title string, season_title string, content_type string, language string, "
    "weekly_rank int, hours_viewed double, views double, runtime_hours double, "
    "cumulative_weeks_in_top10 int"
)

# Modelled tables ------------------------------------------------------------

DIM_DATE = (
    "date_key date, full_date date, year int, quarter int, half_label string, "
    "month int, month_name string, iso_week int"
)

DIM_TITLE = "title_id long, title_name string, content_type string"

DIM_REGION = "region_id long, region_name string, iso2 string, is_global boolean"

FACT_WEEKLY = (
    "date_key date, title_id long, region_id long, content_type string, "
    "language string, weekly_rank int, hours_viewed double, views double, "
    "cumulative_weeks_in_top10 int"
)

FACT_HALF = (
    "date_key date, title_id long, content_type string, period_label string, "
    "is_available_globally string, release_date date, hours_viewed double, "
    "views double, runtime_minutes int"
)

FACT_TRAILER = (
    "title_id long, video_id string, view_count long, like_count long, "
    "published_at date, fetched_at timestamp_ntz"
)


def columns(schema: str) -> list[str]:
    """Column names of one of the flat schemas above, in order."""
    return [field.split()[0] for field in schema.split(", ")]

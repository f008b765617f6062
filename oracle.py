"""The same answers as plain SQL over the driver's tables, for DuckDB.

Each statement derives the modelled tables in its own common table expressions
and shares no code with the Spark jobs. Rounding goes through a decimal, since
DuckDB rounds a double by its binary value; NULL order is always stated.
"""

from __future__ import annotations


def rnd(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28, 10)), {digits}) AS DOUBLE)"


def half_label(day: str) -> str:
    return (
        f"(CAST(year({day}) AS VARCHAR) || CASE WHEN month({day}) <= 6 THEN 'H1' ELSE 'H2' END)"
    )


def text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


KIND = "CASE WHEN p_type IN ('STANDARD', 'ECONOMY', 'MEDIUM') THEN 'Show' ELSE 'Movie' END"
TONGUE = (
    "CASE WHEN split_part(p_name, ' ', 1) IN ('blue', 'cold', 'red') "
    "THEN 'Non-English' ELSE 'English' END"
)

MODEL = f"""
WITH lines AS (
  SELECT CAST(o.o_orderdate AS DATE) AS day, n.n_name AS market,
         lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS code,
         p.p_name, p.p_type, p.p_size, {KIND} AS content_type, {TONGUE} AS language,
         l.l_quantity * 10000 AS hours
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey
),
works AS (
  SELECT {half_label('day')} AS period_label, p_name AS title_name, content_type, p_type,
         CASE WHEN COUNT(DISTINCT market) = (SELECT COUNT(*) FROM nation)
              THEN 'Yes' ELSE 'No' END AS is_available_globally,
         MIN(day) AS release_date, SUM(hours) AS hours_viewed,
         CAST(COUNT(*) AS DOUBLE) AS views,
         CAST(MAX(p_size) // 10 * 60 + MAX(p_size) % 10 * 6 AS DOUBLE) AS runtime_minutes
  FROM lines GROUP BY 1, 2, 3, 4
),
day_weeks AS (
  SELECT *, day - CAST(dayofweek(day) AS INTEGER) AS week FROM lines
),
charted AS (
  SELECT 'Global' AS region_name, NULL AS iso2, week, p_name AS title_name, content_type,
         language, SUM(hours) AS hours_viewed, CAST(COUNT(*) AS DOUBLE) AS views,
         row_number() OVER (PARTITION BY week, content_type, language
                            ORDER BY SUM(hours) DESC, p_name) AS weekly_rank
  FROM day_weeks GROUP BY week, p_name, content_type, language
  UNION ALL
  SELECT market, code, week, p_name, content_type, NULL, NULL, NULL,
         row_number() OVER (PARTITION BY week, market, content_type
                            ORDER BY SUM(hours) DESC, p_name)
  FROM day_weeks GROUP BY week, market, code, p_name, content_type
),
feed AS (
  SELECT *, row_number() OVER (PARTITION BY region_name, title_name, content_type
                               ORDER BY week) AS cumulative_weeks,
         CASE WHEN content_type = 'Show' THEN split_part(title_name, ' ', 1)
              ELSE title_name END AS show_title
  FROM charted WHERE weekly_rank <= 10
),
dim_title AS (
  SELECT row_number() OVER (ORDER BY content_type, title_name) AS title_id,
         title_name, content_type
  FROM (SELECT title_name, content_type FROM works
        UNION SELECT title_name, content_type FROM feed)
),
dim_region AS (
  SELECT row_number() OVER (ORDER BY region_name) AS region_id, region_name, iso2,
         region_name = 'Global' AS is_global
  FROM (SELECT region_name, MIN(iso2) AS iso2 FROM
          (SELECT region_name, iso2 FROM feed UNION ALL SELECT 'Global', NULL)
        GROUP BY region_name)
),
half AS (
  SELECT make_date(CAST(substr(w.period_label, 1, 4) AS INTEGER),
                   CASE WHEN substr(w.period_label, 5) = 'H1' THEN 1 ELSE 7 END, 1) AS date_key,
         t.title_id, w.content_type, w.period_label, w.is_available_globally, w.release_date,
         w.hours_viewed, w.views, w.runtime_minutes
  FROM works w
  LEFT JOIN dim_title t ON t.title_name = w.title_name AND t.content_type = w.content_type
),
weekly AS (
  SELECT f.week AS date_key, t.title_id, r.region_id, f.content_type, f.language,
         CAST(f.weekly_rank AS BIGINT) AS weekly_rank, f.hours_viewed, f.views,
         CAST(f.cumulative_weeks AS BIGINT) AS cumulative_weeks_in_top10
  FROM feed f
  LEFT JOIN dim_title t ON t.title_name = f.title_name AND t.content_type = f.content_type
  LEFT JOIN dim_region r ON r.region_name = f.region_name
),
dim_date AS (
  SELECT DISTINCT date_key FROM (SELECT date_key FROM weekly UNION ALL SELECT date_key FROM half)
),
global_rows AS (
  SELECT * FROM weekly
  WHERE region_id = (SELECT region_id FROM dim_region WHERE region_name = 'Global')
),
country_rows AS (
  SELECT w.*, r.region_name, r.iso2 FROM weekly w JOIN dim_region r ON r.region_id = w.region_id
  WHERE NOT r.is_global
),
trailer_map AS (
  SELECT c.c_custkey AS video, CAST(c.c_custkey AS VARCHAR) AS video_id,
         t.title_id, t.title_name, t.content_type
  FROM customer c
  JOIN dim_title t ON t.title_id = c.c_custkey * 7 % (SELECT MAX(title_id) FROM dim_title) + 1
),
daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
         COUNT(*) FILTER (WHERE event_type = 'view') AS views,
         COUNT(*) FILTER (WHERE event_type = 'click') AS clicks
  FROM events GROUP BY 1, 2
),
so_far AS (
  SELECT user_id, CAST(day + 1 AS TIMESTAMP) AS fetched_at,
         CAST(SUM(views) OVER w AS BIGINT) AS view_count,
         NULLIF(CAST(SUM(clicks) OVER w AS DOUBLE), 0) AS like_count,
         MIN(day) OVER w AS published_at
  FROM daily
  WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING)
),
trailers AS (
  SELECT m.title_id, m.video_id, s.view_count, s.like_count, s.published_at, s.fetched_at
  FROM so_far s JOIN trailer_map m ON m.video = s.user_id
),
newest AS (
  SELECT * FROM trailers WHERE fetched_at = (SELECT MAX(fetched_at) FROM trailers)
),
chart AS (
  SELECT title_id, CAST(MIN(weekly_rank) AS DOUBLE) AS peak_global_rank,
         CAST(COUNT(DISTINCT date_key) AS DOUBLE) AS weeks_in_global_top10
  FROM global_rows GROUP BY title_id
)
"""

TOTALS = MODEL + """
, totals AS (
  SELECT period_label, SUM(hours_viewed) AS hours,
         row_number() OVER (ORDER BY period_label) AS n
  FROM half GROUP BY period_label
),
grown AS (
  SELECT a.n, a.period_label, a.hours, a.hours - b.hours AS gain,
         100e0 * (a.hours - b.hours) / nullif(b.hours, 0) AS pct
  FROM totals a LEFT JOIN totals b ON b.n = a.n - 1
)
"""

LAGGED = MODEL + """
, moves AS (
  SELECT w.*, p.weekly_rank AS prior_rank, p.date_key AS prior_date
  FROM weekly w ASOF LEFT JOIN weekly p
    ON p.region_id = w.region_id AND p.title_id = w.title_id AND p.date_key < w.date_key
),
last_week AS (
  SELECT m.*, r.region_name, r.is_global, t.title_name
  FROM moves m JOIN dim_region r USING (region_id) JOIN dim_title t USING (title_id)
  WHERE m.date_key = (SELECT MAX(date_key) FROM weekly)
)
"""

STICKY = MODEL + """
, sticky AS (
  SELECT region_name, iso2, AVG(cumulative_weeks_in_top10) AS mean_weeks,
         COUNT(DISTINCT title_id) AS distinct_titles_ever_in_top10
  FROM country_rows GROUP BY region_name, iso2
),
aligned AS (
  SELECT c.region_name, c.content_type, COUNT(*) AS weeks_compared,
         100e0 * COUNT(*) FILTER (WHERE c.title_id = g.title_id) / COUNT(*) AS pct
  FROM country_rows c
  JOIN global_rows g USING (date_key, content_type)
  WHERE c.weekly_rank = 1 AND g.weekly_rank = 1 AND g.language = 'English'
    AND date_diff('day', date_key, (SELECT MAX(date_key) FROM weekly)) <= 364
  GROUP BY c.region_name, c.content_type
)
"""

PERIOD = "2001H1"
RELEASED_FROM = "2001-01-08"
WEEK, TITLE = "1996-02-18", "blue widget"
RETENTION_NOW = "2024-02-15 00:00:00"


def stickiness(order: str) -> str:
    return STICKY + f"""
SELECT region_name, iso2, {rnd('mean_weeks', 2)} AS avg_weeks_a_title_sticks_in_top10,
       distinct_titles_ever_in_top10
FROM sticky ORDER BY 3 {order} NULLS LAST, region_name LIMIT 15
"""


def movers(order: str) -> str:
    return LAGGED + f"""
SELECT region_name, title_name, weekly_rank, prior_rank AS prior_week_rank,
       prior_rank - weekly_rank AS rank_improvement
FROM last_week WHERE prior_rank IS NOT NULL AND prior_date = date_key - 7
ORDER BY rank_improvement {order} NULLS LAST, region_name, title_name, content_type LIMIT 15
"""


TRAILER_COLUMNS = (
    "title_id, video_id, view_count, like_count, "
    f"{text('published_at')} AS published_at, {stamp('fetched_at')} AS fetched_at"
)

PLAIN_RUNTIME = "(CAST(p_size // 10 AS VARCHAR) || ':' || lpad(CAST(p_size % 10 * 6 AS VARCHAR), 2, '0'))"


# Queries that answer a question of another name from other tables.
SAME_ANSWER = {
    "k00_topline_rollup": "k00_topline",
    "k06_stickiness_rollup": "k06_stickiness_top",
    "p04_sliced_rollup": "p04_sliced_topline",
    "v12_movement_carried": "v10_movement_states",
}


def all_oracles() -> dict[str, str]:
    own = _own_oracles()
    return {**own, **{name: own[other] for name, other in SAME_ANSWER.items()}}


def _own_oracles() -> dict[str, str]:
    return {
        "k00_topline": MODEL + f"""
SELECT period_label, COUNT(DISTINCT title_id) AS titles_tracked,
       {rnd('SUM(hours_viewed) / 1e9', 2)} AS total_hours_billion,
       {rnd('AVG(hours_viewed) / 1e6', 2)} AS avg_hours_per_title_million
FROM half GROUP BY period_label ORDER BY period_label
""",
        "k01_top_titles": MODEL + f"""
SELECT period_label, RANK() OVER best AS rank_in_period, title_name, content_type,
       {rnd('hours_viewed / 1e6', 1)} AS hours_viewed_million,
       {rnd('100e0 * SUM(hours_viewed) OVER listed / nullif(SUM(hours_viewed) OVER everything, 0)', 2)}
         AS cumulative_pct_of_total_hours
FROM half JOIN dim_title USING (title_id, content_type)
WINDOW everything AS (PARTITION BY period_label),
       best AS (PARTITION BY period_label ORDER BY hours_viewed DESC NULLS LAST),
       listed AS (PARTITION BY period_label
                  ORDER BY hours_viewed DESC NULLS LAST, title_name, content_type
                  ROWS UNBOUNDED PRECEDING)
QUALIFY rank_in_period <= 10
""",
        "k02_content_type_mix": MODEL + f"""
SELECT period_label, content_type, {rnd('SUM(hours_viewed) / 1e9', 2)} AS hours_billion,
       {rnd('100e0 * SUM(hours_viewed) / nullif(SUM(SUM(hours_viewed)) OVER (PARTITION BY period_label), 0)', 1)}
         AS pct_of_period_hours,
       {rnd('AVG(hours_viewed) / 1e6', 2)} AS avg_hours_per_title_million,
       COUNT(*) AS titles
FROM half GROUP BY period_label, content_type ORDER BY period_label, content_type
""",
        "k03_language_mix": MODEL + f"""
SELECT language, content_type, {rnd('SUM(hours_viewed) / 1e9', 2)} AS hours_billion,
       COUNT(DISTINCT title_id) AS distinct_titles_in_top10
FROM global_rows GROUP BY language, content_type
ORDER BY hours_billion DESC NULLS LAST, language, content_type
""",
        "k04_half_growth": TOTALS + f"""
SELECT period_label, {rnd('hours / 1e9', 2)} AS total_hours_billion,
       {rnd('gain / 1e9', 2)} AS change_vs_prior_half_billion,
       {rnd('pct', 2)} AS pct_change_vs_prior_half
FROM grown
""",
        "k05_weekly_trend": MODEL + f"""
, weeks AS (
  SELECT date_key, SUM(hours_viewed) AS hours, row_number() OVER (ORDER BY date_key) AS n
  FROM global_rows GROUP BY date_key
)
SELECT {text('a.date_key')} AS date_key, {rnd('a.hours / 1e6', 1)} AS weekly_hours_million,
       {rnd('AVG(b.hours) / 1e6', 1)} AS trailing_4wk_avg_million
FROM weeks a JOIN weeks b ON b.n BETWEEN a.n - 3 AND a.n
WHERE a.n > (SELECT MAX(n) - 26 FROM weeks)
GROUP BY a.date_key, a.hours
""",
        "k06_stickiness_top": stickiness("DESC"),
        "k06_stickiness_bottom": stickiness("ASC"),
        "k07_global_alignment": STICKY + f"""
SELECT region_name, content_type, {rnd('pct', 1)} AS pct_weeks_matching_global_no1, weeks_compared
FROM aligned ORDER BY 3 DESC NULLS LAST, region_name, content_type LIMIT 15
""",
        "k08_movers_up": movers("DESC"),
        "k08_movers_down": movers("ASC"),
        "t01_trailer_vs_engagement": MODEL + f"""
, beside AS (
  SELECT title_id, title_name, n.view_count, n.fetched_at, n.published_at, h.hours_viewed,
         dim_title.content_type
  FROM newest n JOIN dim_title USING (title_id) JOIN half h USING (title_id)
  WHERE h.period_label = '{PERIOD}' AND h.release_date >= DATE '{RELEASED_FROM}'
)
SELECT title_name, content_type, view_count AS trailer_views,
       CAST(trunc((epoch(fetched_at) - epoch(CAST(published_at AS TIMESTAMP))) / 86400) AS BIGINT)
         AS days_since_trailer,
       {rnd('hours_viewed / 1e6', 1)} AS hours_viewed_million,
       peak_global_rank, weeks_in_global_top10,
       RANK() OVER by_views AS trailer_rank_in_type, RANK() OVER by_hours AS hours_rank_in_type
FROM beside LEFT JOIN chart USING (title_id)
WINDOW by_views AS (PARTITION BY content_type ORDER BY view_count DESC NULLS LAST),
       by_hours AS (PARTITION BY content_type ORDER BY hours_viewed DESC NULLS LAST)
""",
        "t02_chart_history": MODEL + "SELECT * FROM chart",
        "v01_climbers": LAGGED + """
SELECT title_name, content_type, region_name, weekly_rank, prior_rank,
       prior_rank - weekly_rank AS improvement
FROM last_week WHERE NOT is_global AND prior_date = date_key - 7 AND prior_rank > weekly_rank
""",
        "v01_climbers_of_title": MODEL + f"""
, asked AS (SELECT title_id, title_name FROM dim_title WHERE title_name = '{TITLE}'),
two_weeks AS (
  SELECT a.title_name, w.title_id, w.region_id, w.date_key, w.weekly_rank
  FROM weekly w JOIN asked a ON a.title_id = w.title_id
  WHERE w.date_key IN (DATE '{WEEK}', DATE '{WEEK}' - 7)
),
compared AS (
  SELECT title_name, title_id, region_id, MAX(weekly_rank) FILTER (date_key = DATE '{WEEK}') AS weekly_rank,
         MAX(weekly_rank) FILTER (date_key < DATE '{WEEK}') AS prior_rank
  FROM two_weeks GROUP BY title_name, title_id, region_id
)
SELECT c.title_name, t.content_type, r.region_name, c.weekly_rank, c.prior_rank, c.prior_rank - c.weekly_rank AS improvement
FROM compared c JOIN dim_region r ON r.region_id = c.region_id JOIN dim_title t ON t.title_id = c.title_id
WHERE NOT r.is_global AND c.prior_rank > c.weekly_rank
""",
        "v02_reentries_of_title": MODEL + f"""
SELECT t.title_name, t.content_type, COUNT(*) AS markets_entered
FROM country_rows c JOIN dim_title t USING (title_id)
LEFT JOIN weekly p ON p.region_id = c.region_id AND p.title_id = c.title_id AND p.date_key = c.date_key - 7
WHERE c.date_key = DATE '{WEEK}' AND t.title_name = '{TITLE}' AND p.title_id IS NULL
GROUP BY t.title_name, t.content_type
""",
        "k07_alignment_of_movies": STICKY + f"""
SELECT region_name, content_type, {rnd('pct', 1)} AS pct_weeks_matching_global_no1, weeks_compared
FROM aligned WHERE content_type = 'Movie' ORDER BY 3 DESC NULLS LAST, region_name, content_type LIMIT 15
""",
        "v02_reentries": LAGGED + """
SELECT title_name, content_type, COUNT(*) AS markets_entered FROM last_week
WHERE NOT is_global AND (prior_date IS NULL OR prior_date <> date_key - 7)
GROUP BY title_name, content_type
""",
        "v03_type_avg": MODEL + f"""
SELECT content_type, {rnd('AVG(hours_viewed) / 1e6', 2)} AS avg_m, COUNT(*) AS titles
FROM half WHERE period_label = '{PERIOD}' GROUP BY content_type
""",
        "v04_type_ratio": MODEL + f"""
SELECT {rnd("AVG(hours_viewed) FILTER (WHERE content_type = 'Show') / nullif(AVG(hours_viewed) FILTER (WHERE content_type = 'Movie'), 0)", 2)}
         AS show_movie_hours_per_title_ratio
FROM half WHERE period_label = '{PERIOD}'
""",
        "v05_fact_counts": MODEL + """
, counts AS (
  SELECT 'dim_date' AS table_name, COUNT(*) AS row_count FROM dim_date
  UNION ALL SELECT 'dim_title', COUNT(*) FROM dim_title
  UNION ALL SELECT 'dim_region', COUNT(*) FROM dim_region
  UNION ALL SELECT 'fact_top10_weekly', COUNT(*) FROM weekly
  UNION ALL SELECT 'fact_engagement_half', COUNT(*) FROM half
)
SELECT * FROM counts
UNION ALL SELECT 'both facts', CAST(SUM(row_count) AS BIGINT) FROM counts
WHERE table_name LIKE 'fact%'
""",
        "v06_chart_span": MODEL + f"""
SELECT {text('MIN(date_key)')} AS first_week, {text('MAX(date_key)')} AS last_week FROM weekly
""",
        "v07_country_count": MODEL + "SELECT COUNT(*) AS countries FROM dim_region WHERE NOT is_global",
        "v08_climb_summary": LAGGED + """
SELECT title_name, content_type, COUNT(*) AS markets_climbed,
       MIN(prior_rank - weekly_rank) AS smallest_climb, MAX(prior_rank - weekly_rank) AS largest_climb
FROM last_week WHERE NOT is_global AND prior_date = date_key - 7 AND prior_rank > weekly_rank
GROUP BY title_name, content_type
""",
        "v09_market_reach": MODEL + f"""
SELECT t.title_name, t.content_type, {text('c.date_key')} AS date_key,
       COUNT(DISTINCT c.region_id) AS markets
FROM country_rows c JOIN dim_title t ON t.title_id = c.title_id
GROUP BY t.title_name, t.content_type, c.date_key
""",
        "v10_movement_states": LAGGED + """
SELECT content_type,
       CASE WHEN prior_date IS NULL THEN 'debut' WHEN prior_date <> date_key - 7 THEN 'comeback'
            WHEN prior_rank > weekly_rank THEN 'climbed' WHEN prior_rank < weekly_rank THEN 'fell'
            ELSE 'unchanged' END AS state,
       COUNT(*) AS chart_rows
FROM last_week WHERE NOT is_global GROUP BY 1, 2
""",
        "v11_premiere_lift": MODEL + f"""
, seasons AS (
  SELECT c.date_key, c.region_id, c.title_id, t.title_name,
         split_part(t.title_name, ' ', 1) AS show_title
  FROM country_rows c JOIN dim_title t ON t.title_id = c.title_id
  WHERE t.content_type = 'Show'
),
premieres AS (
  SELECT show_title, title_id, title_name, MIN(date_key) AS premiere
  FROM seasons GROUP BY show_title, title_id, title_name
)
SELECT s.show_title, s.title_name, {text('s.premiere')} AS premiere_week,
       COUNT(DISTINCT CASE WHEN c.date_key = s.premiere - 7 THEN c.region_id END) AS markets_before,
       COUNT(DISTINCT CASE WHEN c.date_key = s.premiere THEN c.region_id END) AS markets_premiere,
       COUNT(DISTINCT CASE WHEN c.date_key = s.premiere + 7 THEN c.region_id END) AS markets_after
FROM premieres s
JOIN premieres e ON e.show_title = s.show_title AND e.premiere < s.premiere
JOIN seasons c ON c.title_id = e.title_id
GROUP BY s.show_title, s.title_name, s.premiere
""",
        "p01_movers_selfjoin": movers("DESC"),
        "p02_yoy_growth": MODEL + f"""
, now AS (
  SELECT period_label, COUNT(DISTINCT title_id) AS titles, SUM(hours_viewed) AS hours
  FROM half GROUP BY period_label
)
SELECT n.period_label, n.titles, CAST(a.titles AS DOUBLE) AS titles_year_ago,
       {rnd('100e0 * (n.titles - a.titles) / nullif(a.titles, 0)', 2)} AS pct_change_titles,
       {rnd('n.hours / 1e9', 2)} AS total_hours_billion,
       {rnd('100e0 * (n.hours - a.hours) / nullif(a.hours, 0)', 2)} AS pct_change_hours
FROM now n LEFT JOIN now a
  ON CAST(substr(a.period_label, 1, 4) AS INTEGER) + 1 = CAST(substr(n.period_label, 1, 4) AS INTEGER)
 AND substr(a.period_label, 5) = substr(n.period_label, 5)
""",
        "p03_type_growth": MODEL + f"""
, mix AS (
  SELECT content_type, period_label, SUM(hours_viewed) AS hours, COUNT(*) AS titles
  FROM half GROUP BY content_type, period_label
),
grown AS (
  SELECT *, LAG(hours) OVER t AS hours_before, LAG(titles) OVER t AS titles_before,
         SUM(titles) OVER (PARTITION BY period_label) AS all_titles
  FROM mix WINDOW t AS (PARTITION BY content_type ORDER BY period_label)
)
SELECT content_type, period_label, {rnd('hours / 1e9', 2)} AS hours_billion, titles,
       {rnd('100e0 * (hours - hours_before) / nullif(hours_before, 0)', 2)} AS pct_change_hours,
       {rnd('100e0 * (titles - titles_before) / nullif(titles_before, 0)', 2)} AS pct_change_titles,
       {rnd('100e0 * titles / all_titles', 1)} AS pct_of_titles
FROM grown
""",
        "p04_sliced_topline": MODEL + f"""
SELECT {rnd('SUM(hours_viewed) / 1e9', 2)} AS total_hours_billion,
       COUNT(DISTINCT title_id) AS titles_tracked,
       {rnd('AVG(hours_viewed) / 1e6', 2)} AS avg_hours_per_title_million,
       (SELECT COUNT(DISTINCT w.region_id) FROM weekly w
        JOIN dim_region r ON r.region_id = w.region_id
        WHERE {half_label('w.date_key')} BETWEEN '1998H1' AND '2000H2'
          AND w.content_type = 'Show'
          AND r.region_name IN ('NATION_1', 'NATION_7', 'NATION_12', 'Global')) AS distinct_regions
FROM half WHERE period_label BETWEEN '1998H1' AND '2000H2' AND content_type = 'Show'
""",
        "p05_language_yield": MODEL + f"""
SELECT language, content_type, COUNT(DISTINCT title_id) AS distinct_titles_in_top10,
       {rnd('SUM(hours_viewed) / 1e9', 2)} AS hours_billion,
       {rnd('SUM(hours_viewed) / nullif(COUNT(DISTINCT title_id), 0) / 1e6', 2)} AS hours_per_title_million
FROM global_rows GROUP BY language, content_type
""",
        "p06_growth_acceleration": TOTALS + f"""
SELECT a.period_label, {rnd('a.pct', 2)} AS pct_change_vs_prior_half,
       {rnd('a.pct - b.pct', 2)} AS acceleration_pct_points
FROM grown a LEFT JOIN grown b ON b.n = a.n - 1
""",
        "p07_stickiness_spread": STICKY + f"""
SELECT {rnd('MAX(mean_weeks)', 2)} AS longest_avg_weeks,
       {rnd('MIN(mean_weeks)', 2)} AS shortest_avg_weeks,
       {rnd('MAX(mean_weeks) / nullif(MIN(mean_weeks), 0)', 2)} AS spread_ratio
FROM sticky
""",
        "p08_market_profile": STICKY + f"""
SELECT s.region_name, s.iso2, a.content_type,
       {rnd('s.mean_weeks', 2)} AS avg_weeks_a_title_sticks_in_top10,
       s.distinct_titles_ever_in_top10,
       {rnd('a.pct', 1)} AS pct_weeks_matching_global_no1, a.weeks_compared
FROM sticky s JOIN aligned a ON a.region_name = s.region_name
""",
        "b01_dim_date": MODEL + f"""
SELECT {text('date_key')} AS date_key, {text('date_key')} AS full_date,
       year(date_key) AS year, quarter(date_key) AS quarter, {half_label('date_key')} AS half_label,
       month(date_key) AS month, monthname(date_key) AS month_name, week(date_key) AS iso_week
FROM dim_date
""",
        "b02_dim_title": MODEL + "SELECT title_id, title_name, content_type FROM dim_title",
        "b03_dim_region": MODEL + "SELECT region_id, region_name, iso2, is_global FROM dim_region",
        "b04_fact_top10_weekly": MODEL + f"""
SELECT {text('date_key')} AS date_key, title_id, region_id, content_type, language, weekly_rank,
       hours_viewed, views, cumulative_weeks_in_top10 FROM weekly
""",
        "b05_fact_engagement_half": MODEL + f"""
SELECT {text('date_key')} AS date_key, title_id, content_type, period_label,
       is_available_globally, {text('release_date')} AS release_date, hours_viewed, views,
       runtime_minutes FROM half
""",
        "b06_trailer_snapshot": MODEL + f"SELECT {TRAILER_COLUMNS} FROM trailers",
        "b07_latest_snapshot": MODEL + f"SELECT {TRAILER_COLUMNS} FROM newest",
        "b08_snapshot_retention": MODEL + f"""
SELECT {TRAILER_COLUMNS} FROM trailers
WHERE epoch(TIMESTAMP '{RETENTION_NOW}') - epoch(fetched_at) <= 30 * 86400
""",
        "b09_missing_trailers": MODEL + """
, mapped AS (SELECT e.user_id, CAST(e.ts AS DATE) AS day FROM events e JOIN customer c ON c.c_custkey = e.user_id),
returned AS (SELECT DISTINCT user_id AS video FROM mapped WHERE day = (SELECT MAX(day) FROM mapped))
SELECT title_name, content_type, video_id FROM trailer_map ANTI JOIN returned USING (video)
""",
        "r01_half_exports": MODEL + f"""
SELECT title_name, content_type, period_label, {text('half_first')} AS period_start,
       {text("half_first + INTERVAL 6 MONTH - INTERVAL 1 DAY")}[:10] AS period_end, is_available_globally,
       {text('release_date')} AS release_date, hours_viewed, views, runtime_minutes
FROM (SELECT *, make_date(CAST(substr(period_label, 1, 4) AS INTEGER),
                          CASE WHEN substr(period_label, 5) = 'H1' THEN 1 ELSE 7 END, 1) AS half_first FROM works)
""",
        "r02_chart_files": MODEL + f"""
SELECT {text('week')} AS week_start_date, region_name, iso2, title_name, show_title,
       CASE WHEN content_type = 'Show' THEN title_name ELSE 'N/A' END AS season_title, content_type, language,
       CAST(weekly_rank AS BIGINT) AS weekly_rank, hours_viewed, views, CAST(NULL AS DOUBLE) AS runtime_hours,
       CAST(cumulative_weeks AS BIGINT) AS cumulative_weeks_in_top10
FROM feed
""",
        "r03_trailer_map": MODEL + """
SELECT title_id, title_name, content_type, video_id, 'channel' AS channel,
       'number ' || video_id || ', "derived"' AS note
FROM trailer_map
""",
        "d07_rejected_records": MODEL + """
SELECT 'half-year' AS feed, COUNT(*) FILTER (views % 5 <> 0) AS good_records, COUNT(*) FILTER (views % 5 = 0) AS rejected_records FROM works
UNION ALL SELECT 'worldwide', COUNT(*) FILTER (weekly_rank NOT IN (7, 9)), COUNT(*) FILTER (weekly_rank IN (7, 9)) FROM feed WHERE region_name = 'Global'
UNION ALL SELECT 'country', COUNT(*) FILTER (weekly_rank <> 7), COUNT(*) FILTER (weekly_rank = 7) FROM feed WHERE region_name <> 'Global'
UNION ALL SELECT 'trailer map', COUNT(*) FILTER (title_id % 4 <> 0), COUNT(*) FILTER (title_id % 4 = 0) FROM trailer_map
UNION ALL SELECT 'statistics', COUNT(*) FILTER (day(fetched) % 5 <> 0), COUNT(*) FILTER (day(fetched) % 5 = 0)
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) + 1 AS fetched FROM events)
""",
        "r04_landed_statistics": MODEL + f"SELECT {TRAILER_COLUMNS} FROM trailers",
        "d06_unparsed_values": f"""
WITH raw AS (
  SELECT p_size, p_size % 17 AS odd, CASE WHEN {KIND} = 'Show' THEN 'TV' ELSE 'Films' END AS kind, p_type FROM part
)
SELECT 'half-year' AS feed, 'runtime' AS rule, COUNT(*) FILTER (p_size % 7 = 0 OR p_size % 11 = 0 OR p_size % 13 = 0) AS "values" FROM raw
UNION ALL SELECT 'half-year', 'hours', COUNT(*) FILTER (odd = 0) FROM raw
UNION ALL SELECT 'half-year', 'views', 0
UNION ALL SELECT 'half-year', 'release date', COUNT(*) FILTER (odd = 3) FROM raw
UNION ALL SELECT 'worldwide', 'category', COUNT(*) FILTER (p_size % 5 = 0 OR p_size % 7 = 0) FROM raw
UNION ALL SELECT 'country', 'category', COUNT(*) FILTER (p_size % 5 <> 0) FROM raw
""",
        "s01_runtime_parse": f"""
SELECT p_partkey,
       CASE WHEN p_size % 7 = 0 THEN CAST(p_size AS VARCHAR)
            WHEN p_size % 11 = 0 THEN {PLAIN_RUNTIME} || ':00'
            WHEN p_size % 13 = 0 THEN CAST(p_size AS VARCHAR) || ':xx'
            ELSE {PLAIN_RUNTIME} END AS runtime_raw,
       CASE WHEN p_size % 7 = 0 OR p_size % 11 = 0 OR p_size % 13 = 0 THEN NULL
            ELSE CAST(p_size // 10 * 60 + p_size % 10 * 6 AS DOUBLE) END AS runtime_minutes
FROM part
""",
        "s02_category_split": f"""
WITH raw AS (
  SELECT p_partkey, CASE WHEN {KIND} = 'Show' THEN 'TV' ELSE 'Films' END AS kind,
         {TONGUE} AS tongue, p_size, p_type FROM part
),
cat AS (
  SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN kind WHEN p_size % 7 = 0 THEN p_type
                         ELSE kind || ' (' || tongue || ')' END AS category_raw FROM raw
)
SELECT p_partkey, category_raw,
       CASE WHEN category_raw LIKE 'Films%' THEN 'Movie' ELSE 'Show' END AS content_type,
       CASE WHEN category_raw LIKE '%Non-English%' THEN 'Non-English' ELSE 'English' END AS language,
       CASE category_raw WHEN 'Films' THEN 'Movie' WHEN 'TV' THEN 'Show' ELSE category_raw END AS recoded
FROM cat
""",
        "s03_title_key": """
WITH raw AS (
  SELECT p_partkey, split_part(p_name, ' ', 1) AS show_title,
         CASE WHEN p_size % 2 = 0 THEN '  ' || p_name || ' ' WHEN p_size % 3 = 0 THEN 'nan'
              WHEN p_size % 5 = 0 THEN ' ' WHEN p_size % 7 <> 0 THEN 'N/A' END AS season_title
  FROM part
)
SELECT p_partkey, show_title, season_title,
       CASE WHEN season_title IS NULL OR trim(season_title) IN ('N/A', 'nan', '')
            THEN trim(show_title) ELSE trim(season_title) END AS title_name
FROM raw
""",
        "s04_half_label": f"""
SELECT o_orderkey, {half_label('CAST(o_orderdate AS DATE)')} AS half_label FROM orders
""",
        "s05_date_parts": f"""
SELECT o_orderkey, {text('day')} AS day, year(day) AS year, quarter(day) AS quarter,
       {half_label('day')} AS half_label, month(day) AS month, monthname(day) AS month_name,
       week(day) AS iso_week
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)
""",
        "s06_days_between": """
SELECT event_id,
       CAST(trunc((epoch(ts) - epoch(TIMESTAMP '2024-01-15 12:00:00')) / 86400) AS BIGINT) AS days
FROM events
""",
        "s07_json_extract": """
SELECT event_id, COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k,
       COALESCE(TRY_CAST(json_extract_string(props, '$.likes') AS BIGINT), 0) AS likes_or_zero,
       CAST(TRY_CAST(json_extract_string(props, '$.likes') AS BIGINT) AS DOUBLE) AS likes
FROM events
""",
        "s08_round": f"""
SELECT p_partkey, {rnd('p_retailprice / 1000e0', 2)} AS thousands,
       {rnd('p_retailprice / 7e0', 1)} AS sevenths,
       {rnd('p_retailprice * 0.0005e0', 2)} AS two_thousandths
FROM part
""",
        "d01_title_collisions": MODEL + """
SELECT title_id, period_label, COUNT(*) AS works, COUNT(DISTINCT release_date) AS release_dates
FROM half GROUP BY title_id, period_label HAVING COUNT(*) > 1
""",
        "d02_chart_slots": MODEL + f"""
, weeks AS (SELECT DISTINCT date_key FROM weekly),
due AS (
  SELECT d.date_key, r.region_id, r.region_name, k.content_type
  FROM weeks d, dim_region r, (VALUES ('Show'), ('Movie')) k(content_type) WHERE NOT r.is_global
),
filled AS (SELECT date_key, region_id, content_type, COUNT(*) AS n FROM weekly GROUP BY date_key, region_id, content_type)
SELECT {text('due.date_key')} AS date_key, due.region_name, due.content_type, COALESCE(f.n, 0) AS slots_filled
FROM due LEFT JOIN filled f ON f.date_key = due.date_key AND f.region_id = due.region_id AND f.content_type = due.content_type
WHERE COALESCE(f.n, 0) <> 10
""",
        "d03_orphans": MODEL + """
SELECT 'fact_top10_weekly' AS table_name, 'title_id' AS key_name, COUNT(*) AS orphan_rows
FROM weekly w WHERE NOT EXISTS (SELECT 1 FROM dim_title d WHERE d.title_id = w.title_id)
UNION ALL SELECT 'fact_top10_weekly', 'region_id', COUNT(*)
FROM weekly w WHERE NOT EXISTS (SELECT 1 FROM dim_region d WHERE d.region_id = w.region_id)
UNION ALL SELECT 'fact_top10_weekly', 'date_key', COUNT(*)
FROM weekly w WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = w.date_key)
UNION ALL SELECT 'fact_engagement_half', 'title_id', COUNT(*)
FROM half h WHERE NOT EXISTS (SELECT 1 FROM dim_title d WHERE d.title_id = h.title_id)
UNION ALL SELECT 'fact_engagement_half', 'date_key', COUNT(*)
FROM half h WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = h.date_key)
""",
        "d04_key_compare": MODEL + """
, season_groups AS (
  SELECT COUNT(*) AS n FROM feed GROUP BY region_name, week, content_type, language, title_name
),
show_groups AS (
  SELECT COUNT(*) AS n FROM feed GROUP BY region_name, week, content_type, language, show_title
)
SELECT 'season_title' AS key_kind, COUNT(*) FILTER (WHERE n > 1) AS merged_groups,
       CAST(COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS merged_rows FROM season_groups
UNION ALL
SELECT 'show_title', COUNT(*) FILTER (WHERE n > 1),
       CAST(COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) FROM show_groups
""",
        "d05_feed_overlap": MODEL + """
SELECT content_type,
       COUNT(*) FILTER (WHERE in_half AND in_charts) AS in_both,
       COUNT(*) FILTER (WHERE in_half AND NOT in_charts) AS half_only,
       COUNT(*) FILTER (WHERE NOT in_half AND in_charts) AS charts_only
FROM (SELECT content_type, title_id IN (SELECT title_id FROM half) AS in_half,
             title_id IN (SELECT title_id FROM weekly) AS in_charts FROM dim_title)
GROUP BY content_type
""",
    }

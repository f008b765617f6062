from datetime import date

import pytest
from pyspark.sql import functions as F

from marquee.operators import movement
from marquee.plans import claims, kpis
from tests.fixtures import star, tuples, week


def test_ties_at_the_cut_are_all_kept(spark):
    hours = [100.0 - i for i in range(8)] + [50.0, 50.0, 50.0, 1.0]
    model = star(spark, half=[(f"T{i:02d}", "Show", "2024H1", None, h) for i, h in enumerate(hours)])
    rows = kpis.top_titles(model.half, model.titles).collect()
    assert [r.rank_in_period for r in rows] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9]
    running, total = [], sum(hours)
    for h in hours[:11]:
        running.append((running[-1] if running else 0) + h)
    assert [r.cumulative_pct_of_total_hours for r in rows] == [round(100 * x / total, 2) for x in running]


def test_running_share_grows_and_ends_at_one_hundred(smoke):
    rows = tuples(
        kpis.top_titles(smoke.star.half, smoke.star.titles, top=10**6),
        "period_label", "cumulative_pct_of_total_hours",
    )
    assert len(rows) == smoke.star.half.count()
    last = {}
    for period, share in rows:
        assert share >= last.get(period, 0.0)
        last[period] = share
    assert set(last.values()) == {100.0}


def test_missing_hours(spark):
    model = star(
        spark,
        half=[
            ("A", "Show", "2024H1", None, 4e6), ("B", "Show", "2024H1", None, None),
            ("C", "Show", "2024H2", None, None), ("D", "Movie", "2025H1", None, 0.0),
        ],
    )
    assert tuples(kpis.topline(model.half)) == [
        ("2024H1", 2, 0.0, 4.0), ("2024H2", 1, None, None), ("2025H1", 1, 0.0, 0.0),
    ]
    mix = {r.period_label: r for r in kpis.content_type_mix(model.half).collect()}
    assert mix["2024H1"].titles == 2 and mix["2024H2"].hours_billion is None
    assert mix["2025H1"].pct_of_period_hours is None
    ranks = tuples(kpis.top_titles(model.half, model.titles), "title_name", "rank_in_period")
    assert ("B", 2) in ranks


def test_growth_from_nothing_is_unknown(spark):
    model = star(
        spark,
        half=[
            ("A", "Show", "2024H1", None, 0.0), ("A", "Show", "2024H2", None, 2e9),
            ("A", "Show", "2025H1", None, 3e9), ("A", "Show", "2025H2", None, 6e9),
        ],
    )
    assert tuples(kpis.half_growth(model.half)) == [
        ("2024H1", 0.0, None, None), ("2024H2", 2.0, 2.0, None),
        ("2025H1", 3.0, 1.0, 50.0), ("2025H2", 6.0, 3.0, 100.0),
    ]
    assert tuples(kpis.growth_acceleration(model.half), "acceleration_pct_points") == [
        (None,), (None,), (None,), (50.0,),
    ]
    year = {r.period_label: r for r in kpis.yoy_growth(model.half).collect()}
    assert year["2025H1"].pct_change_hours is None and year["2025H2"].pct_change_hours == 200.0
    assert year["2024H1"].titles_year_ago is None


def test_yoy_skips_a_missing_half(spark):
    model = star(
        spark,
        half=[("A", "Show", p, None, 1e9) for p in ("2023H1", "2023H2", "2024H2")],
    )
    rows = {r.period_label: r.titles_year_ago for r in kpis.yoy_growth(model.half).collect()}
    assert rows == {"2023H1": None, "2023H2": None, "2024H2": 1}


def test_shares_of_a_period_sum_to_one_hundred(smoke):
    mix = kpis.content_type_mix(smoke.star.half).groupBy("period_label").agg(
        F.sum("pct_of_period_hours").alias("all")
    )
    assert all(abs(r["all"] - 100.0) <= 0.1 + 1e-9 for r in mix.collect())


def test_trailing_mean_runs_over_rows_and_before_the_cut(spark):
    weeks = [0, 1, 2, 4, 5]
    model = star(
        spark,
        weekly=[(n, "Global", "A", "Show", 1, "English", (i + 1) * 1e6) for i, n in enumerate(weeks)],
    )
    assert tuples(kpis.weekly_trend(model.weekly, model.regions, weeks=2)) == [
        (week(5), 5.0, 3.5), (week(4), 4.0, 2.5),
    ]
    assert kpis.weekly_trend(model.weekly, model.regions).count() == 5


def test_language_mix_reads_the_worldwide_chart_only(spark):
    model = star(
        spark,
        weekly=[
            (0, "Global", "A", "Movie", 1, "English", 4e9),
            (1, "Global", "A", "Movie", 1, "English", 2e9),
            (0, "Global", "B", "Movie", 1, "Non-English", 1e9),
            (0, "Peru", "A", "Movie", 1),
        ],
    )
    assert tuples(kpis.language_mix(model.weekly, model.regions)) == [
        ("English", "Movie", 6.0, 1), ("Non-English", "Movie", 1.0, 1),
    ]
    yields = tuples(kpis.language_yield(model.weekly, model.regions), "hours_per_title_million")
    assert yields == [(6000.0,), (1000.0,)]


def test_stickiness_is_weighted_by_chart_rows(spark):
    model = star(
        spark,
        weekly=[(n, "Peru", "A", "Show", 1, None, None, n + 1) for n in range(3)]
        + [(0, "Peru", "B", "Show", 2), (0, "Chad", "C", "Show", 1), (0, "Global", "A", "Show", 1, "English", 1.0, 9)],
    )
    assert tuples(kpis.stickiness(model.weekly, model.regions)) == [
        ("Peru", "PE", 1.75, 2), ("Chad", "CH", 1.0, 1),
    ]
    bottom = kpis.stickiness(model.weekly, model.regions, bottom=True, limit=1)
    assert tuples(bottom, "region_name") == [("Chad",)]
    assert tuples(kpis.stickiness_spread(model.weekly, model.regions)) == [(1.75, 1.0, 1.75)]


def alignment_model(spark):
    weekly = []
    for n in range(54):
        weekly.append((n, "Global", "A", "Show", 1, "English", 1.0))
        weekly.append((n, "Global", "X", "Show", 1, "Non-English", 1.0))
        weekly.append((n, "Peru", "A" if n % 2 else "X", "Show", 1))
        weekly.append((n, "Peru", "X" if n % 2 else "A", "Show", 2))
    return star(spark, weekly=weekly)


def test_alignment_spans_53_weeks_and_the_english_leader(spark):
    model = alignment_model(spark)
    assert tuples(kpis.global_alignment(model.weekly, model.regions)) == [("Peru", "Show", 50.9, 53)]
    assert tuples(kpis.global_alignment(model.weekly, model.regions, days=7), "weeks_compared") == [(2,)]
    assert kpis.global_alignment(model.weekly, model.regions, content_type="Movie").isEmpty()
    assert tuples(
        kpis.market_profile(model.weekly, model.regions),
        "region_name", "content_type", "pct_weeks_matching_global_no1",
    ) == [("Peru", "Show", 50.9)]


def movement_model(spark):
    """In week 3 one title each climbs, falls, stays, debuts and comes back."""
    return star(
        spark,
        weekly=[
            (1, "Peru", "Back", "Show", 3),
            (2, "Peru", "Up", "Show", 5), (2, "Peru", "Down", "Show", 1), (2, "Peru", "Same", "Show", 4),
            (3, "Peru", "Up", "Show", 1), (3, "Peru", "Down", "Show", 2), (3, "Peru", "Back", "Show", 3),
            (3, "Peru", "Same", "Show", 4), (3, "Peru", "New", "Show", 5),
            (2, "Global", "Up", "Show", 9, "English", 1.0), (3, "Global", "Up", "Show", 1, "English", 2.0),
        ],
    )


def test_movement_states(spark):
    model = movement_model(spark)
    args = (model.weekly, model.regions, model.titles)
    assert tuples(claims.movement_states(*args), "state", "chart_rows") == [
        ("climbed", 1), ("comeback", 1), ("debut", 1), ("fell", 1), ("unchanged", 1),
    ]
    assert tuples(claims.climbers(*args), "title_name", "region_name", "improvement") == [("Up", "Peru", 4)]
    assert tuples(claims.climb_summary(*args)) == [("Up", "Show", 1, 4, 4)]
    assert tuples(claims.reentries(*args), "title_name", "markets_entered") == [("Back", 1), ("New", 1)]
    earlier = F.lit(week(2))
    assert tuples(claims.reentries(*args, as_of=earlier, title_name="Up"), "markets_entered") == [(1,)]
    assert claims.climbers(*args, title_name="Down").isEmpty()


def test_movers_count_consecutive_weeks_only(spark):
    model = movement_model(spark)
    args = (model.weekly, model.regions, model.titles)
    up = tuples(kpis.movers(*args), "region_name", "title_name", "rank_improvement")
    assert up == [("Global", "Up", 8), ("Peru", "Up", 4), ("Peru", "Same", 0), ("Peru", "Down", -1)]
    assert tuples(kpis.movers_by_lag(*args), "region_name", "title_name", "rank_improvement") == up
    down = tuples(kpis.movers(*args, down=True, include_global=False), "title_name")
    assert down == [("Down",), ("Same",), ("Up",)]


def test_filtering_before_the_lag_finds_no_movers(spark):
    """The order of lag and filter carries the result."""
    weekly = movement_model(spark).weekly
    newest = movement.latest(weekly)
    assert movement.with_prior(movement.in_week(weekly, newest)).filter("prior_rank IS NOT NULL").isEmpty()
    assert movement.in_week(movement.with_prior(weekly), newest).filter("prior_rank IS NOT NULL").count() == 5


def test_states_cover_the_chart_and_both_mover_forms_agree(smoke):
    model = smoke.star
    args = (model.weekly, model.regions, model.titles)
    rows = movement.in_week(kpis.countries(model.weekly, model.regions), movement.latest(model.weekly))
    states = claims.movement_states(*args).agg(F.sum("chart_rows")).first()[0]
    assert states == rows.count()
    one, two = kpis.movers(*args, limit=None), kpis.movers_by_lag(*args, limit=None)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_premiere_lifts_earlier_seasons(spark):
    weekly = [(0, r, "S1", "Show", 1, None, None, 1, "S") for r in ("Peru", "Chad")]
    weekly += [(4, "Peru", "S1", "Show", 2, None, None, 2, "S")]
    weekly += [(5, r, "S2", "Show", 1, None, None, 1, "S") for r in ("Peru", "Mali")]
    weekly += [(5, r, "S1", "Show", 3, None, None, 3, "S") for r in ("Peru", "Chad")]
    weekly += [(6, r, "S1", "Show", 3, None, None, 3, "S") for r in ("Peru", "Chad", "Mali")]
    weekly += [(6, "Peru", "S2", "Show", 1, None, None, 2, "S"), (0, "Peru", "Other", "Show", 9)]
    model = star(spark, weekly=weekly)
    shows = model.titles.select(
        "title_id", F.when(F.col("title_name").startswith("S"), "S").otherwise("O").alias("show_title")
    )
    lift = claims.premiere_lift(model.weekly, model.regions, model.titles, shows)
    assert tuples(lift) == [("S", "S2", week(5), 1, 2, 3)]
    reach = claims.market_reach(model.weekly, model.regions, model.titles)
    assert ("S1", "Show", week(6), 3) in tuples(reach)


def test_slicers(spark):
    model = star(
        spark,
        half=[
            ("A", "Show", "2024H1", None, 2e9), ("B", "Movie", "2024H1", None, 4e9),
            ("A", "Show", "2024H2", None, 1e9),
        ],
        weekly=[(0, "Peru", "A", "Show", 1), (0, "Chad", "B", "Movie", 1), (40, "Mali", "A", "Show", 1)],
    )
    args = (model.half, model.weekly, model.regions)
    assert tuples(kpis.sliced_topline(*args)) == [(7.0, 2, 2333.33, 3)]
    assert tuples(kpis.sliced_topline(*args, content_type="Show", last_period="2024H1")) == [(2.0, 1, 2000.0, 1)]
    assert tuples(kpis.sliced_topline(*args, region_names=["Mali"], first_period="2024H2")) == [(1.0, 1, 1000.0, 1)]
    assert tuples(claims.type_average(model.half, "2024H1")) == [("Movie", 4000.0, 1), ("Show", 2000.0, 1)]
    assert tuples(claims.type_ratio(model.half, "2024H1")) == [(0.5,)]
    assert tuples(claims.type_ratio(model.half, "2024H2")) == [(None,)]
    assert tuples(claims.chart_span(model.weekly)) == [(week(0), week(40))]
    assert tuples(claims.country_count(model.regions)) == [(3,)]


def test_type_growth(spark):
    model = star(
        spark,
        half=[
            ("A", "Show", "2024H1", None, 2e9), ("B", "Movie", "2024H1", None, 4e9),
            ("A", "Show", "2024H2", None, 3e9), ("C", "Show", "2024H2", None, 1e9),
            ("B", "Movie", "2024H2", None, 2e9),
        ],
    )
    assert tuples(kpis.type_growth(model.half)) == [
        ("Movie", "2024H1", 4.0, 1, None, None, 50.0), ("Movie", "2024H2", 2.0, 1, -50.0, 0.0, 33.3),
        ("Show", "2024H1", 2.0, 1, None, None, 50.0), ("Show", "2024H2", 4.0, 2, 100.0, 100.0, 66.7),
    ]


@pytest.mark.parametrize("period, release", [("2024H1", date(2024, 1, 1))])
def test_topline_counts_titles_and_averages_rows(spark, period, release):
    model = star(
        spark,
        half=[("War", "Movie", period, release, 6e6), ("War", "Movie", period, date(2010, 1, 1), 2e6)],
    )
    assert tuples(kpis.topline(model.half)) == [(period, 1, 0.01, 4.0)]

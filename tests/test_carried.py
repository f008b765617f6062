import random

import pytest
from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators import carried, movement
from marquee.plans import kpis, rollup
from tests.fixtures import star, tuples, week

PRIOR = ["region_id", "title_id", "weekly_rank", "prior_rank", "prior_date"]


def history(spark, weeks=9, seed=3):
    pick = random.Random(seed)
    rows = []
    for n in range(weeks):
        for region in (1, 2, 3):
            for rank, title in enumerate(pick.sample(range(1, 13), 6), 1):
                if n != 4:  # no chart in one week
                    rows.append((week(n), title, region, "Show", None, rank, None, None, 1))
    return spark.createDataFrame(rows, schemas.FACT_WEEKLY)


def test_week_by_week_equals_the_window(spark, tmp_path):
    weekly = history(spark).cache()
    whole = movement.with_prior(weekly)
    kept = carried.Movement(spark, str(tmp_path / "state"))
    for n in range(9):
        own = kept.load(weekly.filter(F.col("date_key") == week(n)), week(n))
        assert sorted(tuples(own, *PRIOR), key=repr) == sorted(tuples(whole.filter(F.col("date_key") == week(n)), *PRIOR), key=repr)
    assert kept.weeks() == [week(7), week(8)]
    assert sorted(tuples(kept.before(week(9)))) == sorted(tuples(carried.last_seen(weekly)))


def test_the_newest_week_may_be_loaded_again_and_no_older_one(spark, tmp_path):
    weekly = history(spark, 3).cache()
    kept = carried.Movement(spark, str(tmp_path / "state"))
    rows = [weekly.filter(F.col("date_key") == week(n)) for n in range(3)]
    first = [sorted(tuples(kept.load(rows[n], week(n)), *PRIOR), key=repr) for n in (0, 1, 2)]
    assert sorted(tuples(kept.load(rows[2], week(2)), *PRIOR), key=repr) == first[2]
    with pytest.raises(ValueError):
        kept.load(rows[1], week(1))
    # a version without its mark was not finished, and is not used
    (tmp_path / "state" / f"week={week(2)}" / "_SUCCESS").unlink()
    assert kept.weeks() == [week(1)]
    assert sorted(tuples(kept.load(rows[2], week(2)), *PRIOR), key=repr) == first[2]


def test_a_new_week_reads_the_state_and_itself_only(spark, tmp_path):
    history(spark).write.partitionBy("date_key").parquet(str(tmp_path / "weekly"))
    weekly = spark.read.schema(schemas.FACT_WEEKLY).parquet(str(tmp_path / "weekly"))
    carried.last_seen(weekly.filter(F.col("date_key") < week(8))).write.parquet(str(tmp_path / "seen"))
    state = spark.read.schema(carried.STATE).parquet(str(tmp_path / "seen"))
    own = carried.with_carried(weekly.filter(F.col("date_key") == week(8)), state)
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("FileScan parquet") == 2 and "PartitionFilters: [isnotnull(date_key" in plan
    assert sorted(tuples(own, *PRIOR), key=repr) == sorted(tuples(movement.with_prior(weekly).filter(F.col("date_key") == week(8)), *PRIOR), key=repr)


def test_merging_is_safe_to_repeat_and_to_reorder(spark):
    weekly = history(spark, 6).cache()
    parts = [weekly.filter(F.col("date_key") == week(n)) for n in (5, 0, 3, 3, 1, 2, 4)]
    state = spark.createDataFrame([], carried.STATE)
    for part in parts:
        state = carried.merged(state, part)
    assert sorted(tuples(state)) == sorted(tuples(carried.last_seen(weekly)))


def model(spark, seed, titles):
    pick = random.Random(seed)
    half = [(f"t{pick.choice(titles)}", pick.choice(["Show", "Movie"]), pick.choice(["2024H1", "2024H2", "2025H1"]), None, pick.choice([5e6, 1e6, None])) for _ in range(300)]
    weekly = [(pick.randrange(60), pick.choice(["Peru", "Chad", "Global"]), f"t{pick.choice(titles)}", "Show", 1, None, None, pick.randrange(1, 9)) for _ in range(300)]
    return star(spark, half, weekly)


def test_rollups_equal_the_facts(spark):
    m = model(spark, 1, range(50))
    halves, charts = rollup.half_rollup(m.half), rollup.chart_rollup(m.weekly)
    assert tuples(rollup.topline(halves)) == tuples(kpis.topline(m.half))
    assert tuples(rollup.stickiness(charts, m.regions, 5)) == tuples(kpis.stickiness(m.weekly, m.regions, limit=5))
    for slicers in ({}, {"first_period": "2024H2", "content_type": "Show"}, {"last_period": "2024H1", "region_names": ["Peru", "Global"]}, {"first_period": "2030H1"}):
        assert tuples(rollup.sliced_topline(halves, charts, m.regions, **slicers)) == tuples(kpis.sliced_topline(m.half, m.weekly, m.regions, **slicers))


def test_a_new_slice_is_merged_in(spark):
    """Loads roll up apart; their union counts titles of both once, over several bitmaps."""
    rows = [("2024H1", "Show", i % 900 * 100, 1.0 * i) for i in range(2000)] + [("2024H2", "Movie", i * 37, None) for i in range(2500)]
    half = spark.createDataFrame(rows, "period_label string, content_type string, title_id long, hours_viewed double")
    half = half.withColumn("title_id", F.when(F.col("title_id") > 0, F.col("title_id")))
    loads = [half.filter(f"pmod(hash(hours_viewed, title_id), 3) = {n}") for n in range(3)]
    apart = rollup.half_rollup(loads[0]).unionByName(rollup.half_rollup(loads[1])).unionByName(rollup.half_rollup(loads[2]))
    for keys in (["period_label"], ["content_type"], []):
        got = rollup.merged(apart, keys, ["hours", "rows"]).select(*keys, "hours", "rows", "distinct_titles")
        want = half.groupBy(*keys).agg(F.sum("hours_viewed"), F.count("hours_viewed"), F.count_distinct("title_id"))
        assert sorted(tuples(got), key=repr) == sorted(tuples(want), key=repr)
    assert rollup.half_rollup(half).select("ids").distinct().count() > 2

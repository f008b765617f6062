import os
import random
from datetime import date

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators import checks
from marquee.operators.spread import _bucket, dense_ids, rank_desc, ranks_desc
from marquee.plans import star as build
from marquee.plans.star import build_star, export_csv, write_weekly
from tests.fixtures import half_feed, star, tuples, week, weekly_feed


def test_ids_equal_row_number_over_the_sorted_key(spark, smoke):
    keys = smoke.viewing.select("p_name", "market", "week").distinct()
    order = ["p_name", "market", "week"]
    ours = dense_ids(keys, order, "id")
    theirs = keys.withColumn("id", F.row_number().over(W.orderBy(*order)).cast("long"))
    assert ours.count() == keys.count() > 1000
    assert ours.exceptAll(theirs.select(ours.columns)).isEmpty()


def test_ids_stay_the_same_when_read_again(spark):
    keys = spark.range(5000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    ids = dense_ids(keys, ["k"], "id")
    first, second = sorted(tuples(ids)), sorted(tuples(ids.unionByName(ids).distinct()))
    assert first == second
    assert [row[0] for row in first] == list(range(1, 5001))


def test_spread_rank_equals_the_window(spark):
    """One group and one value hold a third of all rows; some values are NULL."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 9 == 0, 7.0)
        .when(F.col("id") % 11 != 0, (F.col("id") * 31 % 977).cast("double"))
        .alias("v"),
    )
    window = W.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    plain = rows.withColumn("r", F.rank().over(window).cast("long"))
    spread = rank_desc(rows, ["g"], "v", "r").select("g", "v", "r")
    assert sorted(tuples(spread), key=repr) == sorted(tuples(plain), key=repr)


def test_two_ranks_from_one_tally(spark):
    """Zero, signs, sizes far apart, ties, NULL and endless values; no job before an action."""
    value = F.expr("CASE id % 7 WHEN 0 THEN 0.0 WHEN 1 THEN -id * 1e12 WHEN 2 THEN id / 1e9 WHEN 3 THEN NULL WHEN 4 THEN id % 3 WHEN 5 THEN -id / 7 ELSE id END")
    odd = F.when(F.col("id") == 13, F.lit("Infinity").cast("double")).when(F.col("id") == 14, F.lit("-Infinity").cast("double"))
    rows = spark.range(4000).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 2).alias("g"), odd.otherwise(value).alias("v"), (F.col("id") * 37 % 101).alias("n")
    )
    spark.sparkContext.setJobGroup("ranks", "plan only")
    spread = ranks_desc(rows, ["g"], {"v": "rv", "n": "rn"})
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("ranks") == []
    plain = rows
    for column, name in (("v", "rv"), ("n", "rn")):
        plain = plain.withColumn(name, F.rank().over(W.partitionBy("g").orderBy(F.desc_nulls_last(column))).cast("long"))
    assert sorted(tuples(spread, "g", "v", "n", "rv", "rn"), key=repr) == sorted(tuples(plain), key=repr)


def test_buckets_follow_the_values(spark):
    pick = random.Random(1)
    values = sorted([pick.uniform(-1, 1) * 10 ** pick.randint(-300, 300) for _ in range(2000)] + [0.0, 1.0, 2.0, 4.0, 1 - 2**-53, 2 - 2**-52, 5e-324, 1.7e308] + [2.0**k for k in range(-60, 60)])
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    buckets = [b for _, b in sorted(tuples(rows.select("v", _bucket(F.col("v")))))]
    assert buckets == sorted(buckets) and len(set(buckets)) > 1900


def test_ids_stay_when_titles_are_added(spark, tmp_path):
    def build_with(names):
        half = half_feed(spark, [(name, "Movie", "2024H1", None, 1.0) for name in names])
        weekly = weekly_feed(spark, [(0, name, names[0], "Movie", 1) for name in names])
        model = build_star(half, weekly, str(tmp_path / "star"), str(tmp_path / "keys"))
        assert model.half.filter("title_id IS NULL").isEmpty() and model.weekly.filter("region_id IS NULL").isEmpty()
        return [dict(tuples(t, n, i)) for t, n, i in ((model.titles, "title_name", "title_id"), (model.regions, "region_name", "region_id"))]

    titles, regions = build_with(["M", "P", "B"])
    assert titles == {"B": 1, "M": 2, "P": 3} and regions == {"B": 1, "Global": 2, "M": 3, "P": 4}
    titles, regions = build_with(["A", "P", "N", "B"])  # two are new, one is gone
    assert titles == {"B": 1, "P": 3, "A": 4, "N": 5} and regions == {"B": 1, "Global": 2, "P": 4, "A": 5, "N": 6}
    assert build_with(["M", "A", "Z"])[0] == {"M": 2, "A": 4, "Z": 6}  # one comes back
    assert build_with(["M", "A", "Z"])[0] == {"M": 2, "A": 4, "Z": 6}


def test_each_fact_is_read_once_for_orphans(smoke):
    plan = checks.orphans(smoke.star)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 2 + 3 + 2  # the facts, and the dimensions of each


def test_one_name_of_two_types_is_two_titles(spark):
    model = star(
        spark,
        half=[("Twin", "Show", "2024H1", None, 5.0), ("Twin", "Movie", "2024H1", None, 3.0)],
        weekly=[(0, "Peru", "Twin", "Movie", 1), (0, "Global", "Solo", "Show", 1)],
    )
    assert sorted(tuples(model.titles)) == [
        (1, "Twin", "Movie"), (2, "Solo", "Show"), (3, "Twin", "Show"),
    ]
    assert tuples(model.weekly.filter("title_id = 1"), "content_type") == [("Movie",)]


def test_regions_hold_the_worldwide_row_without_a_code(spark):
    model = star(spark, weekly=[(0, "Peru", "A", "Show", 1), (0, "Chad", "A", "Show", 1)])
    assert sorted(tuples(model.regions)) == [
        (1, "Chad", "CH", False), (2, "Global", None, True), (3, "Peru", "PE", False),
    ]


def test_dates_are_weeks_and_half_starts(spark):
    model = star(
        spark,
        half=[("A", "Show", "2024H2", None, 1.0)],
        weekly=[(0, "Peru", "A", "Show", 1), (0, "Global", "A", "Show", 1)],
    )
    assert sorted(tuples(model.dates)) == [
        (date(2024, 1, 7), date(2024, 1, 7), 2024, 1, "2024H1", 1, "January", 1),
        (date(2024, 7, 1), date(2024, 7, 1), 2024, 3, "2024H2", 7, "July", 27),
    ]


def test_titles_without_a_name_are_dropped_and_reported(spark):
    half = half_feed(spark, [("A", "Show", "2024H1", None, 1.0)])
    weekly = weekly_feed(spark, [(0, "Peru", "A", "Show", 1)]).unionByName(
        weekly_feed(spark, [(0, "Peru", "B", "Show", 2)]).withColumn(
            "title_name", F.lit(None).cast("string")
        )
    )
    titles, regions = build.dim_title(half, weekly), build.dim_region(weekly)
    assert titles.count() == 1
    fact = build.fact_weekly(weekly, titles, regions)
    assert fact.filter("title_id IS NULL").count() == 1


def test_quality_reports(spark):
    model = star(
        spark,
        half=[
            ("War", "Movie", "2024H1", date(2024, 2, 1), 9.0),
            ("War", "Movie", "2024H1", date(2010, 2, 1), 4.0),
            ("Calm", "Movie", "2024H1", date(2024, 3, 1), 4.0),
        ],
        weekly=[(0, "Peru", "War", "Movie", 1), (0, "Peru", "New", "Show", 1)],
    )
    assert tuples(checks.title_collisions(model.half), "works", "release_dates") == [(2, 2)]
    assert sorted(tuples(checks.chart_slots(model.weekly, model.regions), "content_type", "slots_filled")) == [
        ("Movie", 1), ("Show", 1),
    ]
    assert checks.chart_slots(model.weekly, model.regions, slots=1).isEmpty()
    half_empty = checks.chart_slots(model.weekly.filter("content_type = 'Show'"), model.regions)
    assert sorted(tuples(half_empty, "content_type", "slots_filled")) == [("Movie", 0), ("Show", 1)]
    assert sorted(tuples(checks.feed_overlap(model))) == [("Movie", 1, 1, 0), ("Show", 0, 0, 1)]
    assert {row.orphan_rows for row in checks.orphans(model).collect()} == {0}
    broken = model.weekly.withColumn("title_id", F.when(F.col("weekly_rank") > 1, F.col("title_id")))
    lost = checks.orphans(type(model)(model.dates, model.titles, model.regions, broken, model.half))
    found = {(r.table_name, r.key_name): r.orphan_rows for r in lost.collect()}
    assert found[("fact_top10_weekly", "title_id")] == 2
    counts = dict(tuples(checks.table_counts(model)))
    assert counts["both facts"] == counts["fact_top10_weekly"] + counts["fact_engagement_half"] == 5


def test_generic_show_key_merges_seasons(spark):
    feed = weekly_feed(
        spark,
        [
            (0, "Peru", "S: Season 1", "Show", 1, None, None, 1, "S"),
            (0, "Peru", "S: Season 2", "Show", 2, None, None, 1, "S"),
            (0, "Peru", "T", "Show", 3),
        ],
    )
    assert sorted(tuples(checks.key_compare(feed))) == [("season_title", 0, 0), ("show_title", 1, 1)]


def test_build_writes_replaces_and_exports(spark, tmp_path):
    half = half_feed(spark, [("A", "Show", "2024H1", date(2024, 1, 2), 5.0)])
    weekly = weekly_feed(spark, [(n, "Peru", "A", "Show", 1) for n in (0, 60)])
    for _ in range(2):
        model = build_star(half, weekly, str(tmp_path / "star"))
        assert (model.weekly.count(), model.half.count(), model.titles.count()) == (2, 1, 1)
    years = {p.name for p in (tmp_path / "star" / "fact_top10_weekly").glob("year=*")}
    assert years == {"year=2024", "year=2025"}
    pruned = model.weekly.filter((F.col("year") == 2025) & (F.col("date_key") == week(60)))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(date_key)" in plan
    export_csv(model, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv" / "fact_top10_weekly"))
    assert back.columns[0] == "date_key" and back.count() == 2 and "year" not in back.columns


def test_a_new_version_is_built_again(spark, smoke_dir, tmp_path):
    from marquee.plans.warehouse import forget, warehouse
    from marquee.sources import shop

    for name in shop.TABLES:
        shop.table(spark, smoke_dir, name).write.parquet(shop.table_path(str(tmp_path), name))
    first = warehouse(spark, str(tmp_path))
    hours = first.star.half.agg(F.sum("hours_viewed")).first()[0]
    assert warehouse(spark, f"{tmp_path}/") is first
    shop.table(spark, smoke_dir, "lineitem").write.mode("append").parquet(
        shop.table_path(str(tmp_path), "lineitem")
    )
    second = warehouse(spark, str(tmp_path), "after the append")
    assert second.star.half.agg(F.sum("hours_viewed")).first()[0] == 2 * hours
    assert first.star.half.agg(F.sum("hours_viewed")).first()[0] == hours
    assert forget(spark, str(tmp_path)) is first and forget(spark, str(tmp_path)) is None
    first.close()
    assert not os.path.exists(first.folder.removeprefix("file:"))
    assert second.star.half.count() > 0


def test_one_year_is_written_by_many_tasks(spark, tmp_path):
    days = [(date(2024, 1, 7 + 7 * (w % 3)), w, w % 50, "Show", None, 1, None, None, 1) for w in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as for a year too large for one task
    try:
        write_weekly(spark.createDataFrame(days, schemas.FACT_WEEKLY), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "fact_top10_weekly" / "year=2024").glob("*.parquet"))
    assert len(files) > 4
    assert spark.read.parquet(str(tmp_path / "fact_top10_weekly")).count() == 3000

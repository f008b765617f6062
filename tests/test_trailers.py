import json
from datetime import date, datetime

from pyspark.sql import functions as F

from marquee import schemas
from marquee.plans import trailers
from marquee.session import together
from marquee.sources import videos
from marquee.streaming.snapshots import ingest_landed
from tests.fixtures import star, tuples

NOW = datetime(2024, 3, 1, 12)


def log(spark, rows):
    return spark.createDataFrame(rows, schemas.FACT_TRAILER)


def item(video, views=None, likes=None, published="2024-01-05T08:00:00Z"):
    statistics = {}
    if views is not None:
        statistics["viewCount"] = str(views)
    if likes is not None:
        statistics["likeCount"] = str(likes)
    return {"id": video, "statistics": statistics, "snippet": {"publishedAt": published}}


def trailer_map(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text(
        "title_id,title_name,content_type,video_id,channel,note\n"
        '99,Alpha,Show,v1,Main,"official, main channel"\n'
        "98,Beta,Movie,v2,Main,plain\n"
        '97,Gamma,Movie,v3,Main,"says ""teaser"""\n'
    )
    return videos.read_trailer_map(spark, str(path))


def model(spark):
    return star(
        spark,
        half=[
            ("Alpha", "Show", "2024H1", date(2024, 2, 1), 5e6),
            ("Beta", "Movie", "2024H1", date(2024, 2, 1), 9e6),
            ("Beta", "Movie", "2024H1", date(2009, 2, 1), 1e6),
            ("Gamma", "Movie", "2024H1", date(2024, 3, 1), 9e6),
            ("Gamma", "Movie", "2024H1", date(2024, 4, 1), 2e6),
            ("Beta", "Movie", "2023H2", date(2024, 2, 1), 7e6),
        ],
        weekly=[(0, "Global", "Beta", "Movie", 4, "English", 1.0), (1, "Global", "Beta", "Movie", 2, "English", 1.0)],
    )


def test_map_notes_keep_their_commas(spark, tmp_path):
    notes = tuples(trailer_map(spark, tmp_path).orderBy("video_id"), "note")
    assert notes == [("official, main channel",), ("plain",), ('says "teaser"',)]


def test_snapshot_from_landed_json(spark, tmp_path):
    landed = tmp_path / "fetch.json"
    landed.write_text(json.dumps({"items": [item("v1", 12, 3), item("v2"), item("v9", 5)]}, indent=1))
    items = videos.read_video_items(spark, str(landed), NOW)
    mapped, titles = trailer_map(spark, tmp_path), model(spark).titles
    rows = trailers.snapshot(items.unionByName(items), mapped, titles)
    # Beta is title 1 and Alpha title 3 here, whatever ids the map carries.
    assert sorted(tuples(rows)) == [
        (1, "v2", 0, None, date(2024, 1, 5), NOW), (3, "v1", 12, 3, date(2024, 1, 5), NOW),
    ]
    assert tuples(trailers.missing_trailers(mapped, rows), "title_name") == [("Gamma",)]


def test_retention_keeps_exactly_thirty_days(spark, tmp_path):
    ages = {"kept": datetime(2024, 1, 31, 14, 24), "edge": datetime(2024, 1, 31, 12), "gone": datetime(2024, 1, 31, 9, 36)}
    rows = log(spark, [(1, name, 1, None, date(2024, 1, 1), at) for name, at in ages.items()])
    now = F.lit(NOW.isoformat(sep=" "))
    assert sorted(tuples(trailers.retained(rows, now), "video_id")) == [("edge",), ("kept",)]
    first, second = str(tmp_path / "v1"), str(tmp_path / "v2")
    trailers.append_snapshot(rows, first)
    trailers.append_snapshot(log(spark, [(1, "new", 1, None, date(2024, 1, 1), NOW)]), first)
    written = trailers.read_log(spark, first)
    assert written.count() == 4
    kept = trailers.write_retained(written, now, second)
    assert sorted(tuples(kept, "video_id")) == [("edge",), ("kept",), ("new",)]
    plan = trailers.retained(written, now)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fetch_day" in plan


def test_latest_is_one_fetch_for_all(spark):
    rows = log(
        spark,
        [
            (1, "a", 5, None, date(2024, 1, 1), datetime(2024, 2, 1)),
            (2, "b", 6, None, date(2024, 1, 1), datetime(2024, 2, 1)),
            (1, "a", 7, None, date(2024, 1, 1), datetime(2024, 2, 2)),
        ],
    )
    assert tuples(trailers.latest_snapshot(rows), "video_id", "view_count") == [("a", 7)]


def test_trailers_beside_hours(spark):
    star_model = model(spark)
    ids = {r.title_name: r.title_id for r in star_model.titles.collect()}
    rows = log(
        spark,
        [
            (ids["Alpha"], "v1", 10, None, date(2024, 2, 28), NOW),
            (ids["Beta"], "v2", 10, 1, date(2024, 2, 1), NOW),
            (ids["Gamma"], "v3", 10, 1, date(2024, 3, 2), NOW),
            (ids["Gamma"], "v3", 99, 1, date(2024, 3, 2), datetime(2024, 2, 1)),
        ],
    )

    def ask():
        return tuples(
            trailers.trailer_vs_engagement(
                rows, star_model.half, star_model.weekly, star_model.titles, star_model.regions,
                period="2024H1", released_from=F.lit("2024-01-01").cast("date"),
            )
        )

    expected = [
        ("Beta", "Movie", 10, 29, 9.0, 2, 2, 1, 1),
        ("Gamma", "Movie", 10, 0, 9.0, None, None, 1, 1),
        ("Gamma", "Movie", 10, 0, 2.0, None, None, 1, 3),
        ("Alpha", "Show", 10, 2, 5.0, None, None, 1, 1),
    ]
    assert ask() == expected


def test_landed_files_are_taken_once(spark, tmp_path):
    landed, out, taken = tmp_path / "landed", str(tmp_path / "log"), str(tmp_path / "taken")
    landed.mkdir()
    mapped, titles = trailer_map(spark, tmp_path), model(spark).titles

    def land(day, *items):
        line = {"items": list(items), "fetched_at": f"2024-02-{day:02d} 06:00:00"}
        (landed / f"{day}.json").write_text(json.dumps(line))

    def run(checkpoint=taken):
        ingest_landed(spark, str(landed), out, mapped, titles, checkpoint).awaitTermination()
        rows = trailers.read_log(spark, out).orderBy("fetched_at", "video_id")
        return tuples(rows, "video_id", "view_count", F.dayofmonth("fetched_at"))

    land(1, item("v1", 5))
    assert run() == [("v1", 5, 1)]
    land(2, item("v1", 8), item("v2", 1))
    both = [("v1", 5, 1), ("v1", 8, 2), ("v2", 1, 2)]
    assert run() == run() == both
    # a stream that has forgotten, or a second one, finds its rows in the log
    assert run(str(tmp_path / "other")) == both
    # the batch job feeds the same log
    fetch = trailers.read_log(spark, out).filter("day(fetched_at) = 2").drop("fetch_day")
    later = fetch.withColumn("fetched_at", F.expr("fetched_at + INTERVAL 1 DAY"))
    trailers.append_snapshot(later, out)
    trailers.append_snapshot(later, out)
    assert run() == [*both, ("v1", 8, 3), ("v2", 1, 3)]


def test_a_video_returned_twice_counts_once(spark, tmp_path):
    items = [item("v1", 5), item("v1", 9), item("v1", 7)]
    (tmp_path / "response.json").write_text(json.dumps({"items": items}))
    fetched = videos.read_video_items(spark, str(tmp_path / "response.json"), NOW)
    rows = trailers.snapshot(fetched, trailer_map(spark, tmp_path), model(spark).titles)
    assert tuples(rows, "video_id", "view_count") == [("v1", 9)]


def test_expired_fetches_go_and_no_other_file_is_touched(spark, tmp_path):
    out = tmp_path / "log"
    ages = {"gone": datetime(2024, 1, 31, 9, 36), "edge": datetime(2024, 1, 31, 12), "kept": datetime(2024, 1, 31, 14, 24), "old": datetime(2023, 12, 1), "new": NOW}
    for video, at in ages.items():
        trailers.append_snapshot(log(spark, [(1, video, 1, None, date(2024, 1, 1), at)]), str(out))

    def parts():
        return {path: (path.stat().st_mtime_ns, path.stat().st_ino) for path in out.rglob("*.parquet")}

    before = parts()
    assert len(before) == 5
    now = F.lit(NOW.isoformat(sep=" "))
    assert trailers.drop_expired(spark, str(out), now) == 2
    assert trailers.drop_expired(spark, str(out), now) == 0
    left = parts()
    assert len(left) == 3 and left.items() <= before.items()
    assert sorted(tuples(trailers.read_log(spark, str(out)), "video_id")) == [("edge",), ("kept",), ("new",)]


def test_two_writers_of_one_fetch_leave_it_once(spark, tmp_path):
    out = str(tmp_path / "log")
    first = log(spark, [(1, f"v{i}", i, None, date(2024, 1, 1), datetime(2024, 2, 1)) for i in range(50)])
    later = log(spark, [(1, f"v{i}", i, None, date(2024, 1, 1), datetime(2024, 2, 2)) for i in range(50)])
    trailers.append_snapshot(first, out)
    for _ in range(3):
        together(lambda: trailers.append_snapshot(later, out), lambda: trailers.append_snapshot(later.repartition(3), out))
        rows = tuples(trailers.read_log(spark, out), "video_id", "fetched_at")
        assert len(rows) == len(set(rows)) == 100


def test_parts_of_a_fetch_come_together(spark, tmp_path):
    """A second file of a fetch adds its videos; of a video in both the most views count."""
    out, at = str(tmp_path / "log"), datetime(2024, 2, 1)
    trailers.append_snapshot(log(spark, [(1, "a", 5, None, None, at), (1, "b", 7, 2, None, at)]), out)
    trailers.append_snapshot(log(spark, [(1, "b", 9, 1, None, at), (1, "c", 1, None, None, at)]), out)
    assert sorted(tuples(trailers.read_log(spark, out), "video_id", "view_count", "like_count")) == [("a", 5, None), ("b", 9, 1), ("c", 1, None)]


def test_lines_that_do_not_parse_are_kept_apart(spark, tmp_path):
    landed, out, lost = tmp_path / "landed", str(tmp_path / "log"), str(tmp_path / "lost")
    landed.mkdir()
    line = json.dumps({"items": [item("v1", 5)], "fetched_at": "2024-02-01 06:00:00"})
    (landed / "a.json").write_text(f"{line}\n{line[:40]}\n")
    ingest_landed(spark, str(landed), out, trailer_map(spark, tmp_path), model(spark).titles, str(tmp_path / "taken"), lost).awaitTermination()
    assert tuples(trailers.read_log(spark, out), "video_id", "view_count") == [("v1", 5)]
    (row,) = spark.read.json(lost).collect()
    assert row.record == line[:40] and row.file.endswith("landed/a.json")

import csv
import io
import random
from datetime import date, datetime

import pytest

from marquee import schemas
from marquee.operators import checks
from marquee.plans.star import build_from_files
from marquee.sources import charts, records, reports, videos
from marquee.sources.reports import HalfReport
from tests.fixtures import tuples

PREAMBLE = "What was watched\nJanuary to June\n\nHours are rounded\nNotes apply\n"


def write_reports(folder):
    shows = folder / "shows.csv"
    shows.write_text(
        PREAMBLE
        + ",Title,Available Globally?,Release Date,Hours Viewed,Runtime,Views\n"
        + ',"Fox, The: Season 1 // Fox",Yes,2024-01-04,1000000,8:30,117647\n'
        + ", Owl ,No,,500000,2:00,250000\n"
        + ",,,,7,1:00,3\n"
    )
    movies = folder / "movies.csv"
    movies.write_text(
        PREAMBLE
        + "Unnamed: 0,Title,Available Globally?,Release Date,Hours Viewed,Runtime,Views\n"
        + "x,Owl,Yes,2024-02-02,900000,1:30,600000\n"
        + "x,Bare,,,,,\n"
    )
    return [
        HalfReport(str(path), kind, "2024H1", "2024-01-01", "2024-06-30")
        for path, kind in ((shows, "Show"), (movies, "Movie"))
    ]


def test_exports_are_read_by_place_and_outside_quotes(spark, tmp_path):
    """Data rows that read like the preamble or the header, line breaks in quotes, grouped numbers."""
    header = ",Title,Available Globally?,Release Date,Hours Viewed,Runtime,Views"
    rows = [
        "What was watched,,,,,,",
        ",Other,Yes,,500000,1:00,5",
        header,
        ',"Two\nlines, ""quoted""",Yes,2024-01-04,"1,234,000",8:30,"12,000"',
        ",Last,No,soon,12 h,1:2:3,",
    ]
    for end in ("\n", "\r\n"):
        path = tmp_path / f"export{len(end)}.csv"
        path.write_bytes((PREAMBLE.replace("Notes apply", ",Other,Yes,,500000,1:00,5") + "\n".join([header, *rows]) + "\n").replace("\n", end).encode())
        raw = reports.read_report_csv(spark, str(path))
        got = tuples(raw, "Title", "`Hours Viewed`")
        want = [(None, None), ("Other", "500000"), ("Title", "Hours Viewed"), ('Two\nlines, "quoted"', "1,234,000"), ("Last", "12 h")]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        feed = reports.conform_half(reports.tag_report(raw, HalfReport(str(path), "Show", "2024H1", "2024-01-01", "2024-06-30")))
        hours = dict(tuples(feed, "title_name", "hours_viewed"))
        assert hours == {"Other": 5e5, "Title": None, 'Two\nlines, "quoted"': 1234000.0, "Last": None}
        lost = checks.unparsed(half=raw.filter("Title = 'Last'"))
        assert sorted(tuples(lost)) == [
            ("half-year", "hours", 1), ("half-year", "release date", 1), ("half-year", "runtime", 1), ("half-year", "views", 0),
        ]


def write_charts(folder):
    worldwide = folder / "global.tsv"
    worldwide.write_text(
        "week\tcategory\tweekly_rank\tshow_title\tseason_title\tweekly_hours_viewed\truntime\t"
        "weekly_views\tcumulative_weeks_in_top_10\n"
        "2024-01-07\tTV (English)\t1\tFox\tFox: Season 2\t9000000\t2.5\t3600000\t1\n"
        '2024-01-07\tFilms (Non-English)\t1\t"Say ""Hi"""\tN/A\t8000000\t\t\t1\n'
    )
    countries = folder / "countries.tsv"
    countries.write_text(
        "country_name\tcountry_iso2\tweek\tcategory\tweekly_rank\tshow_title\tseason_title\t"
        "cumulative_weeks_in_top_10\n"
        "Namibia\tNA\t2024-01-07\tTV\t1\tFox\tFox: Season 2\t1\n"
        "Namibia\tNA\t2024-01-07\tFilms\t1\tOwl\tN/A\t3\n"
    )
    return str(worldwide), str(countries)


def test_half_reports(spark, tmp_path):
    feed = reports.read_half_reports(spark, write_reports(tmp_path))
    rows = tuples(
        feed.orderBy("title_name", "content_type"),
        "title_name", "content_type", "is_available_globally", "release_date", "hours_viewed", "runtime_minutes",
    )
    assert rows == [
        ("Bare", "Movie", None, None, None, None),
        ("Fox, The: Season 1 // Fox", "Show", "Yes", date(2024, 1, 4), 1e6, 510),
        ("Owl", "Movie", "Yes", date(2024, 2, 2), 9e5, 90),
        ("Owl", "Show", "No", None, 5e5, 120),
    ]
    assert feed.select("period_start", "period_end").distinct().collect() == [
        (date(2024, 1, 1), date(2024, 6, 30))
    ]


def test_parquet_export_gives_the_same_feed(spark, tmp_path):
    first, second = write_reports(tmp_path)
    as_parquet = str(tmp_path / "shows.parquet")
    reports.read_report_csv(spark, first.path).write.parquet(as_parquet)
    moved = HalfReport(as_parquet, "Show", "2024H1", "2024-01-01", "2024-06-30")
    one = reports.read_half_reports(spark, [first, second])
    two = reports.read_half_reports(spark, [moved, second])
    assert sorted(tuples(one), key=repr) == sorted(tuples(two), key=repr)


def test_charts(spark, tmp_path):
    worldwide, countries = write_charts(tmp_path)
    feed = charts.weekly_feed(
        charts.read_global_chart(spark, worldwide), charts.read_country_chart(spark, countries)
    )
    rows = tuples(
        feed, "region_name", "iso2", "title_name", "content_type", "language", "hours_viewed", "views"
    )
    assert sorted(rows, key=repr) == sorted(
        [
            ("Global", None, "Fox: Season 2", "Show", "English", 9e6, 3.6e6),
            ("Global", None, 'Say "Hi"', "Movie", "Non-English", 8e6, None),
            ("Namibia", "NA", "Fox: Season 2", "Show", None, None, None),
            ("Namibia", "NA", "Owl", "Movie", None, None, None),
        ],
        key=repr,
    )


def test_files_to_tables(spark, tmp_path):
    worldwide, countries = write_charts(tmp_path)
    star = build_from_files(
        reports.read_half_reports(spark, write_reports(tmp_path)),
        charts.read_global_chart(spark, worldwide),
        charts.read_country_chart(spark, countries),
        str(tmp_path / "star"),
    )
    assert tuples(star.regions.orderBy("region_id")) == [(1, "Global", None, True), (2, "Namibia", "NA", False)]
    assert (star.titles.count(), star.half.count(), star.weekly.count()) == (6, 4, 4)
    assert star.weekly.filter("title_id IS NULL OR region_id IS NULL").isEmpty()
    shared = star.half.join(star.weekly, ["title_id", "content_type"]).select("title_id").distinct()
    assert shared.count() == 1


@pytest.mark.parametrize("size", [1, 7, 40, 333, 10_000])
def test_an_export_is_cut_into_byte_ranges(spark, tmp_path, set_conf, size):
    """Quotes open over many ranges, quotes in the preamble, line breaks and commas in titles."""
    pick = random.Random(size)
    titles = ["".join(pick.choices('ab,"\n ', k=pick.randint(1, 30))) + str(i) for i in range(60)]
    titles.append("\n" * 120 + "end")
    out = io.StringIO()
    out.write('An "odd\nquote, and " more\n"\n\nlast line above\n')
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["", "Title", "Hours Viewed"])
    writer.writerows([["", title, str(i)] for i, title in enumerate(titles)])
    path = tmp_path / "export.csv"
    path.write_text(out.getvalue())
    for key in ("maxPartitionBytes", "openCostInBytes"):
        set_conf(f"spark.sql.files.{key}", str(size))
    if size < 50:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 8
    raw = reports.read_report_csv(spark, str(path))
    assert sorted(tuples(raw, "Title", "`Hours Viewed`")) == sorted((title, str(i)) for i, title in enumerate(titles))
    assert reports.rejected_records(spark, str(path)).isEmpty()


def test_records_that_do_not_fit_are_rejected(spark, tmp_path):
    one, two = tmp_path / "one.csv", tmp_path / "two.csv"
    one.write_text(PREAMBLE + "Title,Views,Hours Viewed\nShort,1\nFits,2,3\n\nLong,1,2,3\n\"Two\nlines\",\n")
    two.write_text(PREAMBLE + 'Hours Viewed,Title\n5,Other order\n6,"never closed\n7,Lost\n8,Lost too\n')
    exports = [HalfReport(str(one), "Show", "2024H1", "2024-01-01", "2024-06-30"), HalfReport(str(two), "Movie", "2024H2", "2024-07-01", "2024-12-31")]
    rows = reports.read_raw_reports(spark, exports)
    assert sorted(tuples(rows, "Title", "`Hours Viewed`", "Views", "content_type", "period_end")) == [
        ("Fits", "3", "2", "Show", date(2024, 6, 30)), ("Other order", "5", None, "Movie", date(2024, 12, 31)),
    ]
    lost = reports.rejected_records(spark, [str(one), str(two)])
    assert sorted((name.rsplit("/", 1)[1], place, record) for name, place, record in tuples(lost)) == [
        ("one.csv", 7, "Short,1"), ("one.csv", 10, "Long,1,2,3"), ("one.csv", 11, '"Two\nlines",'),
        ("two.csv", 8, '6,"never closed'), ("two.csv", 9, "7,Lost"), ("two.csv", 10, "8,Lost too"),
    ]


def test_one_scan_reads_all_exports(spark, tmp_path):
    """A folder with a space, one with another inside it, and a file beside them."""
    where = [tmp_path / "a b", tmp_path / "a b" / "inner", tmp_path / "single.csv"]
    for i, path in enumerate(where):
        files = [path] if path.suffix else [path / "p1.csv", path / "p2.csv"]
        for n, file in enumerate(files):
            file.parent.mkdir(exist_ok=True)
            file.write_text(PREAMBLE + f"Title,Views\nt{i}{n},{i}\n")
    exports = [HalfReport(str(path), kind, "2024H1", "2024-01-01", "2024-06-30") for path, kind in zip(where[1:], ("Show", "Movie"))]
    rows = reports.read_raw_reports(spark, exports)
    assert sorted(tuples(rows, "Title", "content_type")) == [("t10", "Show"), ("t11", "Show"), ("t20", "Movie")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Parquet" not in plan and "recursiveFileLookup" not in plan
    outer = [HalfReport(str(where[0]), "Show", "2023H1", "2023-01-01", "2023-06-30"), exports[0]]
    assert sorted(set(tuples(reports.read_raw_reports(spark, outer), "Title", "period_label"))) == [
        ("t00", "2023H1"), ("t01", "2023H1"), ("t10", "2024H1"), ("t11", "2024H1"),
    ]


def test_a_report_folder_tags_by_its_names(spark, tmp_path):
    folder = tmp_path / "period_label=2023H2" / "content_type=Show"
    folder.mkdir(parents=True)
    (folder / "x.csv").write_text(PREAMBLE + "Title,Views\nFox,1\n")
    assert tuples(reports.read_report_folder(spark, str(tmp_path)), "Title", "Views", "Runtime", *reports.TAGS) == [
        ("Fox", "1", None, "Show", "2023H2", date(2023, 7, 1), date(2023, 12, 31))
    ]


def test_cut_lines_of_charts_are_rejected(spark, tmp_path):
    worldwide, countries = write_charts(tmp_path)
    with open(worldwide, "a") as file:
        file.write("2024-01-07\tFilms (English)\n2024-01-14\tTV (English)\tfirst\tOwl\tN/A\t1\t\t\t1\n" + "x\t" * 12 + "\n")
    with open(countries, "a") as file:
        file.write("Chad\tTD\t2024-01-07\n")
    landed = records.landed_tsv(spark, worldwide, schemas.GLOBAL_CHART)
    lost = [(name.rsplit("/", 1)[1], record) for name, record in tuples(records.rejected_records(landed), "file", "record")]
    assert sorted(lost) == [("global.tsv", "2024-01-07\tFilms (English)"), ("global.tsv", "x\t" * 12)]
    # a value that does not parse is a matter of its column
    kept = tuples(charts.read_global_chart(spark, worldwide), "week", "weekly_rank", "show_title")
    assert sorted(kept, key=repr) == [(date(2024, 1, 14), None, "Owl"), (date(2024, 1, 7), 1, "Fox"), (date(2024, 1, 7), 1, 'Say "Hi"')]
    assert charts.read_country_chart(spark, countries).count() == 2
    assert tuples(records.rejected_records(records.landed_tsv(spark, countries, schemas.COUNTRY_CHART)), "record") == [("Chad\tTD\t2024-01-07",)]


def test_cut_responses_are_rejected(spark, tmp_path):
    item = '{"id": "v1", "statistics": {"viewCount": "5"}, "snippet": {"publishedAt": "2024-01-01T00:00:00Z"}}'
    (tmp_path / "good.json").write_text(f'{{"items": [{item}]}}')
    (tmp_path / "cut.json").write_text(f'{{"items": [{item}, {item[:20]}')
    rows = videos.read_video_items(spark, str(tmp_path), datetime(2024, 2, 1))
    assert tuples(rows, "id", "statistics.viewCount") == [("v1", "5")]
    lost = tuples(records.rejected_records(videos.landed_responses(spark, str(tmp_path))), "file", "record")
    assert [(name.rsplit("/", 1)[1], record[:11]) for name, record in lost] == [("cut.json", '{"items": [')]

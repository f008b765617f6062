from datetime import date, datetime

from pyspark.sql import functions as F

from marquee.functions import calendar, numbers, text


def one_column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [row.out for row in rows]


def test_runtime_forms(spark):
    values = ["1:30", "0:05", " 2:00 ", "90", "1:xx", "1:30:00", "", ":", "1:", None]
    expected = [90, 5, 120, None, None, None, None, None, None, None]
    assert one_column(spark, values, text.runtime_minutes) == expected


def test_title_key_prefers_a_real_season(spark):
    rows = [
        ("The Show", "The Show: Season 2"),
        ("The Show", "N/A"),
        ("The Show", "nan"),
        ("The Show", "  "),
        ("The Show", None),
        (" Padded\t", None),
        ("Wide", "  Padded Season  "),
        (None, None),
        ("", "N/A"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = df.select("i", text.title_key(F.col("a"), F.col("b")).alias("k")).orderBy("i").collect()
    assert [row.k for row in got] == [
        "The Show: Season 2", "The Show", "The Show", "The Show", "The Show",
        "Padded", "Padded Season", None, None,
    ]


def test_categories(spark):
    values = ["Films (English)", "TV (Non-English)", "Films", "TV", "Live", None]
    assert one_column(spark, values, text.category_type) == [
        "Movie", "Show", "Movie", "Show", "Show", "Show",
    ]
    assert one_column(spark, values, text.category_language) == [
        "English", "Non-English", "English", "English", "English", "English",
    ]
    recoded = one_column(spark, values, lambda c: text.recode(c, text.COUNTRY_CATEGORIES))
    assert recoded == ["Films (English)", "TV (Non-English)", "Movie", "Show", "Live", None]


def test_calendar(spark):
    days = [date(2021, 7, 4), date(2024, 1, 6), date(2024, 1, 7), date(2024, 6, 30), date(2025, 1, 1)]

    def run(expression):
        return one_column(spark, days, expression, "date")

    assert run(calendar.week_start) == [
        date(2021, 7, 4), date(2023, 12, 31), date(2024, 1, 7), date(2024, 6, 30), date(2024, 12, 29),
    ]
    assert run(calendar.half_label) == ["2021H2", "2024H1", "2024H1", "2024H1", "2025H1"]
    assert run(calendar.half_start)[0] == date(2021, 7, 1)
    assert run(calendar.half_end)[:2] == [date(2021, 12, 31), date(2024, 6, 30)]
    weeks = one_column(spark, days, lambda c: calendar.date_parts(c)["iso_week"], "date")
    assert weeks == [26, 1, 1, 26, 1]
    names = one_column(spark, days, lambda c: calendar.date_parts(c)["month_name"], "date")
    assert names == ["July", "January", "January", "June", "January"]


def test_days_are_cut_towards_zero(spark):
    noon = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    values = [
        datetime(2024, 1, 12, 11), datetime(2024, 1, 12, 12), datetime(2024, 1, 10, 0),
        datetime(2024, 1, 9, 12), datetime(2024, 1, 8, 11),
    ]
    got = one_column(spark, values, lambda c: calendar.days_between(c, noon), "timestamp_ntz")
    assert got == [1, 2, 0, -1, -2]


def test_numbers(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(numbers.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [None, 25.0, None]
    assert one_column(spark, ["12", "x", None], numbers.whole_number_or_zero) == [12, 0, 0]
    assert one_column(spark, ["12", "x", None], numbers.whole_number) == [12, None, None]
    halves = one_column(spark, [1.005, 0.285, 2.5, -2.5], lambda c: F.round(c, 2), "double")
    assert halves == [1.01, 0.29, 2.5, -2.5]

"""The column expressions applied to whole tables, one report per rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import calendar, numbers, text
from marquee.operators import checks
from marquee.sources import shop

# Fixed values ---------------------------------------------------------------
MIDDLE_OF_EVENTS = "2024-01-15 12:00:00"
# ----------------------------------------------------------------------------


def runtime_parse(part: DataFrame) -> DataFrame:
    """Runtimes of every part, some in forms that are not ``h:mm``."""
    size = F.col("p_size")
    plain = shop.runtime_text(size)
    raw = (
        F.when(size % 7 == 0, size.cast("string"))
        .when(size % 11 == 0, F.concat(plain, F.lit(":00")))
        .when(size % 13 == 0, F.concat(size.cast("string"), F.lit(":xx")))
        .otherwise(plain)
    )
    return part.select("p_partkey", raw.alias("runtime_raw")).withColumn(
        "runtime_minutes", text.runtime_minutes(F.col("runtime_raw"))
    )


def category_split(part: DataFrame) -> DataFrame:
    """Category texts of every part: with language, plain, and unknown."""
    kind = F.when(shop.part_type_kind(F.col("p_type")) == text.SHOW, "TV").otherwise("Films")
    tongue = shop.name_language(F.col("p_name"))
    raw = (
        F.when(F.col("p_size") % 5 == 0, kind)
        .when(F.col("p_size") % 7 == 0, F.col("p_type"))
        .otherwise(F.concat(kind, F.lit(" ("), tongue, F.lit(")")))
    )
    category = F.col("category_raw")
    return part.select("p_partkey", raw.alias("category_raw")).withColumns(
        {
            "content_type": text.category_type(category),
            "language": text.category_language(category),
            "recoded": text.recode(category, text.COUNTRY_CATEGORIES),
        }
    )


def unparsed_values(part: DataFrame) -> DataFrame:
    """The report on values that fail, over the odd forms above and odd numbers and dates."""
    size = F.col("p_size").cast("string")
    odd = F.col("p_size") % 17
    numbers_as_text = F.when(odd == 0, F.concat(size, F.lit(" h"))).when(odd == 1, "1,234,000").when(odd == 2, "N/A").otherwise(size)
    half = runtime_parse(part).join(part.select("p_partkey", "p_size"), "p_partkey")
    half = half.select(
        F.col("runtime_raw").alias("Runtime"),
        numbers_as_text.alias("Hours Viewed"),
        size.alias("Views"),
        F.when(odd == 3, "soon").otherwise("2024-01-01").alias("Release Date"),
    )
    category = category_split(part).select(F.col("category_raw").alias("category"))
    return checks.unparsed(half, category, category)


def title_key(part: DataFrame) -> DataFrame:
    """Show and season texts of every part: padded, and marked as missing."""
    name, size = F.col("p_name"), F.col("p_size")
    season = (
        F.when(size % 2 == 0, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(size % 3 == 0, "nan")
        .when(size % 5 == 0, " ")
        .when(size % 7 != 0, "N/A")
    )
    return part.select(
        "p_partkey", shop.first_word(name).alias("show_title"), season.alias("season_title")
    ).withColumn("title_name", text.title_key(F.col("show_title"), F.col("season_title")))


def half_labels(orders: DataFrame) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return orders.select("o_orderkey", calendar.half_label(day).alias("half_label"))


def date_parts(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")).withColumns(
        calendar.date_parts(F.col("day"))
    )


def days_between(events: DataFrame) -> DataFrame:
    """Whole days of every event from a fixed noon, both before and after it."""
    middle = F.lit(MIDDLE_OF_EVENTS).cast("timestamp_ntz")
    return events.select("event_id", calendar.days_between(F.col("ts"), middle).alias("days"))


def json_extract(events: DataFrame) -> DataFrame:
    """Number fields of every event's JSON: one present, one that may lack."""
    fields = F.from_json("props", "k string, likes string")
    return events.select(
        "event_id",
        numbers.whole_number_or_zero(fields["k"]).alias("k"),
        numbers.whole_number_or_zero(fields["likes"]).alias("likes_or_zero"),
        numbers.whole_number(fields["likes"]).alias("likes"),
    )


def rounding(part: DataFrame) -> DataFrame:
    price = F.col("p_retailprice")
    return part.select(
        "p_partkey",
        F.round(price / F.lit(1000.0), 2).alias("thousands"),
        F.round(price / F.lit(7.0), 1).alias("sevenths"),
        F.round(price * F.lit(0.0005), 2).alias("two_thousandths"),
    )

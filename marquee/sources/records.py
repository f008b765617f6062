"""Records of landed text files, read in byte ranges, and the ones that do not parse.

A quoted field may hold line breaks, so where a line stands, in or outside quotes,
depends on everything above it in its file. Files are nevertheless cut into byte
ranges and read by many tasks: each range is reduced to its number of lines
and of lines with an odd number of quotes, the ranges of a file are chained by
sums over those few numbers, and every line then knows its place in the file and whether a
quote is open. Lines that are records of their own stay where they are; only
those of a record with line breaks are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"
# A field behind its comma: in quotes, doubled inside, or up to the next comma.
FIELD = r',("(?:[^"]++|"")*+"|[^,]*+)'
RANGE = ["file", "block"]
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def path_of(spark: SparkSession, path: str) -> str:
    """The path as :func:`lines` names it: absolute, escaped, without its file system."""
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    system = located.getFileSystem(context._jsc.hadoopConfiguration())
    return system.makeQualified(located).toUri().getRawPath()


def file_name() -> Column:
    return F.regexp_replace(F.col("_metadata.file_path"), SCHEME, "")


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file, block, at, line``: every line, the byte range it lies in, and its order there."""
    text = spark.read.options(lineSep="\n", recursiveFileLookup=True).text(paths)
    return text.select(
        file_name().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )


def placed_lines(spark: SparkSession, paths: str | Sequence[str], top: int) -> DataFrame:
    """``file, place, line, odd, opened, unclosed, head`` of every line; ``place`` counts from 1.

    ``odd``: whether the line has an odd number of quotes. ``opened``: how many
    lines before it have, the first ``top`` lines of the file left out; a quote
    is open where that is odd. ``unclosed``: the count at a quote that nothing closes.
    ``head``: the last of the first ``top`` lines.
    """
    in_range = "(PARTITION BY file, block ORDER BY at"
    odd = "(char_length(line) - char_length(replace(line, '\"', ''))) % 2 AS odd"
    counted = lines(spark, paths).selectExpr("*", odd).selectExpr(
        "*",
        f"row_number() OVER {in_range}) AS nth",
        f"coalesce(sum(odd) OVER {in_range} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ran",
    )
    ranges = counted.groupBy(*RANGE).agg(
        F.expr("count(1) AS n"),
        F.expr("sum(odd) AS odds"),
        F.expr(f"collect_list(CASE WHEN nth <= {top} THEN struct(nth, odd, line) END) AS first"),
    )
    # One row per range of a file from here on.
    above = "OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    chained = (
        ranges.selectExpr("*", f"coalesce(sum(n) {above}, 0) AS lines_above")
        .selectExpr("*", f"filter(first, x -> x.nth + lines_above <= {top}) AS in_top")
        .selectExpr("*", "aggregate(in_top, 0L, (n, x) -> n + x.odd) AS top_odds")
        .selectExpr(
            *RANGE,
            "lines_above",
            f"coalesce(sum(odds - top_odds) {above}, 0) - top_odds AS odds_above",
            "sum(odds - top_odds) OVER (PARTITION BY file) AS total",
            f"max(get(filter(in_top, x -> x.nth + lines_above = {top}), 0).line) OVER (PARTITION BY file) AS head",
        )
    )
    return counted.join(chained, RANGE).selectExpr(
        "file",
        "lines_above + nth AS place",
        "line",
        "odd = 1 AS odd",
        "odds_above + ran AS opened",
        "CASE WHEN total % 2 = 1 THEN total - 1 END AS unclosed",
        "head",
    )


def csv_records(spark: SparkSession, paths: str | Sequence[str], top: int) -> DataFrame:
    """``file, head, place, record, closed`` of every record below the first ``top`` lines, of which ``head`` is the last.

    ``place`` is the line a record begins at. Blank lines are no records. A quote that
    nothing closes takes no further lines with it: those of the rest of the
    file come one by one, with ``closed`` false.
    """
    body = placed_lines(spark, paths, top).filter(f"place > {top}")
    body = body.selectExpr("*", "opened % 2 = 1 OR odd AS open").selectExpr("*", "coalesce(open AND opened >= unclosed, false) AS lost")
    own = body.filter("(NOT open OR lost) AND line != ''").selectExpr("file", "head", "place", "line AS record", "NOT lost AS closed")
    parts = body.filter("open AND NOT lost").groupBy("file", "head", F.expr("opened div 2 AS pair"))
    joined = parts.agg(F.expr("array_sort(collect_list(struct(place, line))) AS parts")).selectExpr(
        "file", "head", "parts[0].place AS place", "array_join(parts.line, '\n') AS record", "true AS closed"
    )
    return own.unionByName(joined)


def fields(record: Column) -> Column:
    """The fields of a record: quotes taken off, empty ones outside quotes NULL."""
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(FIELD), F.lit(1))
    inside = lambda f: F.replace(F.substr(f, F.lit(2), F.char_length(f) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda f: F.when(f.startswith('"'), inside(f)).when(f != "", f))


def headed_records(spark: SparkSession, paths: str | Sequence[str], preamble: int) -> DataFrame:
    """``file, place, record, names, fields, good`` of the records below ``preamble`` lines and a header.

    Each file's own header names its fields, so files may order them as they like.
    A record is good if it has as many fields as its header, and no quote left open.
    """
    rows = csv_records(spark, paths, preamble + 1).filter("head is not null")
    # Split once: a name or a count that is looked up must not split the record again.
    split = rows.select("file", "place", "record", "closed", F.array(fields(F.col("head")), fields(F.col("record"))).alias("split"))
    named = split.select("file", "place", "record", "closed", F.inline(F.array(F.struct(F.col("split")[0].alias("names"), F.col("split")[1].alias("fields")))))
    good = F.col("closed") & (F.size("fields") == F.size("names"))
    return named.select("file", "place", "record", "names", "fields", good.alias("good"))


def field(name: str) -> Column:
    """A field of :func:`headed_records` by its name; NULL in files that lack it."""
    return F.get("fields", F.array_position("names", F.lit(name)).cast("int") - 1)


def landed_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every line of header TSV files as text fields, with the file and, where it is no record, the line.

    Fields stay text, so that a value that does not parse is a matter of its column (it becomes
    NULL in :func:`good_records`) and only a line with too few or too many fields is rejected.
    No ``nullValue``: a country code such as NA must stay a code.
    """
    return _landed_csv(spark, path, schema, "\t")


def _landed_csv(spark: SparkSession, path: str, schema: str, sep: str) -> DataFrame:
    names = [field.split()[0] for field in schema.split(", ")]
    text = ", ".join(f"{name} string" for name in [*names, CORRUPT])
    # Names of folders say nothing about the columns of a feed.
    options = {"recursiveFileLookup": True, "sep": sep, "header": True, "enforceSchema": False, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": CORRUPT}
    return spark.read.schema(text).options(**options).csv(path).select("*", file_name().alias("_file"))


def landed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """:func:`landed_tsv` of files with commas."""
    return _landed_csv(spark, path, schema, ",")


def is_record(landed: DataFrame) -> Column:
    """Whether a landed line or document parsed as a record."""
    # The reader refuses questions that read nothing but the corrupt records, so this reads all columns.
    return F.col(CORRUPT).isNull() | (parsed(landed) < 0)


def parsed(landed: DataFrame) -> Column:
    """How many columns were read."""
    own = [name for name in landed.columns if name not in (CORRUPT, "_file")]
    return F.size(F.array_compact(F.array(*(F.when(F.col(name).isNotNull(), F.lit(name)) for name in own))))


def good_records(landed: DataFrame, schema: str) -> DataFrame:
    """The landed records with the types of ``schema``; a value that does not parse is NULL."""
    typed = [F.col(name).try_cast(kind).alias(name) for name, kind in (field.split() for field in schema.split(", "))]
    return landed.filter(is_record(landed)).select(*typed)


def rejected_records(landed: DataFrame) -> DataFrame:
    """``file, record, parsed`` of the landed lines or documents that are no records; ``parsed`` counts the columns read before they broke."""
    return landed.filter(~is_record(landed)).select(
        F.col("_file").alias("file"), F.col(CORRUPT).alias("record"), parsed(landed).alias("parsed")
    )

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from marquee.llm import warc
from marquee.llm.common import scratch_path
from tests.llm.conftest import SMOKE_DIR, expected, rows_of

LONG, OTHER = "é" * 600, "<p>\r\n\r\nWARC/1.1\r\n\r\n</p>" * 60
PAGES = [
    (1, "http://a/", LONG),
    (2, "http://b/", LONG),
    (7, "http://c/\r\nX: y", LONG),
    (3, None, "short"),
    (4, "http://d/", "short"),
    (5, "http://e/", None),
    (6, "http://f/", ""),
    (8, "http://g/", OTHER),
    (9, "http://h/", OTHER + "\n"),
    (10, "http://i/", "a" * 1000),
    (11, "http://j/", "a" * 1000),
    (12, "http://k/", "a" * 999),
    (13, "http://l/", "a" * 999),
    (14, "", "z" * 300000),
]


def plain(pages, min_bytes=1000):
    largest = {}
    for page, _, html in pages:
        largest[html or ""] = max(page, largest.get(html or "", page))
    for page, _, html in pages:
        data = (html or "").encode()
        original = largest[html or ""]
        revisit = len(data) >= min_bytes and original != page
        yield page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.withColumns({n: F.lit("x") for n in ("payload", "payload_digest", "original", "kept", "record")}).repartition(3)


def test_digest(pages):
    assert rows_of(warc.digest(pages)) == expected(plain(PAGES))


def test_digest_of_smoke_pages(spark):
    pages = spark.read.parquet(f"{SMOKE_DIR}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    twice = pages.union(pages.withColumn("page_id", F.col("page_id") + 1000))
    rows += [(p + 1000, u, h) for p, u, h in rows]
    assert rows_of(warc.digest(twice)) == expected(plain(rows))


def test_archives_hold_each_payload_once(spark, pages):
    path = scratch_path(spark, "archives")
    warc.write(warc.resolve(pages), path, records_a_file=2)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()
    assert len(files) >= len(PAGES) / 2
    text = b"".join(gzip.decompress(bytes(f.content)) for f in files)
    assert text.count(LONG.encode()) == 1 and text.count(b"WARC-Type: revisit") == 3
    assert b"http://c/%0D%0AX:%20y" in text and text.endswith(b"\r\n\r\n")
    payloads = {r.page_id: r.payload for r in warc.read(spark, path, with_payload=True).collect() if r.record_type == "response"}
    assert {p: bytes(x).decode() for p, x in payloads.items()} == {p: h or "" for p, _, h in PAGES if p not in (1, 2, 10)}


def test_members_for_each_record_are_read_too():
    record = (
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nWARC-Payload-Digest: sha1:"
        + hashlib.sha1(b"hi").hexdigest()
        + "\r\nContent-Length: 40\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    ).encode()
    content = gzip.compress(record) * 3
    assert [r[-1] for r in warc.parse(memoryview(content))] == [b"hi"] * 3
    with pytest.raises(ValueError, match="payload"):
        list(warc.parse(memoryview(gzip.compress(record.replace(b"hi", b"ho")))))
    with pytest.raises(ValueError, match="short"):
        list(warc.parse(memoryview(gzip.compress(record[:-30]))))


def test_null_and_repeated_ids(spark):
    rows = [(None, "u", LONG), (3, "u", LONG), (3, "u", LONG), (None, "u", OTHER), (None, None, None)]
    got = warc.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got) == [
        (0, "response", 0), (0, "response", 0), (0, "revisit", 3), (3, "response", 0), (3, "response", 0),
    ]


def test_every_record_has_an_id_of_its_own(spark):
    rows = [(3, "u", LONG)] * 4 + [(3, "v", LONG), (1, "u", LONG), (None, "w", OTHER), (None, "w", OTHER), (None, "x", OTHER), (4, None, None), (4, None, None), (5, "u", "s")]
    path = scratch_path(spark, "archives")
    warc.write(warc.resolve(spark.createDataFrame(rows, "page_id long, url string, html string")), path)
    read = warc.read(spark, path).collect()
    assert len(read) == len(rows) and len({r.record_id for r in read}) == len(rows)
    responses = {r.record_id: r.page_id for r in read if r.record_type == "response"}
    assert [responses[r.refers_to_record] for r in read if r.record_type == "revisit"] == [3]


def test_long_pages_go_to_archives_of_few(spark):
    pages = spark.range(100, numPartitions=1).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat("id", F.repeat(F.lit("x"), F.when(F.col("id") < 40, 5000).otherwise(50).cast("int"))).alias("html")
    )
    path = scratch_path(spark, "archives")
    warc.write(warc.resolve(pages), path, records_a_file=30, file_bytes=60_000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()
    counts = [gzip.decompress(bytes(f.content)).count(b"WARC/1.1") for f in files if "/large/" in f.path]
    assert sum(counts) == 40 and max(counts) <= warc.LARGE_A_FILE
    assert sorted(r.page_id for r in warc.read(spark, path).collect()) == list(range(100))


def test_payloads_stay_where_they_are(spark):
    """Originals and repeated rows are few: they are broadcast, and no exchange holds a payload."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = warc.resolve(pages)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and "hashpartitioning(key" not in plan


def test_no_pages(pages):
    assert warc.digest(pages.limit(0)).collect() == []

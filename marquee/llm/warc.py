"""WARC archives without repeated payloads: revisit resolution, writing and reading.

Headers (id, length, SHA-1 of the payload) are shuffled by digest; of payloads of at least
``min_bytes`` that are equal, the record of the largest id is the response and the others
are revisits of it. The archives are written by Spark's text writer with the record end
as line separator, gzip files of so many records, fewer of long ones, so that a lost task is written
again and only whole files are committed. Reading parses records by their stated
lengths, never by separators in payloads, and joins revisits to the responses they name.

Rows: a null payload is empty; a null url is written empty, white space and control
characters in urls are percent-encoded; repeated rows of the response's id are responses each, with record ids of their own; a row without id is a revisit
if an equal payload has an id, else a response. Ids must be numbers.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import scratch_path, written

MIN_BYTES = 1000
RECORDS_A_FILE = 2000
FILE_BYTES = 128 << 20
LARGE_A_FILE = 16
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The page id, which the standard has no field for.
ID_FIELD = "X-Page-Id"
READ_BYTES = 1 << 20


def resolve(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, rank, payload, payload_bytes, payload_digest, original, original_url``; ``original`` is null for responses.

    ``rank`` tells rows apart that agree in id, url and payload. Only headers are shuffled to find originals and repeated rows. Both are
    written, so their size is known when they meet the payloads: tables that can be broadcast leave the payloads where they are.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        _safe_url(F.coalesce(F.col(url_col), F.lit(""))).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1(F.col("payload").cast("binary"))})
    headers = written(rows.drop("payload"), "headers")
    originals = (
        headers.where(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("key"))
        .agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("records"))
        .where("records > 1 and kept.page_id is not null")
        .select("key", "kept")
    )
    originals = written(originals, "originals")
    same = ["page_id", "url", "payload_digest"]
    repeated = headers.groupBy(*same).agg(F.count("*").alias("copies")).where("copies > 1")
    repeated = written(repeated.toDF(*(f"r_{c}" for c in same), "copies"), "repeated")
    match = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in same]
    once = rows.join(repeated, match, "left_anti").withColumn("rank", F.lit(1).cast("long"))
    # Of rows that repeat one payload travels, and comes back as many times.
    copies = rows.join(repeated, match, "left_semi").groupBy(*same, "payload_bytes").agg(F.first("payload").alias("payload"), F.count("*").alias("copies"))
    each = copies.withColumn("rank", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rows = once.unionByName(each.drop("copies"))
    # Short payloads are never revisits; keys of their own keep equal ones from meeting in one task.
    key = F.when(F.col("payload_bytes") >= min_bytes, F.col("payload_digest")).otherwise(F.concat(F.lit("short "), F.xxhash64("page_id", "url").cast("string")))
    is_revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept.page_id"))
    return rows.withColumn("key", key).join(originals, "key", "left").select(
        "page_id",
        "url",
        "rank",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(is_revisit, F.col("kept.page_id")).alias("original"),
        F.when(is_revisit, F.col("kept.url")).alias("original_url"),
    )


def _safe_url(url: Column) -> Column:
    """No control character or space, which would end a header line."""
    for code in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _record_id(page_id: Column, digest: Column, url: Column, rank: Column) -> Column:
    """A fresh record id, the same whenever the task is run again."""
    h = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("none")), digest, rank.cast("string"), url))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _head(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field without value is left out."""
    return F.concat_ws("", *(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)) for name, value in fields))


def records(resolved: DataFrame) -> DataFrame:
    """``record``: each record as text, without the separator behind it."""
    is_revisit = F.col("original").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}"),
        _head(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("payload_bytes"))),
        F.lit(CRLF),
    )
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    head = _head(
        ("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"), F.col("url"), F.col("rank"))),
        ("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(is_revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(is_revisit, _record_id(F.col("original"), F.col("payload_digest"), F.col("original_url"), F.lit(1)))),
        ("WARC-Refers-To-Target-URI", F.when(is_revisit, F.col("original_url"))),
        (ID_FIELD, F.col("page_id")),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length(block)),
    )
    return resolved.select(F.concat(F.lit(VERSION + CRLF), head, F.lit(CRLF), block).alias("record"))


def write(resolved: DataFrame, path: str, records_a_file: int = RECORDS_A_FILE, file_bytes: int = FILE_BYTES) -> None:
    """Archives of ``records_a_file`` records; those that write more than their share of ``file_bytes`` go to archives of ``LARGE_A_FILE``."""
    size = F.when(F.col("original").isNull(), F.col("payload_bytes")).otherwise(0)
    share = file_bytes // records_a_file
    for some, name, records_each in ((size <= share, "small", records_a_file), (size > share, "large", LARGE_A_FILE)):
        (
            records(resolved.where(some))
            .write.option("lineSep", RECORD_END)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", records_each)
            .text(f"{path}/{name}")
        )


class _Stream:
    """Bytes of a gzip file, a part at a time."""

    def __init__(self, content: memoryview):
        self.rest, self.gzip, self.held = content, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        if self.gzip.eof and len(self.gzip.unused_data) + len(self.rest):
            # archives may hold one gzip member for each record
            self.rest, self.gzip = memoryview(self.gzip.unused_data + bytes(self.rest)), zlib.decompressobj(31)
        part, self.rest = self.rest[: READ_BYTES // 4], self.rest[READ_BYTES // 4 :]
        if not len(part):
            return False
        self.held += self.gzip.decompress(part)
        return True

    def until(self, mark: bytes) -> bytes | None:
        at = self.held.find(mark)
        while at < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
            at = self.held.find(mark, seen)
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        if len(self.held) < n:
            raise ValueError("a record is cut short")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split(CRLF)[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def parse(content: memoryview) -> Iterator[tuple]:
    """Of each record: id, type, digest and length of the full payload, record named, page id, payload."""
    stream, end = _Stream(content), RECORD_END.encode()
    while (head := stream.until(end)) is not None:
        fields = _fields(head)
        block = stream.take(int(fields["content-length"]))
        if stream.take(len(end)) != end:
            raise ValueError("a record is longer than stated")
        http, _, payload = block.partition(end)
        digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(_fields(http)["content-length"])
        if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"the payload of {fields['warc-record-id']} is not what its header states")
        page = fields.get(ID_FIELD.lower())
        yield fields["warc-record-id"], fields["warc-type"], digest, size, fields.get("warc-refers-to"), page and int(page), fields.get("warc-target-uri"), payload


_SCHEMA = "record_id string, record_type string, payload_digest string, payload_bytes long, refers_to_record string, page_id long, url string"


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives in a folder; the payload, of responses only, on request."""
    schema = _SCHEMA + (", payload binary" if with_payload else "")
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * with_payload
    names = [field.split()[0] for field in schema.split(", ")]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("content"):
                held, size = [], 0
                for record in parse(memoryview(file.as_buffer())):
                    held.append(record[: len(kinds)])
                    size += len(record[-1]) if with_payload else 100
                    if size > READ_BYTES:
                        yield _batch(held, kinds, names)
                        held, size = [], 0
                if held:
                    yield _batch(held, kinds, names)

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content").mapInArrow(rows, schema)


def _batch(records: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*records), kinds)], names)


def link_revisits(records: DataFrame) -> DataFrame:
    """The records with ``refers_to``: the page id of the response that a revisit names."""
    responses = (
        records.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to_record"))
        .agg(F.max("page_id").alias("refers_to"))
    )
    revisits = records.where("record_type = 'revisit'").join(responses, "refers_to_record", "left")
    rest = records.where("record_type != 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return rest.unionByName(revisits)


def digest(pages: DataFrame) -> DataFrame:
    """Writes the archives into the shared folder and reads them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write(resolve(pages), path)
    return link_revisits(read(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

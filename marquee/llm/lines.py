"""Line dedup: hashes range-partitioned, sorted by document and position, first occurrences streamed.

A line's key is the line without white space at its ends, A-Z in lower case. A key of
at least ``min_chars`` code points that several documents hold stays in the first of
them (smallest id) and loses its lines in the others. No text is shuffled to decide:
128-bit hashes of keys go to ranges of hash, document and position, so that the
occurrences of one frequent line spread over as many tasks as they need. Each task
streams its range. Only the runs at its two ends may go on in a neighbour; their
first documents are compared afterwards in a small table of edges.

The result is a compressed bitmap per document that loses lines; a document
without one keeps all. Rows: a null or empty text is one empty line; rows of one
id and one text are one document; of rows with one id and different texts the one with the
smaller text hash comes first; null ids stay null.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import doc_key, doc_rows, text_steps, texts_of, unused, written

MIN_CHARS = 10
_PLACE = ["h1", "h2", "doc_key", "text_key", "line"]


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\v\f\r").lower()


def line_hashes(rows: DataFrame, min_chars: int) -> DataFrame:
    """``h1, h2, doc_key, text_key, line`` of every line whose key is long enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            hashes, row, place = [], [], []
            for i, text in enumerate(texts_of(batch.column("text"))):
                for n, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
                        hashes.append(hashlib.blake2b(key, digest_size=16).digest())
                        row.append(i)
                        place.append(n)
            pair = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0]), pa.array(pair[:, 1]), batch.column("doc_key").take(row), batch.column("text_key").take(row), pa.array(place, pa.int32())],
                _PLACE,
            )

    return rows.select("doc_key", "text_key", "text").mapInArrow(run, "h1 long, h2 long, doc_key long, text_key int, line int")


def _later(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows: those behind the first document of their hash; and, marked as edge,
    the lines of the first document of the first and of the last hash."""
    run = None  # hash and first document of the run that the last batch ended in
    first_hash = None
    tail: list[pa.RecordBatch] = []  # lines of the first document of the current run, if it is not the first run
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in _PLACE]
        h1, h2, doc, text = cols[:4]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if run is not None and (h1[0], h2[0]) == run[:2]:
            new[0] = False
        if first_hash is None:
            first_hash = (h1[0], h2[0])
        number = np.cumsum(new)  # 0: the run goes on from the batch before
        heads = np.flatnonzero(new)
        lead_doc, lead_text = np.append(0, doc[heads]), np.append(0, text[heads])
        if run is not None:
            lead_doc[0], lead_text[0] = run[2:]
        later = (doc != lead_doc[number]) | (text != lead_text[number])
        in_first = (h1 == first_hash[0]) & (h2 == first_hash[1])
        edge = ~later & in_first
        out = later | edge
        yield batch.filter(pa.array(out)).append_column("edge", pa.array(edge[out]))
        run = (h1[-1], h2[-1], lead_doc[number[-1]], lead_text[number[-1]])
        last = number == number[-1]
        if len(heads):
            tail = []
        keep = last & ~later & ~in_first
        if keep.any():
            tail.append(batch.filter(pa.array(keep)))
    for batch in tail:
        yield batch.append_column("edge", pa.array(np.ones(batch.num_rows, bool)))


def lost_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_key, text_key, line`` of every line that goes."""
    hashes = line_hashes(doc_rows(docs, id_col, text_col), min_chars)
    ranged = hashes.repartitionByRange(*_PLACE).sortWithinPartitions(*_PLACE)
    found = written(ranged.mapInArrow(_later, "h1 long, h2 long, doc_key long, text_key int, line int, edge boolean"), "lines")
    edges = found.where("edge")
    owner = F.struct("doc_key", "text_key")
    first = edges.groupBy("h1", "h2").agg(F.min(owner).alias("first"))
    across = edges.join(first, ["h1", "h2"]).where(owner != F.col("first"))
    place = ["doc_key", "text_key", "line"]
    # repeated rows of a document name their lines twice
    return found.where("not edge").select(*place).union(across.select(*place)).distinct()


def pack(places: list[int]) -> bytes:
    """A keep bitmap, a zero bit at each of ``places``, as long as the last of them asks, deflated."""
    bits = np.ones(-(-(max(places) + 1) // 8) * 8, bool)
    bits[places] = False
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes())


def unpack(bitmap: bytes, n: int) -> np.ndarray:
    """The keep flags of ``n`` lines; lines beyond the bitmap are kept."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[:n].astype(bool)
    return np.concatenate([bits, np.ones(n - len(bits), bool)])


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_key, text_key, bitmap binary`` of the documents that lose lines."""
    lost = lost_lines(docs, min_chars, id_col, text_col).groupBy("doc_key", "text_key").agg(F.collect_list("line").alias("places"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [pack(x) for x in batch.column("places").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_key"), batch.column("text_key"), pa.array(maps, pa.binary())], ["doc_key", "text_key", "bitmap"])

    return lost.mapInArrow(run, "doc_key long, text_key int, bitmap binary")


def kept_text(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """What stays of a text, its number of lines, and how many go."""
    lines = text.split(b"\n")
    if bitmap is None:
        return text, len(lines), 0
    keep = unpack(bitmap, len(lines))
    kept = [line for line, stays in zip(lines, keep.tolist()) if stays]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: lines, lines dropped, digest of what stays."""
    bitmaps = keep_bitmaps(docs)
    rows = doc_rows(docs).join(bitmaps, ["doc_key", "text_key"], "left").select("doc_id", "text", "bitmap")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            n, dropped, sha = [], [], []
            for text, bitmap in zip(texts_of(batch.column("text")), batch.column("bitmap").to_pylist()):
                kept, lines, lost = kept_text(text, bitmap)
                n.append(lines)
                dropped.append(lost)
                sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return rows.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents, all their columns, with the lines gone; a null text stays null, and ``n_chars``, where there is one, follows."""
    key, text_key, bitmap = (unused(docs, name) for name in ("doc_key", "text_key", "bitmap"))
    bitmaps = keep_bitmaps(docs).toDF(key, text_key, bitmap)
    keyed = docs.withColumn(key, doc_key()).withColumn(text_key, F.hash("text"))
    schema = docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            old, maps = batch.column("text"), batch.column(bitmap).to_pylist()
            new = [None if absent else kept_text(text, own)[0] for text, own, absent in zip(texts_of(old), maps, old.is_null().to_pylist())]
            new = pa.array(new, pa.binary()).cast(pa.string())
            out = [new if c == "text" else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(out, schema.names)

    kept = keyed.join(bitmaps, [key, text_key], "left").select(*[F.col(f"`{c}`") for c in schema.names], bitmap).mapInArrow(run, schema)
    return kept.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType)) if "n_chars" in schema.names else kept



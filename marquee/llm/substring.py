"""Substring dedup: every word run of ``window`` words that also starts earlier is removed.

Windows travel as super-k-mers. The minimiser of a window is the smallest hash
of the ``gram``-word runs in it; consecutive windows with one minimiser are one packed
string, sent to the bucket of that minimiser, so equal windows meet in one bucket. Minimisers fall into
cells by hash, whose bytes are counted first: buckets are runs of cells of at most ``BUCKET_BYTES``, and a cell of more
is split over several buckets by the hash of the whole window, its windows one by one. In a bucket
the windows are sorted by hash; those that share a hash are compared as
bytes, and all but the earliest are marked. The marks go back to their document as spans of words.

A string that a task's batch has seen before is settled there: its later occurrence is
covered as a whole, whatever stands elsewhere, so only the earliest travels with its
text. In a bucket the same holds. One passage in a third of all documents hence costs a
bucket one string and, per batch, one row.

"Earlier" means smaller id, or the same document and an earlier start. Rows: null and empty
texts have no words; rows of one id and one text are one document; of rows with one id and
different texts the one with the smaller text hash comes first; null ids stay null.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import batched
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import doc_rows, text_steps
from marquee.llm.words import NOT_SPACE, Words, gram_hashes, mix, split_words, word_hashes

WINDOW = 20
GRAM = 3
# Windows of one super-k-mer, at most: long runs of one minimiser are cut.
LONGEST = 64
# Buckets for each shuffle partition, at least: a task works on one bucket at a time.
BUCKETS_A_TASK = 8
# Bytes of packed strings a task, about, where that asks for more tasks than there are shuffle partitions.
TASK_BYTES = 64 << 20
BUCKET_BYTES = 8 << 20
CELLS = 1 << 16
# Marks that leave a bucket at once.
MARKS = 1 << 16
BATCH_BYTES = 8 << 20
# Between packed strings: white space other than the space that joins words, as words may hold any other byte.
_BETWEEN = b"\n"
_CODEC, _LEVEL = "zstd", 6


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` consecutive values."""
    width = 1
    while width * 2 <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = n - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def super_kmers(words: Words, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of each."""
    n = len(hashes)
    valid = np.zeros(n + 1, bool)
    sizes = np.diff(words.first)
    edge = np.zeros(n + 1, np.int32)
    has = sizes >= window
    np.add.at(edge, words.first[:-1][has], 1)
    np.add.at(edge, words.first[1:][has] - window + 1, -1)
    valid = np.cumsum(edge)[:n] > 0
    if not valid.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = np.zeros(n, np.uint64)
    found = _least(mix(gram_hashes(hashes, gram)), window - gram + 1)
    least[: len(found)] = found
    starts_text = np.zeros(n + 1, bool)
    starts_text[words.first] = True
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | starts_text[1:n]
    start = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    count = np.bincount(number[valid], minlength=len(start))
    parts = -(-count // LONGEST)
    of = np.repeat(np.arange(len(start)), parts)
    place = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    return start[of] + place * LONGEST, np.minimum(count[of] - place * LONGEST, LONGEST), least[start[of]]


def _pack(arrays: list[np.ndarray], strings: bytes) -> bytes:
    """Arrays and packed strings as one compressed block."""
    head = np.array([len(a) for a in arrays] + [len(strings)], "<i8").tobytes()
    raw = head + b"".join(a.tobytes() for a in arrays) + strings
    return np.array([len(raw)], "<i8").tobytes() + pa.Codec(_CODEC, _LEVEL).compress(raw, asbytes=True)


_TYPES = [np.dtype(t) for t in ("<i8", "<i4", "<u2", "<i4", "u1", "<u2", "<i4", "u1")]


def _unpack(block: bytes) -> tuple[list[np.ndarray], bytes]:
    """Documents (key, text key); strings by document, start, windows, bytes follow; settled ones by document, start, windows."""
    size = int(np.frombuffer(block, "<i8", 1)[0])
    raw = pa.Codec(_CODEC).decompress(block[8:], size, asbytes=True)
    counts = np.frombuffer(raw, "<i8", len(_TYPES) + 1).tolist()
    at, arrays = 8 * (len(_TYPES) + 1), []
    for kind, n in zip(_TYPES, counts):
        arrays.append(np.frombuffer(raw, kind, n, at))
        at += kind.itemsize * n
    return arrays, raw[at:]


class _Strings(NamedTuple):
    """Super-k-mers of a batch: first word, windows, cell, and whether no earlier one is the same string, of bytes ``low`` to ``high``."""

    doc: np.ndarray
    text_key: np.ndarray
    words: Words
    hashes: np.ndarray
    raw: bytes
    start: np.ndarray
    count: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray


def _unseen(raw: bytes, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether each string stands for the first time."""
    seen: set[bytes] = set()
    first = np.ones(len(low), bool)
    for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
        string = raw[a:b]
        if string in seen:
            first[i] = False
        else:
            seen.add(string)
    return first


def _strings(batch: pa.RecordBatch, window: int, gram: int) -> _Strings:
    order = pc.sort_indices(pa.Table.from_batches([batch.select(["doc_key", "text_key"])]), [("doc_key", "ascending"), ("text_key", "ascending")])
    batch = batch.take(order)
    doc, text_key = batch.column("doc_key").to_numpy(), batch.column("text_key").to_numpy()
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text_key[1:] != text_key[:-1])
    if not new.all():  # repeated rows are one document
        batch, doc, text_key = batch.filter(pa.array(new)), doc[new], text_key[new]
    words = split_words(batch.column("text"), NOT_SPACE)
    hashes = word_hashes(words)
    start, count, least = super_kmers(words, hashes, window, gram)
    raw = words.data.tobytes()
    last = start + count + window - 2
    low, high = words.start[start], words.start[last] + words.length[last]
    cell = (mix(least) % np.uint64(CELLS)).astype(np.int64)
    return _Strings(doc, text_key, words, hashes, raw, start, count, cell, low, high, _unseen(raw, low, high))


def _sizes(batch: pa.RecordBatch, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a batch, the bytes of their different strings, and those of the windows of these one by one."""
    s = _strings(batch, window, gram)
    size = (s.high - s.low)[s.first]
    apart = size * s.count[s.first] * window // (s.count[s.first] + window - 1)
    cells, at = np.unique(s.cell[s.first], return_inverse=True)
    return cells, np.bincount(at, size, len(cells)).astype(np.int64), np.bincount(at, apart, len(cells)).astype(np.int64)


def bucket_plan(sizes: np.ndarray, apart: np.ndarray, least_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First bucket of each cell and how many it is split over, of the bytes of its strings and of its single windows."""
    most = max(1, min(BUCKET_BYTES, int(sizes.sum()) // least_buckets))
    base, parts = np.zeros(len(sizes), np.int32), np.ones(len(sizes), np.int32)
    bucket = held = 0
    for cell, (size, single) in enumerate(zip(sizes.tolist(), apart.tolist())):
        if held and held + size > most:
            bucket, held = bucket + 1, 0
        base[cell] = bucket
        held += size
        if size > BUCKET_BYTES:
            parts[cell] = -(-single // BUCKET_BYTES)
            bucket, held = bucket + int(parts[cell]), 0
    return base, parts


def _blocks(batch: pa.RecordBatch, base: np.ndarray, parts: np.ndarray, window: int, gram: int) -> Iterator[tuple[int, bytes]]:
    """The super-k-mers of a batch, one block for each bucket."""
    s = _strings(batch, window, gram)
    if not len(s.start):
        return
    doc, words = s.doc, s.words
    row = np.searchsorted(words.first, s.start, "right") - 1
    start, count, low, high, first = s.start, s.count, s.low, s.high, s.first
    # what is settled needs no other string: in a split cell it goes by its document
    by_doc = mix(doc[row].astype(np.int64).view(np.uint64)) % parts[s.cell].astype(np.uint64)
    bucket = base[s.cell] + by_doc.astype(np.int64)
    split = np.flatnonzero(first & (parts[s.cell] > 1))
    if len(split):
        n = count[split]
        of = np.repeat(split, n)
        begin = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        part = (mix(gram_hashes(s.hashes, window)[begin]) % parts[s.cell[of]].astype(np.uint64)).astype(np.int64)
        begin_low, begin_high = words.start[begin], words.start[begin + window - 1] + words.length[begin + window - 1]
        unseen = _unseen(s.raw, begin_low, begin_high)
        part = np.where(unseen, part, by_doc[of].astype(np.int64))
        whole = np.ones(len(start), bool)
        whole[split] = False
        bucket = np.concatenate([bucket[whole], base[s.cell[of]] + part])
        row, start = np.concatenate([row[whole], row[of]]), np.concatenate([start[whole], begin])
        count = np.concatenate([count[whole], np.ones(len(of), count.dtype)])
        low, high = np.concatenate([low[whole], begin_low]), np.concatenate([high[whole], begin_high])
        first = np.concatenate([first[whole], unseen])
    offset = (start - words.first[row]).astype("<i4")
    by_bucket = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[by_bucket], prepend=-1))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(by_bucket)]):
        some = by_bucket[a:b]
        sent, settled = some[first[some]], some[~first[some]]
        docs, at = np.unique(row[some], return_inverse=True)
        at = at.astype("<u2")  # a step holds fewer rows than two bytes count
        is_sent = first[some]
        arrays = [doc[docs].astype("<i8"), s.text_key[docs].astype("<i4"), at[is_sent], offset[sent], count[sent].astype("u1"), at[~is_sent], offset[settled], count[settled].astype("u1")]
        yield int(bucket[some[0]]), _pack(arrays, _BETWEEN.join([s.raw[i:j] for i, j in zip(low[sent].tolist(), high[sent].tolist())]))


def _marks(blocks: Iterable[bytes], window: int) -> Iterator[tuple[int, int, int, int]]:
    """Of one bucket: ``doc_key, text_key, begin, end`` of spans covered by windows that also start earlier."""
    earliest: dict[bytes, tuple[int, int, int]] = {}
    windows: dict[bytes, int] = {}
    for block in blocks:
        (doc, text_key, of, start, count, of2, start2, count2), packed = _unpack(block)
        keys = list(zip(doc.tolist(), text_key.tolist()))
        for i, at, n in zip(of2.tolist(), start2.tolist(), count2.tolist()):
            yield *keys[i], at, at + n + window - 1
        if not len(of):
            continue
        for string, i, at, n in zip(packed.split(_BETWEEN), of.tolist(), start.tolist(), count.tolist()):
            place = (*keys[i], at)
            other = earliest.setdefault(string, place)
            if other != place:
                if place < other:
                    earliest[string], place = place, other
                yield *place, place[2] + n + window - 1
            else:
                windows[string] = n
    if not earliest:
        return
    strings, places = list(earliest), list(earliest.values())
    words = split_words(pa.array(strings, pa.large_binary()), NOT_SPACE)
    grams = gram_hashes(word_hashes(words), window)
    counts = np.diff(words.first) - window + 1
    string = np.repeat(np.arange(len(strings)), counts)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = words.first[string] + offset
    hashes = grams[at]
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    shared = order[same[1:] | same[:-1]]
    if not len(shared):
        return
    # direct comparison: windows of one hash by their bytes
    first: dict[bytes, tuple[int, int, int]] = {}
    keyed = []
    for w in shared.tolist():
        begin = int(at[w])
        content = words.span(begin, begin + window)
        key, text, begin = places[string[w]]
        place = (key, text, begin + int(offset[w]))
        keyed.append((place, content))
        other = first.setdefault(content, place)
        if place < other:
            first[content] = place
    marked = sorted(place for place, content in keyed if first[content] != place)
    run: tuple[int, int, int, int] | None = None
    for key, text, begin in marked:
        if run and run[:2] == (key, text) and begin <= run[3]:
            run = (*run[:3], begin + window)
        else:
            if run:
                yield run
            run = (key, text, begin, begin + window)
    if run:
        yield run


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_key, text_key, begin, end`` of spans of words to remove; they may overlap."""
    if not 1 <= gram <= window or window + LONGEST > 1 << 16:
        raise ValueError("window must hold a gram")
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = doc_rows(docs, id_col, text_col).select("doc_key", "text_key", "text")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches, limit=BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _sizes(batch, window, gram)], ["cell", "bytes", "apart"])

    measured = texts.mapInArrow(measure, "cell long, bytes long, apart long").groupBy("cell").agg(F.sum("bytes"), F.sum("apart"))
    sizes, apart = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
    for cell, size, single in measured.collect():  # at most one row for each cell
        sizes[cell], apart[cell] = size, single
    tasks = max(tasks, -(-int(sizes.sum()) // TASK_BYTES))
    base, parts = bucket_plan(sizes, apart, tasks * BUCKETS_A_TASK)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches, limit=BATCH_BYTES):
            pairs = list(_blocks(batch, base, parts, window, gram))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in pairs], pa.int32()), pa.array([x for _, x in pairs], pa.binary())], ["bucket", "block"]
            )

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, bytes]]:
            for batch in batches:
                yield from zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist())

        stream, held = rows(), []
        held = next(stream, None)
        while held is not None:
            bucket = held[0]

            def own() -> Iterator[bytes]:
                nonlocal held
                while held is not None and held[0] == bucket:
                    yield held[1]
                    held = next(stream, None)

            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            for marks in batched(_marks(own(), window), MARKS):
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*marks), kinds)], ["doc_key", "text_key", "begin", "end"])

    blocks = texts.mapInArrow(pack, "bucket int, block binary")
    sorted_blocks = blocks.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return sorted_blocks.mapInArrow(sort, "doc_key long, text_key int, begin int, end int")


def remove_words(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Number of words, of words removed, and the kept words joined by one space."""
    words = text.split()  # ASCII white space, as for bytes
    keep = [True] * len(words)
    done = 0
    for begin, end in sorted(spans):
        begin = max(begin, done)
        if end > begin:
            keep[begin:end] = [False] * (end - begin)
            done = end
    kept = [word for word, stays in zip(words, keep) if stays]
    return len(words), len(words) - len(kept), b" ".join(kept)


def dedupe(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every document; ``kept`` is its remaining words joined by one space."""
    spans = (
        repeated_spans(docs, window, gram, id_col, text_col)
        .groupBy("doc_key", "text_key")
        .agg(F.collect_set(F.struct("begin", "end")).alias("spans"))  # repeated rows bring the same spans
    )
    rows = doc_rows(docs, id_col, text_col).join(spans, ["doc_key", "text_key"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            out = []
            for text, some in zip(batch.column("text"), batch.column("spans")):
                pairs = [] if not some.is_valid else list(zip(some.values.field(0).to_pylist(), some.values.field(1).to_pylist()))
                out.append(remove_words(text.as_buffer().to_pybytes(), pairs))
            n, removed, kept = zip(*out)
            kept = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), kept], ["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def digest(docs: DataFrame) -> DataFrame:
    return dedupe(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

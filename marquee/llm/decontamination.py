"""Benchmark decontamination by Wu-Manber search for many word sequences at once.

Words are lower-case runs of ASCII letters, digits and characters beyond ASCII. A test
string is each run of ``window`` words of an item; an item of fewer words is one test string.
Test strings of one length share a shift table: a block of two words that no test string
holds lets the search jump over all ends that would need it. Where the shift is zero, the
hash of suffix and prefix blocks picks the test strings that may end there, and
their bytes are compared with the text's. All places of a batch of documents are searched side by side.

The items are a stated query set. They are taken in blocks of about ``block_bytes`` of text,
each small enough for the driver and a broadcast; every block searches all documents, and its hits are written before the next block is read.

Rows: null and empty texts have no words, null or empty items no test strings; items without an
id mark words but are not listed; repeated items count once; repeated documents are judged each.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import doc_key, doc_rows, text_steps, unused, written
from marquee.llm.words import LETTERS, Words, chain, gram_hashes, split_words, word_hashes

WINDOW = 10
BLOCK_WORDS = 2
BLOCK_BYTES = 8 << 20
_KEYS = ["doc_id", "doc_key", "text_key"]
_HITS = "doc_key long, text_key int, spans array<struct<begin:int,end:int>>, items array<string>"


class Length:
    """The test strings of ``n`` words: shift table, suffix and prefix filter, and the strings by suffix hash."""

    def __init__(self, n: int, strings: dict[bytes, set[str]]):
        self.n, self.block = n, min(BLOCK_WORDS, n)
        self.step = n - self.block + 1
        words = split_words(pa.array([s.decode() for s in strings], pa.large_string()), LETTERS)
        grams = gram_hashes(word_hashes(words), self.block)
        begin = words.first[:-1]
        self.bits = np.uint64(max(12, math.ceil(math.log2(len(strings) * self.step + 1)) + 5))
        self.shift = np.full(1 << int(self.bits), self.step, np.uint8 if self.step < 256 else np.int32)
        for back in range(self.step - 1, -1, -1):  # the nearer to the end, the smaller the shift
            self.shift[self.slot(grams[begin + n - self.block - back])] = back
        suffix, prefix = grams[begin + n - self.block], grams[begin]
        self.ends = np.zeros(1 << int(self.bits), bool)
        self.ends[self.slot(chain(prefix, suffix))] = True
        self.by_suffix: dict[int, dict[bytes, set[str]]] = defaultdict(dict)
        for key, (string, items) in zip(suffix.tolist(), strings.items()):
            self.by_suffix[key][string] = items

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> (np.uint64(64) - self.bits)).astype(np.int64)

    def ends_of(self, words: Words, grams: np.ndarray) -> np.ndarray:
        """Last words of all places where a test string may stand."""
        low = words.first[:-1] + self.n - 1
        counts = np.maximum(0, -((low - words.first[1:]) // self.step))
        text = np.repeat(np.arange(len(counts)), counts)
        at = low[text] + (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * self.step
        stop = np.minimum(at + self.step, words.first[1:][text])
        found = []
        while len(at):
            shift = self.shift[self.slot(grams[at - self.block + 1])]
            hit = at[shift == 0]
            if len(hit):
                ends = chain(grams[hit - self.n + 1], grams[hit - self.block + 1])
                found.append(hit[self.ends[self.slot(ends)]])
            at = at + np.maximum(shift, 1)
            more = at < stop
            at, stop = at[more], stop[more]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


class Patterns:
    """The test strings of some items."""

    def __init__(self, items: Iterable[tuple[int | None, str | None]], window: int):
        strings: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        items = list(items)
        words = split_words(pa.array([text for _, text in items], pa.large_string()), LETTERS, lower=True)
        for (item, _), low, high in zip(items, words.first[:-1].tolist(), words.first[1:].tolist()):
            size = min(window, high - low)
            for i in range(low, high - size + 1 if size else low):
                strings[size][words.span(i, i + size)] |= set() if item is None else {str(item)}
        self.lengths = [Length(n, dict(some)) for n, some in strings.items()]

    def search(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
        """Of each text: words, disjoint spans of hit words, ids of the items found."""
        words = split_words(texts, LETTERS, lower=True)
        hashes = word_hashes(words)
        edge = np.zeros(len(hashes) + 1, np.int32)
        items: dict[int, set[str]] = defaultdict(set)
        for length in self.lengths:
            grams = gram_hashes(hashes, length.block)
            ends = length.ends_of(words, grams)
            suffixes = grams[ends - length.block + 1].tolist()
            rows = (np.searchsorted(words.first, ends, "right") - 1).tolist()
            for end, suffix, row in zip(ends.tolist(), suffixes, rows):
                of = length.by_suffix.get(suffix, {}).get(words.span(end - length.n + 1, end + 1))
                if of is not None:
                    edge[end - length.n + 1] += 1
                    edge[end + 1] -= 1
                    items[row] |= of
        hit = np.zeros(len(hashes) + 2, bool)
        hit[1:-1] = np.cumsum(edge)[:-1] > 0
        spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
        begin, end = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:])
        for a, b, row in zip(begin.tolist(), end.tolist(), (np.searchsorted(words.first, begin, "right") - 1).tolist()):
            while a < b:  # hits that touch across a text's end are two
                stop = min(b, int(words.first[row + 1]))
                if stop > a:
                    spans[row].append((a - int(words.first[row]), stop - int(words.first[row])))
                a, row = stop, row + 1
        return np.diff(words.first), spans, [sorted(items.get(i, ())) for i in range(len(texts))]


def pattern_blocks(items: DataFrame, window: int, id_col: str, text_col: str, block_bytes: int) -> Iterator[Patterns]:
    """The query set block by block; only one block is on the driver at a time."""
    chosen = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for block in range(blocks):
        part = chosen if blocks == 1 else chosen.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield Patterns([(row.item, row.text) for row in part.toLocalIterator()], window)


def _span_array(spans: list[list[tuple[int, int]]]) -> pa.Array:
    rows = [[{"begin": a, "end": b} for a, b in some] for some in spans]
    return pa.array(rows, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))


def hits(
    rows: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_key, text_key, spans, items`` of the rows ``doc_key, text_key, text`` in which test strings stand, for each block that finds some.

    The hits of a block are written, and its tables given up, before the next one is read.
    """
    context, found = rows.sparkSession.sparkContext, []
    for patterns in pattern_blocks(items, window, item_col, item_text_col, block_bytes):
        shared = context.broadcast(patterns)
        del patterns

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in text_steps(batches):
                _, spans, names = shared.value.search(batch.column("text"))
                some = [i for i, own in enumerate(spans) if own]
                keys = batch.select(["doc_key", "text_key"]).take(pa.array(some, pa.int64()))
                columns = [*keys.columns, _span_array([spans[i] for i in some]), pa.array([names[i] for i in some], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_key", "text_key", "spans", "items"])

        found.append(written(rows.select("doc_key", "text_key", "text").mapInArrow(run, _HITS), "hits"))
        shared.destroy()
    return functools.reduce(DataFrame.union, found)


def find(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every document: spans of hit words, which of several blocks may overlap, and ids of the items found, sorted as strings."""
    rows = doc_rows(docs, id_col, text_col)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            n = np.diff(split_words(batch.column("text"), LETTERS, lower=True).first)
            yield pa.RecordBatch.from_arrays([*batch.select(_KEYS).columns, pa.array(n, pa.int64())], [*_KEYS, "n_words"])

    counted = rows.mapInArrow(count, "doc_id long, doc_key long, text_key int, n_words long")
    # Repeated rows bring equal hits, which count once.
    of_text = hits(rows, items, window, item_col, item_text_col, block_bytes).groupBy("doc_key", "text_key").agg(
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    none = [F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("spans", "array<struct<begin:int,end:int>>"), ("items", "array<string>"))]
    return counted.join(of_text, ["doc_key", "text_key"], "left").select("doc_id", "n_words", *none)


def hit_words(spans: str) -> Column:
    """The number of words under sorted spans, which may overlap."""
    step = "(a, s) -> named_struct('n', a.n + greatest(0, s.end - greatest(s.begin, a.upto)), 'upto', greatest(a.upto, s.end))"
    return F.expr(f"aggregate({spans}, named_struct('n', 0, 'upto', 0), {step}).n").cast("long")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find(docs, benchmark)
    n_hit = hit_words("spans")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all their columns, in which no test string stands."""
    key, text = unused(docs, "doc_key"), unused(docs, "text_key")
    found = hits(doc_rows(docs), benchmark, window, block_bytes=block_bytes).select("doc_key", "text_key").distinct()
    keyed = docs.withColumns({key: doc_key(), text: F.hash("text")})
    return keyed.join(found.toDF(key, text), [key, text], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

"""Byte-level BPE: overlapping chunks of long texts, stitched, encoded in parallel; and decoding.

A text of up to ``chunk_chars`` characters is one piece. A longer one is cut into
chunks that overlap. Each chunk is split by the pre-token pattern on its own; two
neighbours are stitched at a place in their overlap where both have a pre-token
boundary, since from there on the pattern sees the same characters. The pieces
between the stitches are encoded apart and their ids put behind one another.
A text with an overlap that has no common boundary (one word longer than the
overlap, say) is encoded as a single piece, so the ids are always those of the whole text.

Rows: null and empty texts have no ids; repeated rows are encoded each; null ids stay null.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import doc_rows, text_steps

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 10
# Characters from the start of a pre-token that its pattern may look at, beyond the pre-token itself.
LOOK_AHEAD = 3


class Tokenizer:
    """A vocabulary of ranks; built once in each Python worker that gets it by broadcast."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks, self.pattern = ranks, pattern

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern}

    @functools.cached_property
    def by_bytes(self) -> dict[bytes, int]:
        lines = (line.split() for line in self.ranks.splitlines() if line)
        return {base64.b64decode(token): int(rank) for token, rank in lines}

    @functools.cached_property
    def encoding(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.by_bytes, special_tokens={})

    @functools.cached_property
    def token_bytes(self) -> list[bytes]:
        out = [b""] * (max(self.by_bytes.values()) + 1)
        for token, rank in self.by_bytes.items():
            out[rank] = token
        return out

    def decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    @functools.cached_property
    def decimals(self) -> list[bytes]:
        return [b"%d" % rank for rank in range(len(self.token_bytes))]

    @functools.cached_property
    def pre_token(self) -> regex.Pattern:
        return regex.compile(self.pattern)


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """The vocabulary in a rank file that the driver can open; tasks get its bytes by broadcast."""
    with open(path, "rb") as file:
        return Tokenizer(file.read(), pattern)


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def boundaries(pattern: regex.Pattern, chunk: str, start: int, is_last: bool) -> list[int]:
    """Where pre-tokens of the chunk begin, as places in the text; only those that
    characters beyond the chunk cannot move. Places between an ASCII letter and a space come first."""
    size, found = len(chunk), []
    for match in pattern.finditer(chunk):
        low, high = match.span()
        found.append(low)
        if not is_last and (high >= size or low + LOOK_AHEAD > size):
            break
    plain = [i for i in found if 0 < i < size - 1 and chunk[i] == " " and chunk[i - 1 : i + 2].isascii() and chunk[i - 1].isalnum()]
    chosen = set(plain)
    return [start + i for i in plain] + [start + i for i in found if i not in chosen]


def _long_pieces(rows: DataFrame, shared, chunk_chars: int, overlap: int) -> DataFrame:
    """``doc_key, text_key, piece, text`` of the texts longer than a chunk."""
    keys = ["doc_key", "text_key"]
    size = F.char_length("text")
    chunks = (
        rows.where(size > chunk_chars)
        .select(*keys, "text", size.alias("size"), F.posexplode(F.sequence(F.lit(0), size - 1, F.lit(chunk_chars))).alias("chunk", "at"))
        .select(*keys, "chunk", "at", "size", F.substring("text", F.col("at") + 1, F.lit(chunk_chars + overlap)).alias("text"))
        # each chunk once, on any executor; repeated rows share theirs
        .groupBy(*keys, "chunk")
        .agg(F.min("at").alias("at"), F.min("size").alias("size"), F.min("text").alias("text"))
    )

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = shared.value.pre_token
        for batch in text_steps(batches):
            heads, tails = [], []
            for text, at, full in zip(*(batch.column(c).to_pylist() for c in ("text", "at", "size"))):
                found = boundaries(pattern, text, at, at + len(text) >= full)
                heads.append([i for i in found if i < at + overlap and i > at])
                tails.append([i for i in found if i > at + chunk_chars])
            for name, places in (("head", heads), ("tail", tails)):
                batch = batch.append_column(name, pa.array(places, pa.list_(pa.int32())))
            yield batch

    schema = "doc_key long, text_key int, chunk int, at int, size int, text string, head array<int>, tail array<int>"
    order = Window.partitionBy(*keys).orderBy("chunk")
    stitched = (
        chunks.mapInArrow(split, schema)
        .withColumn("before", F.lag("tail").over(order))
        .withColumn("stitch", F.when(F.col("chunk") == 0, 0).otherwise(F.try_element_at(F.array_intersect("before", "head"), F.lit(1))))
        .withColumn("until", F.lead("stitch").over(order))
        .withColumn("broken", F.max(F.col("stitch").isNull()).over(Window.partitionBy(*keys)))
    )
    sound = stitched.where(~F.col("broken")).select(
        *keys,
        F.col("chunk").alias("piece"),
        F.expr("substring(text, stitch - at + 1, coalesce(until, size) - stitch)").alias("text"),
    )
    whole = (
        stitched.where("broken")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("chunk", F.expr(f"left(text, {chunk_chars})").alias("own")))).alias("parts"))
        .select(*keys, F.lit(0).alias("piece"), F.array_join("parts.own", "").alias("text"))
    )
    return sound.union(whole)


def _ids(_: Tokenizer, ids: list[np.ndarray]) -> list[pa.Array]:
    return [_id_lists(ids)]


def _digests(vocabulary: Tokenizer, ids: list[np.ndarray]) -> list[pa.Array]:
    counts, ids_sha, data_sha = [], [], []
    for some in ids:
        counts.append(len(some))
        listed = some.tolist()
        ids_sha.append(hashlib.sha256(b",".join(map(vocabulary.decimals.__getitem__, listed))).hexdigest())
        data_sha.append(hashlib.sha256(vocabulary.decoded(listed)).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(data_sha, pa.string())]


def _encoded(docs: DataFrame, vocabulary: Tokenizer, columns, schema: str, id_col: str, text_col: str, chunk_chars: int, overlap: int) -> DataFrame:
    """``doc_id`` and what ``columns`` makes of the ids of each row, in the task that has them."""
    rows = doc_rows(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["doc_id", *(field.split()[0] for field in schema.split(", "))]
    keys = ["doc_key", "text_key"]

    def encoded(batch: pa.RecordBatch) -> list[np.ndarray]:
        encoding = shared.value.encoding
        return [encoding.encode_to_numpy(text, disallowed_special=()) for text in batch.column("text").to_pylist()]

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns(shared.value, encoded(batch))], names)

    def piecewise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            own = [batch.column(c) for c in (*keys, "piece")]
            yield pa.RecordBatch.from_arrays([*own, _id_lists(encoded(batch))], [*keys, "piece", "ids"])

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns(shared.value, list(_arrays(batch.column("ids"))))], names)

    schema = f"doc_id long, {schema}"
    short = rows.where(F.char_length("text") <= chunk_chars).select("doc_id", "text").mapInArrow(whole, schema)
    long = (
        _long_pieces(rows, shared, chunk_chars, overlap)
        .mapInArrow(piecewise, "doc_key long, text_key int, piece int, ids array<int>")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))
        .select(*keys, F.flatten("pieces.ids").alias("ids"))
    )
    long_rows = rows.where(F.char_length("text") > chunk_chars).select("doc_id", *keys)
    return short.union(long_rows.join(long, keys).select("doc_id", "ids").mapInArrow(joined, schema))


def _arrays(column: pa.Array) -> Iterator[np.ndarray]:
    bounds = column.offsets.to_numpy()
    values = column.values.to_numpy()
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield values[low:high]


def encode(
    docs: DataFrame,
    vocabulary: Tokenizer,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """``doc_id, ids array<int>`` of every row."""
    return _encoded(docs, vocabulary, _ids, "ids array<int>", id_col, text_col, chunk_chars, overlap)


def decode(encoded: DataFrame, vocabulary: Tokenizer) -> DataFrame:
    """``doc_id, ids, data binary``: the raw bytes of the ids behind one another."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [shared.value.decoded(ids.tolist()) for ids in _arrays(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, data binary")


def digest(
    docs: DataFrame,
    vocabulary: Tokenizer,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Per document its number of ids and the digests of the ids and of the bytes they decode to.

    Encoding and decoding as above, in one pass, so that the ids need not leave their task.
    """
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, vocabulary, _digests, schema, id_col, text_col, chunk_chars, overlap)

"""Conversation prefix trie: adaptive radix trees over turn ids, a tree a slice of the sorted conversations.

A turn is known by a 16-byte digest of role and text, read as a big-endian number; a conversation is the key of its turns' ids.
Equal conversations are one key: their ids are sorted by range, joined to text in chunks where they lie, and the chunks are
hashed in their order, so a group of any size is streamed, never held. Different keys are sorted by range and
read in slices of ``SLICE_BYTES``, each made one tree (:mod:`marquee.llm.radix_tree`). Trie nodes within a slice are
whole; those on the paths of its first and last key are joined with the slices beside it, ``FAN`` tasks at a time, so
no task holds more than ``FAN`` times two paths. Nodes whose parent was open learn its least member by a join, salted since
one parent may have any share of all nodes.

A node: the least id of the conversations that begin with it (its members), its depth, its parent's least id, members,
children, childless nodes in its subtree, tokens saved in its subtree if each turn is stored once, and a hash of the members that end in it.

Rows: a null role or text is empty; null turns come first; turns of equal number (repeated rows too) stand in the order of their digests,
each a turn of its own; rows without conversation id belong to none and are not read; a text may have any length, it travels as its digest; a
conversation's digests, 16 bytes a turn, are one value, up to 100 million turns; a table without conversations has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import bound_batches, written
from marquee.llm.radix_tree import Closed, Open, settle, slice_nodes

WORD = r"[^\x20\x09-\x0D]+"
# Bytes of keys in one tree.
SLICE_BYTES = 1 << 20
# Slices joined in one task.
FAN = 16
SALTS = 32

_NODES = "part long, node binary, parent binary, least long, depth long, above long, n long, children long, leaves long, saved long, ends string, words long, on_first boolean, on_last boolean"
_ARROW = pa.schema(
    [
        ("part", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("least", pa.int64()), ("depth", pa.int64()), ("above", pa.int64()), ("n", pa.int64()),
        ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()), ("words", pa.int64()), ("on_first", pa.bool_()), ("on_last", pa.bool_()),
    ]
)


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns`` of each conversation: its turns' digests and words, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), digest.alias("id"), F.regexp_count(text, F.lit(WORD)).alias("words")
        ).alias("t"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuild(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """``conv_id, key, words``: the conversations as branches of the first of each family.

    Conversation c begins with the first h turns of the conversation that has the greatest multiple of ``family`` up to it, or those it has, and goes
    on with its own turns after its first h; h is the CRC-32 of the decimal id modulo ``most``.
    """
    own = written(turns(conversations), "turns")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int")
    head = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    heads = own.where(F.pmod("conv_id", F.lit(family)) == 0).select(F.col("conv_id").alias("head"), F.slice("turns", 1, most - 1).alias("first"))
    joined = own.withColumns({"h": h, "head": head}).join(heads, "head", "left")
    whole = F.concat(
        F.slice(F.coalesce("first", F.slice("turns", 1, 0)), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns")),
    )
    rebuilt = joined.select("conv_id", whole.alias("turns"))
    return rebuilt.select("conv_id", F.unhex(F.array_join("turns.id", "")).alias("key"), F.col("turns.words").alias("words"))


def plain(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, words`` of the conversations as they are."""
    return turns(conversations).select("conv_id", F.unhex(F.array_join("turns.id", "")).alias("key"), F.col("turns.words").alias("words"))


def ending(keyed: DataFrame) -> DataFrame:
    """``least, n, ends`` of each different key: its least conversation, how many there are, and the hash of their ids."""

    def chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names, ids = batch.column("name"), batch.column("conv_id")
            new = np.ones(len(ids), bool)
            new[1:] = pc.not_equal(names.slice(1), names.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(new)
            bounds = pa.array(np.append(heads, len(ids)), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(bounds, ids.cast(pa.string())), ",")
            columns = [names.take(pa.array(heads)), ids.take(pa.array(heads)), pa.array(np.diff(heads, append=len(ids)), pa.int64()), joined]
            yield pa.RecordBatch.from_arrays(columns, ["name", "first", "n", "ids"])

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, least, n, state = None, None, 0, None
        done: list[dict[str, Any]] = []
        schema = pa.schema([("least", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
        for batch in batches:
            for row in batch.to_pylist():
                if row["name"] != name:
                    if state is not None:
                        done.append({"least": least, "n": n, "ends": state.hexdigest()})
                    name, least, n, state = row["name"], row["first"], 0, hashlib.sha256()
                elif n:
                    state.update(b",")
                state.update(row["ids"].encode())
                n += row["n"]
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"least": least, "n": n, "ends": state.hexdigest()}], schema)

    bound_batches(keyed.sparkSession)
    named = keyed.select(F.substring(F.unhex(F.sha2("key", 256)), 1, 16).alias("name"), "conv_id")
    placed = named.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    chunks = placed.mapInArrow(chunk, "name binary, first long, n long, ids string")
    return chunks.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashed, "least long, n long, ends string")


def _batch(closed: list[Closed], opened: list[Open], part: int) -> pa.RecordBatch:
    rows = [{"part": None, **c._asdict()} for c in closed] + [{"part": part, **o._asdict()} for o in opened]
    return pa.RecordBatch.from_pylist(rows, _ARROW)


def _read(batch: pa.RecordBatch | pa.Table) -> list[Open]:
    return [Open(*(row[f] for f in Open._fields)) for row in batch.select(Open._fields).to_pylist()]


def slices(keys: DataFrame) -> DataFrame:
    """Closed nodes, and for each task the open ones with its number as ``part``, of ``key, words, least, n, ends``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[Open] = []
        for batch in batches:
            low = 0
            sizes = np.cumsum(pc.binary_length(batch.column("key")).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + SLICE_BYTES, "right")))
                part = batch.slice(low, high - low)
                closed, opened = slice_nodes(*(part.column(c).to_pylist() for c in ("key", "least", "n", "ends", "words")))
                inside, rest = settle([rest, opened]) if rest else ([], opened)
                yield _batch(closed + inside, [], 0)
                low = high
        yield _batch([], rest, TaskContext.get().partitionId())

    return keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, _NODES)


def _settled(opened: DataFrame, whole: bool) -> DataFrame:
    """The open nodes of ``FAN`` parts each, joined."""

    def run(key: tuple[Any, ...], group: pa.Table) -> pa.Table:
        parts: dict[int, list[Open]] = {}
        for part, node in zip(group.column("part").to_pylist(), _read(group)):
            parts.setdefault(part, []).append(node)
        closed, still = settle([parts[p] for p in sorted(parts)], whole)
        return pa.Table.from_batches([_batch(closed, still, key[0].as_py())])

    return opened.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInArrow(run, _NODES)


def trie(keyed: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of each node of ``conv_id, key, words``."""
    keyed = written(keyed, "keys")
    found = ending(keyed)
    different = found.join(keyed, found["least"] == keyed["conv_id"]).select("key", "words", "least", "n", "ends")
    nodes = written(slices(different), "nodes")
    opened = nodes.where("part is not null")
    last = opened.agg(F.max("part")).first()[0]
    inner = nodes.where("part is null and above is not null")
    waiting = nodes.where("part is null and above is null")
    if last is not None:
        rounds = []
        while True:
            whole = last < FAN
            joined = written(_settled(opened, whole), "joined")
            rounds.append(joined.where("part is null"))
            if whole:
                break
            opened, last = joined.where("part is not null"), last // FAN
        for more in rounds:
            waiting = waiting.union(more)
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        parents = waiting.where("node is not null").select(F.col("node").alias("parent"), F.col("least").alias("of_parent"), salts)
        salted = waiting.withColumn("salt", F.pmod(F.xxhash64("least"), F.lit(SALTS)).cast("int"))
        known = salted.join(parents, ["parent", "salt"], "left").withColumn("above", F.col("of_parent")).select(*nodes.columns)
        inner = inner.union(known)
    return inner.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.col("above").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    return trie(rebuild(conversations))

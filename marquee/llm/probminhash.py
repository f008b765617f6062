"""Near-duplicate search by ProbMinHash, banding and exact verification.

A text is its word runs (shingles) of ``shingle`` lower-cased words, each weighing
1 + log2 of how often it stands. Two texts are linked if their probability Jaccard similarity

    J(x, y) = sum over i in both of 1 / sum over j of max(x_j / x_i, y_j / y_i)

is ``threshold`` or more; with equal weights it is the ordinary Jaccard similarity.

Signature: every shingle sends a Poisson process of arrivals, its rate the weight, each
arrival into a random register; a register keeps the shingle that arrived first. A
shingle stops as soon as its next arrival comes later than all registers of its text are
filled. Registers of two texts agree with probability J.

Search: texts of equal words are one node, known by the least document id. Nodes that agree in all
registers of a band meet in its bucket. First every node is compared with the bucket's
centre, the node whose buckets are largest, which is how the original of a group of copies stands out; then, as links make
classes, the classes of a bucket are compared by their centres. These two steps only save work: they skip pairs whose signatures agree
``DEVIATIONS`` standard deviations less than expected at the threshold.

Last, the nodes of buckets that still hold several classes go through a prefix index, which loses no pair. Their shingles have one
order, rarest first. With total weight X, of it U of shingles the other text lacks, n shingles, largest weight m, and primes for the other text,

    J <= (X - U) / (X + U' / m'),  and the same with the texts exchanged.

If their first common shingle in that order has p shingles of weight W before it in one text and p', W' in the other, at most
c = min(n - p, n' - p') are common, so U >= max(W, n - c) and likewise U'. A pair that can reach the threshold thus meets at a shingle near the front
of both texts: they are joined there, and only those that the bound lets through are compared exactly. What a copy has of its own comes first in its order, and
copies with many edits of their own meet no other at all, however many there are. Shingles are dealt by the sizes of text and partner too (steps of
``SIZE_STEP``) and by whether weights differ from 1, as each gives a shorter front. With 24 bands of 4
registers a pair at 0.8 shares a bucket with probability 1 - 3e-6; nothing else is left to chance.

Rows: a null, empty or blank text has no words and is a class of its own, one for each id; a text of fewer
words than a shingle is one shingle; rows that agree in id and text are one document, and other texts of an id documents of
their own; a row without id is known by the hash of its text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import doc_key, doc_rows, text_steps, unused, written
from marquee.llm.components import components
from marquee.llm.words import NOT_SPACE, Words, chain, gram_hashes, mix, split_words, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
BAND_ROWS = 4
# Registers of a signature; the bands use the first ones, estimates all.
REGISTERS = 192
# Signatures that agree less than a pair at the threshold does, by so many standard deviations, are not compared exactly.
DEVIATIONS = 5.0
# Sizes of texts within this factor are looked up together in the prefix index.
SIZE_STEP = 1.05
# Room for the rounding of sums of weights.
EPSILON = 1e-9
_GOLDEN = 0x9E3779B97F4A7C15


def _step(n: int) -> np.uint64:
    return np.uint64(n * _GOLDEN % 2**64)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and weight of each different shingle of each text, by text and hash."""
    hashes = word_hashes(words)
    sizes = np.diff(words.first)
    counts = np.maximum(sizes - n + 1, 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    at = words.first[text] + np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    value = gram_hashes(hashes, n)[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    if len(short):
        own = []
        for i in short.tolist():
            word = hashes[words.first[i] : words.first[i + 1]]
            own.append(gram_hashes(word, len(word))[0])
        text, value = np.concatenate([text, short]), np.concatenate([value, np.array(own, np.uint64)])
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    heads = np.flatnonzero(new)
    often = np.diff(heads, append=len(text))
    return text[heads], value[heads], 1 + np.log2(often)


def signatures(text: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """A row for each text: the shingle that came first in each register."""
    when = np.full(texts * registers, np.inf)
    who = np.zeros(texts * registers, np.uint64)
    last = np.full(texts, np.inf)
    time = np.zeros(len(text))
    arrival = 0
    while len(text):
        arrival += 1
        draw = mix(value + _step(2 * arrival))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        alive = time < last[text]
        if not alive.all():
            text, value, weight, time = text[alive], value[alive], weight[alive], time[alive]
        place = mix(value + _step(2 * arrival + 1)) >> np.uint64(32)
        slot = text * registers + ((place * np.uint64(registers)) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(when, slot, time)
        won = time == when[slot]
        who[slot[won]] = value[won]
        last = when.reshape(texts, registers).max(axis=1)
        alive = time < last[text]
        text, value, weight, time = text[alive], value[alive], weight[alive], time[alive]
    return who.reshape(texts, registers)


def _bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = mix(np.arange(1, bands + 1, dtype=np.uint64))[None, :].repeat(len(signature), 0)
    for r in range(rows):
        out = chain(out, signature[:, r : bands * rows : rows])
    return out.view(np.int64)


def sketch(docs: DataFrame, shingle: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_key, part, content, bands, signature``: a hash of the text, a digest of the words, the band hashes, and 16 bits of each register."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            words = split_words(batch.column("text"), NOT_SPACE, lower=True)
            n = batch.num_rows
            signature = signatures(*shingles(words, shingle), n, REGISTERS)
            content = [
                hashlib.blake2b(words.span(a, b), digest_size=16).digest() if b > a else None
                for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())
            ]
            flat = pa.array(_bands(signature, bands, rows).reshape(-1))
            short = mix(signature)
            bits = short.astype("<u2").tobytes()
            width = 2 * REGISTERS
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_key"),
                    batch.column("part"),
                    pa.array(content, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), flat),
                    pa.array([bits[i * width : (i + 1) * width] for i in range(n)], pa.binary()),
                ],
                ["doc_key", "part", "content", "bands", "signature"],
            )

    schema = "doc_key long, part long, content binary, bands array<long>, signature binary"
    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def _part(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return doc_rows(docs, id_col, text_col).select("doc_key", _part(F.col("text")).alias("part"), "text")


def _numbered(sketches: DataFrame) -> DataFrame:
    """``content, node, doc_key, part, worded`` of every different text: its number, and the least row that has it.

    The number is the least id. Of several texts whose least id is the same one keeps it, and the others get numbers beyond all ids.
    A text without words is one of its own for each id.
    """
    content = F.coalesce("content", F.concat(F.lit("no words "), F.col("doc_key").cast("string")).cast("binary"))
    heads = sketches.groupBy(content.alias("content"), F.col("content").isNotNull().alias("worded")).agg(F.min(F.struct("doc_key", "part")).alias("head"))
    heads = heads.select("content", "worded", "head.*")
    rank = F.row_number().over(Window.partitionBy("doc_key").orderBy(F.desc("worded"), "content"))
    beyond = F.xxhash64("doc_key", "content").bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    return heads.withColumn("node", F.when(rank == 1, F.col("doc_key")).otherwise(beyond))


def weights(texts: pa.Array, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shingles and their weights, of each text."""
    text, value, weight = shingles(split_words(texts, NOT_SPACE, lower=True), n)
    edges = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
    return [(value[a:b], weight[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    (in_x, w_x), (in_y, w_y) = x, y
    _, at_x, at_y = np.intersect1d(in_x, in_y, assume_unique=True, return_indices=True)
    if not len(at_x):
        return 0.0
    a, b = w_x[at_x], w_y[at_y]
    order = np.argsort(b / a)
    a, b = a[order], b[order]
    upto_a = w_x.sum() - a.sum() + np.cumsum(a)
    from_b = w_y.sum() - np.cumsum(b)
    return float((1 / (upto_a / a + from_b / b)).sum())


def _least_agreement(threshold: float) -> float:
    """The share of registers, compared by 16 bits, in which a pair at the threshold agrees at least."""
    expected = threshold + (1 - threshold) / 2**16
    return expected - DEVIATIONS * (expected * (1 - expected) / REGISTERS) ** 0.5


def _agreement(left: pa.Array, right: pa.Array, registers: int) -> np.ndarray:
    a, b = (np.frombuffer(b"".join(x.to_pylist()), "<u2").reshape(-1, registers) for x in (left, right))
    return (a == b).mean(axis=1)


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float, every: bool = False) -> DataFrame:
    """The pairs ``a, b`` that are similar enough, of those whose signatures do not rule it out, or of ``every`` pair."""
    least = 0.0 if every else _least_agreement(threshold)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches, "text_b", 1 << 20):
            width = len(batch.column("signature_a")[0].as_buffer()) // 2
            batch = batch.filter(pa.array(_agreement(batch.column("signature_a"), batch.column("signature_b"), width) >= least))
            if not batch.num_rows:
                continue
            column = batch.column("text_a").dictionary_encode()  # one node stands in many pairs
            left = weights(column.dictionary, shingle)
            right = weights(batch.column("text_b"), shingle)
            similar = [probability_jaccard(left[i], y) for i, y in zip(column.indices.to_pylist(), right)]
            keep = pa.array([s >= threshold for s in similar])
            yield batch.select(["a", "b"]).filter(keep)

    sides = [texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"), F.col("signature").alias(f"signature_{s}")) for s in "ab"]
    return pairs.join(sides[1], "b").join(sides[0], "a").mapInArrow(run, "a long, b long").distinct()


def _alike(pairs: DataFrame, signatures_of: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose signatures do not rule out the threshold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                width = len(batch.column("signature_a")[0].as_buffer()) // 2
                alike = _agreement(batch.column("signature_a"), batch.column("signature_b"), width)
                yield batch.select(["a", "b"]).filter(pa.array(alike >= _least_agreement(threshold)))

    sides = [signatures_of.select(F.col("node").alias(s), F.col("signature").alias(f"signature_{s}")) for s in "ab"]
    return pairs.join(sides[1], "b").join(sides[0], "a").mapInArrow(run, "a long, b long").distinct()


def _classed(crowded: DataFrame, roots: DataFrame) -> DataFrame:
    """``band, node, score, class, least`` of the buckets that hold several classes."""
    classed = crowded.join(roots, "node", "left").select("band", "node", "score", F.coalesce("root", "node").alias("class"))
    mixed = classed.groupBy("band").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least < most")
    return classed.join(mixed.select("band", "least"), "band")


def _centre() -> Column:
    """The node of most score, of equal ones the least id."""
    return -F.max(F.struct("score", (-F.col("node")).alias("minus")))["minus"]


def _crowded(banded: DataFrame) -> DataFrame:
    """``band, node, score`` of the buckets that hold several nodes; ``score`` is the size of all the node's buckets."""
    sizes = banded.groupBy("band").agg(F.count("*").alias("nodes")).where("nodes > 1")
    sized = written(banded.join(sizes, "band"), "buckets")
    scores = sized.groupBy("node").agg(F.sum("nodes").alias("score"))
    return written(sized.join(scores, "node").select("band", "node", "score"), "scored")


def _each(nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """``node, part, shingle, weight``: the shingles of each text of the nodes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            text, value, weight = shingles(split_words(batch.column("text"), NOT_SPACE, lower=True), shingle)
            row = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(row), batch.column("part").take(row), pa.array(value.view(np.int64)), pa.array(weight)],
                ["node", "part", "shingle", "weight"],
            )

    wanted = texts.join(nodes, "node", "left_semi").select("node", F.xxhash64("text").alias("part"), "text")
    return wanted.mapInArrow(run, "node long, part long, shingle long, weight double")


def _fronts(each: DataFrame, threshold: float) -> DataFrame:
    """``node, part, shingle, p, w, n, total, most``: the shingles before which a text has not yet more weight ``w``, of ``p`` shingles, than it may lack."""
    often = each.groupBy("shingle").agg(F.count("*").alias("texts"))
    text = Window.partitionBy("node", "part")
    before = text.orderBy("texts", "shingle")
    placed = each.join(often, "shingle").withColumns(
        {
            "p": F.row_number().over(before) - 1,
            "w": F.sum("weight").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight"),
            "n": F.count("*").over(text),
            "total": F.sum("weight").over(text),
            "most": F.max("weight").over(text),
        }
    )
    return placed.where(F.col("w") <= (1 - threshold) * F.col("total") + EPSILON).drop("texts", "weight")


def _met(fronts: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` of different ``class`` that may be similar enough, from :func:`_fronts` with the class of each node.

    The text of fewer shingles, of equal ones the lesser node, lies in the index and the other asks. Its partner has
    no fewer shingles, so the text of the index lacks p of them at least, and so much more the partner; a partner asks by size, and what it lacks
    is known from that size. Both facts count in full where the other's weights are all 1, else not at all.
    """
    rows = fronts.withColumns({"lacks": (1 - threshold) * F.col("total") + EPSILON, "heavy": F.col("most") > 1})
    log = F.lit(math.log(SIZE_STEP))
    kinds = F.array(F.lit(False), F.lit(True))
    index = rows.withColumn("size", F.floor(F.log("n") / log)).withColumn("other", F.explode(kinds))
    index = index.where(F.col("other") | (F.col("w") <= F.col("lacks") - threshold * F.col("p")))
    least = F.greatest(F.col("n") - F.col("lacks"), F.lit(1.0))
    sizes = F.sequence(F.floor(F.log(least) / log), F.floor(F.log("n") / log))
    asking = rows.withColumn("size", F.explode(sizes)).withColumn("other", F.explode(kinds))
    beyond = F.greatest(F.pow(F.lit(SIZE_STEP), F.col("size")) - F.lit(EPSILON) - F.col("n") + F.col("p"), F.lit(0.0))
    asking = asking.where(F.col("other") | (F.col("w") <= F.col("lacks") - threshold * beyond))

    common = "least(x.n - x.p, y.n - y.p)"
    u, v = (f"greatest({t}.w, {t}.n - {common})" for t in "xy")
    reach = " and ".join(
        f"{t}.total - {own} >= {threshold} * ({t}.total + {others} / {o}.most) - {EPSILON}" for t, own, o, others in (("x", u, "y", v), ("y", v, "x", u))
    )
    same = "x.shingle = y.shingle and x.size = y.size and x.heavy = y.other and x.other = y.heavy"
    order = "x.class != y.class and (x.n < y.n or x.n = y.n and x.node < y.node)"
    met = index.alias("x").join(asking.alias("y"), F.expr(f"{same} and {order} and {reach}"))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _joined(roots: DataFrame, pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float, every: bool = False) -> DataFrame:
    """The classes, joined where a pair is similar enough."""
    if pairs.isEmpty():
        return roots
    links = written(_verified(pairs, texts, shingle, threshold, every), "links")
    return roots if links.isEmpty() else components(links.union(roots.toDF("a", "b")))


def _classes(
    docs: DataFrame, threshold: float, shingle: int, bands: int, band_rows: int, id_col: str, text_col: str
) -> DataFrame:
    """``doc_key, part, class_id, leads`` of every different row; ``leads`` marks one row of each class."""
    if bands * band_rows > REGISTERS:
        raise ValueError(f"the bands ask for more than {REGISTERS} registers")
    sketches = written(sketch(docs, shingle, bands, band_rows, id_col, text_col), "sketches")
    numbers = written(_numbered(sketches), "numbers")
    heads = numbers.where("worded").select("node", "doc_key", "part")

    banded = sketches.join(heads, ["doc_key", "part"]).select("node", F.explode("bands").alias("band")).distinct()
    crowded = _crowded(banded)
    wanted = heads.join(crowded.select("node").distinct(), "node", "left_semi")
    signed = sketches.select("doc_key", "part", "signature").join(wanted, ["doc_key", "part"]).dropDuplicates(["node"])
    texts = _texts(docs, id_col, text_col).join(signed, ["doc_key", "part"]).select("node", "text", "signature")
    texts = written(texts.distinct(), "texts")

    led = crowded.join(crowded.groupBy("band").agg(_centre().alias("lead")), "band").where("node != lead")
    pairs = written(led.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct(), "pairs")
    roots = components(_verified(pairs, texts, shingle, threshold))

    mixed = _classed(crowded, roots)
    leads = mixed.where("class != least").groupBy("band", "class").agg(_centre().alias("b"))
    bases = mixed.where("class = least").groupBy("band").agg(_centre().alias("a"))
    pairs_by_class = leads.join(bases, "band").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = written(_alike(pairs_by_class.join(pairs, ["a", "b"], "left_anti"), texts, threshold), "pairs")
    roots = _joined(roots, more, texts, shingle, threshold)

    mixed = written(_classed(crowded, roots).select("node", "class").distinct(), "mixed")
    each = written(_each(mixed.select("node"), texts, shingle), "shingles")
    fronts = written(_fronts(each, threshold).join(mixed, "node"), "fronts")
    roots = _joined(roots, written(_met(fronts, threshold), "pairs"), texts, shingle, threshold, every=True)

    content = F.coalesce("content", F.concat(F.lit("no words "), F.col("doc_key").cast("string")).cast("binary"))
    rows = sketches.select("doc_key", "part", content.alias("content")).distinct()
    named = numbers.select("content", "node", F.col("doc_key").alias("head_key"), F.col("part").alias("head_part"))
    class_id = F.coalesce("root", "node")
    is_head = (F.col("doc_key") == F.col("head_key")) & (F.col("part") == F.col("head_part"))
    return rows.join(named, "content").join(roots, "node", "left").select(
        "doc_key", "part", class_id.alias("class_id"), (is_head & (class_id == F.col("node"))).alias("leads")
    )


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, doc_key, class_id`` of every row; ``class_id`` is the least id of those linked to it, directly or in steps.

    Where an id has several texts it names the class of one of them; a class that holds only others has a number beyond all ids.
    """
    classes = _classes(docs, threshold, shingle, bands, band_rows, id_col, text_col).select("doc_key", "part", "class_id")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), doc_key(id_col, text_col).alias("doc_key"), _part(F.col(text_col)).alias("part"))
    return rows.join(classes, ["doc_key", "part"], "left").select("doc_id", "doc_key", "class_id")


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "class_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents, all their columns: of each class the one of least id, of rows that agree in id and text one."""
    key, part, rank = (unused(docs, n) for n in ("doc_key", "part", "rank"))
    classes = _classes(docs, THRESHOLD, SHINGLE, BANDS, BAND_ROWS, "doc_id", "text")
    later = classes.where("not leads").select(F.col("doc_key").alias(key), F.col("part").alias(part))
    one = Window.partitionBy(key, part).orderBy(F.lit(0))
    kept = docs.withColumns({key: doc_key(), part: _part(F.col("text"))}).join(later, [key, part], "left_anti")
    return kept.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])

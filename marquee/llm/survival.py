"""Filter interaction audit: one 32-bit word a document says which sets of filters it survives.

Five filters have 32 subsets. Bit S of a document's word, its truth table over the subsets, is set if the document passes
every filter of S. Words are added up by positional popcounts: blocks of at most ``BLOCK`` words go through carry-save
adders (three words of one weight become one of that weight and one of twice it), which leaves bit planes; the planes
give, for each subset, how many of the block survive it. Sums over blocks are per part and label. All that is asked about
orders of filters follows from those 32 numbers: what a filter removes behind a set P is survivors(P) - survivors(P + filter).

A copy is a text that a smaller id of the whole table has too. Texts meet by digest; a digest is dealt over
``SALTS`` keys, each with its least id, before the least of all is taken, so a group of any size spreads over tasks.

Everything is DataFrame functions. Rows: a null text is empty, a null part is the empty string; a row without id has no smaller
id before it and none after it, and no labels; repeated rows are counted each, and are no copies of each other; several labels of one id count as set
if one of them is; labels without a document are not read. A table without rows has no parts and gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import written

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
FULL = SUBSETS - 1
# Words of a block; its counts need one bit plane more than this has bits.
BLOCK_BITS = 11
BLOCK = 1 << BLOCK_BITS
PLANES = BLOCK_BITS + 1
SALTS = 64
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "#$%&*|"


def text_failures(text: Column) -> dict[str, Column]:
    """What fails filters A to D: few words, few different words, many capitals, symbols."""
    words = F.array_remove(F.split(text, SPACES), "")
    n_chars = F.char_length(text)
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * (n_chars - F.char_length(F.translate(text, UPPER, ""))).cast("long") > 10 * n_chars,
        "D": F.char_length(F.translate(text, SYMBOLS, "")) < n_chars,
    }


def _mask(fails: dict[str, Column]) -> Column:
    """The filters that fail, as bits."""
    bits = [F.when(c, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0)) for name, c in fails.items()]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def mark_copies(rows: DataFrame, id_col: str, digest_col: str) -> DataFrame:
    """The rows with ``copy``: whether a smaller id holds the same digest."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy(digest_col, "salt").agg(F.min(id_col).alias("least"))
    firsts = parts.withColumn("least", F.min("least").over(Window.partitionBy(digest_col)))
    copy = F.coalesce(F.col(id_col) > F.col("least"), F.lit(False)).alias("copy")
    return salted.join(firsts, [digest_col, "salt"]).select(*rows.columns, copy)


def failing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id, part, fails`` of every row; bit i of ``fails`` stands for the i-th filter."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        _mask(text_failures(text)).alias("own"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    copies = mark_copies(written(rows, "failures"), "doc_id", "digest")
    return copies.select("doc_id", "part", F.col("own").bitwiseOR(_mask({"E": F.col("copy")})).alias("fails"))


def survival_word(fails: Column) -> Column:
    """Bit S is set if none of the filters S is among those that fail."""
    table = [sum(1 << s for s in range(SUBSETS) if not s & mask) for mask in range(SUBSETS)]
    signed = [word - (1 << 32) if word >> 31 else word for word in table]
    return F.element_at(F.array(*(F.lit(word) for word in signed)), fails + 1)


def _sum_and_carry(a: str, b: str, c: str) -> tuple[str, str]:
    """The full adder: three words of one weight."""
    return f"({a} ^ {b} ^ {c})", f"(({a} & {b}) | ({c} & ({a} ^ {b})))"


def planes(words: str) -> str:
    """SQL for the bit planes p0, p1, ... of an array of words: bit S of plane k is bit k of how many words hold bit S."""
    d = [f"coalesce(get({words}, i + {k}), 0)" for k in range(4)]
    p = [f"s.p{k}" for k in range(PLANES)]
    half, two_a = _sum_and_carry(p[0], d[0], d[1])
    out = [""] * PLANES
    out[0], two_b = _sum_and_carry(half, d[2], d[3])
    out[1], carry = _sum_and_carry(p[1], two_a, two_b)
    for k in range(2, PLANES):
        out[k], carry = f"({p[k]} ^ {carry})", f"({p[k]} & {carry})"
    start = ", ".join(f"'p{k}', 0" for k in range(PLANES))
    step = ", ".join(f"'p{k}', {plane}" for k, plane in enumerate(out))
    return f"aggregate(sequence(0, size({words}) - 1, 4), named_struct({start}), (s, i) -> named_struct({step}))"


def survivors(words: DataFrame, *keys: str) -> DataFrame:
    """``keys, subset, n``: how many of the ``word`` of each group hold each bit. The rows must be a written table."""
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    blocks = words.withColumn("block", block).groupBy(*keys, "block").agg(F.collect_list("word").alias("words"))
    added = blocks.select(*keys, F.expr(planes("words")).alias("planes"))
    of_subset = " + ".join(f"shiftleft(shiftright(planes.p{k}, subset) & 1, {k})" for k in range(PLANES))
    counts = F.expr(f"transform(sequence(0, {SUBSETS - 1}), subset -> {of_subset})")
    each = added.select(*keys, F.posexplode(counts).alias("subset", "n"))
    return each.groupBy(*keys, "subset").agg(F.sum("n").alias("n"))


def _steps() -> Column:
    """Every order of the filters, step by step: the filters before, as bits, and the one of the step."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            rows.append(f"named_struct('filter_order', '{''.join(order)}', 'step', {step}, 'filter', '{name}', 'before', {before}, 'bit', {bit})")
            before |= bit
    return F.expr(f"array({', '.join(rows)})")


def orders(counts: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, from ``part, subset, documents, good, toxic``."""
    by_subset = F.array_sort(F.collect_list(F.struct("subset", "documents", "good", "toxic")))
    rows = counts.groupBy("part").agg(by_subset.alias("s")).select("part", "s", F.explode(_steps()).alias("o")).select("part", "s", "o.*")

    def left(of: str, subset: Column) -> Column:
        return F.get("s", subset)[of]

    before, bit = F.col("before"), F.col("bit")
    after, alone, others = before.bitwiseOR(bit), bit, F.lit(FULL).bitwiseXOR(bit)
    stepped = rows.select(
        "part",
        "filter_order",
        "step",
        "filter",
        left("documents", after).alias("kept"),
        (left("documents", before) - left("documents", after)).alias("removed"),
        (left("documents", F.lit(0)) - left("documents", alone)).alias("fail"),
        (left("documents", others) - left("documents", F.lit(FULL))).alias("unique_fails"),
        (left("good", before) - left("good", after)).alias("good_lost"),
        (left("toxic", before) - left("toxic", after)).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return stepped.withColumns({"redundant": F.col("fail") - F.col("removed"), "shapley": shapley}).drop("fail")


def audit(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`orders` of documents ``doc_id, part, fails``, with the labels ``doc_id, quality, toxic``."""
    of_id = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = of_id.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    words = written(flagged.join(known, "doc_id", "left").select("part", *flags, survival_word(F.col("fails")).alias("word")), "words")
    n = F.col("n")
    counts = survivors(words, "part", "good", "toxic").groupBy("part", "subset").agg(
        F.sum("n").alias("documents"),
        F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )
    return orders(counts)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(failing(docs), labels).select(
        "part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )

"""Quality rules: thresholds that follow each language and source instead of fixed cutoffs.

Measures of a text are whole numbers (per thousand words or characters). Each measure has
one sketch per language and source: a histogram whose bins keep the five leading bits of a
value, so a quantile is exact below 32 and known to within 1/16 beyond. Sketches are merged by adding
bins: partial sums before the shuffle, groups to their language, and languages to the whole. The quantiles of a group of fewer than
``min_docs`` texts are blended with those of its language, its share being its texts of ``min_docs``; those of a small language, likewise, with those of all.

A text is rejected if a measure lies beyond

    median + fence * max(median - lower quartile, least spread)

(or, for the lower side of word length, as far below), so a group may hold up to half junk
before the junk moves its thresholds. Texts that fail the base rules (under 50 words, or
over half of the words in repeated three-word windows) are rejected outright and do not enter the sketches.

Everything is DataFrame functions. Rows: a null or empty text has no words and fails the base rules; null
language or source is a group like any other; repeated rows are judged each; null ids stay null.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import unused, written

# Copies of the thresholds that rows of one group are dealt to, where the thresholds are too many to broadcast.
SALTS = 32

MIN_WORDS = 50
REPEAT_PERCENT = 50
MIN_DOCS = 100
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
LEADING_BITS = 5


class Fence(NamedTuple):
    """How far from the median a measure may lie: ``times`` the spread, which counts as ``least`` at least."""

    times: int
    least: int
    below: bool = False


# Per thousand: symbols of word characters, lines repeated of words, words in repeated windows of words;
# word length in hundredths of a character.
FENCES = {
    "symbols": Fence(6, 10),
    "dup_lines": Fence(6, 10),
    "repeats": Fence(6, 75),
    "word_length": Fence(5, 60, below=True),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_base(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows, or their columns ``keep``, with the base measures and ``base_failed``.

    They are written: a filter behind them would be pushed below the measures, which would then be taken word by word again.
    """
    return written(_measured(docs, text_col).select(*(docs.columns if keep is None else keep), *BASE, "base_failed"), "measured")


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    names = {n: unused(docs, n) for n in ("qr_text", "qr_words", "qr_windows", "qr_sorted", "qr_repeated")}
    text, words, grams, ordered, repeated = names.values()
    t = F.col(text)
    first = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    lines = F.filter(F.split(t, "\n"), lambda line: F.translate(line, SPACE_CHARS, "") != "")
    solid = F.char_length(F.translate(t, SPACE_CHARS, ""))
    counted = first.withColumns(
        {
            words: F.transform(F.array_remove(F.split(t, SPACES), ""), lambda w: F.xxhash64(w)),
            "word_chars": solid.cast("long"),
            "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        }
    ).drop(text)
    # Three-word windows are told apart by 64-bit hashes within one text.
    w = F.col(words)
    window = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
    )
    windowed = counted.withColumn("n_words", F.size(w).cast("long")).withColumn(grams, window).drop(words)
    g = F.col(grams)
    placed = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    none = F.lit(None).cast("array<struct<x:bigint,i:int>>")
    sorted_ = windowed.withColumn(ordered, F.when(F.size(F.array_distinct(g)) < F.size(g), placed).otherwise(none)).drop(grams)
    o = F.col(ordered)
    # places of windows that have an equal neighbour in the order
    twice = F.transform(
        o,
        lambda s, j: F.when((s["x"] == F.get(o, j - 1)["x"]) | (s["x"] == F.get(o, j + 1)["x"]), s["i"]),
    )
    placed_twice = sorted_.withColumn(repeated, F.array_sort(F.array_compact(twice))).drop(ordered)
    r = F.col(repeated)
    # each window covers three words, or as many as lie before the next one
    covered = F.aggregate(
        F.transform(r, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(r, j + 1) - i, F.lit(3)))), F.lit(0).cast("long"), lambda a, n: a + n
    )
    measured = placed_twice.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(repeated)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def _per(a: str, b: str, scale: int) -> Column:
    return F.expr(f"{scale} * {a} div greatest({b}, 1)")


def measures() -> dict[str, Column]:
    return {
        "symbols": _per("n_symbols", "word_chars", 1000),
        "dup_lines": _per("n_dup_lines", "n_words", 1000),
        "repeats": _per("n_repeat_words", "n_words", 1000),
        "word_length": _per("word_chars", "n_words", 100),
    }


def bin_of(value: Column) -> Column:
    """The lower end of the bin: the value's leading bits, the rest zero."""
    drop = F.greatest(F.length(F.bin(value)) - LEADING_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(base: DataFrame) -> DataFrame:
    """``lang, source, measure, bin, n``: the bins of every group's sketches."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bin_of(c).alias("bin")) for m, c in measures().items())))
    return (
        base.where("not base_failed")
        .select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), each.alias("m"))
        .groupBy("lang", "source", "m.measure", "m.bin")
        .agg(F.count("*").alias("n"))
    )


def merge(bins: DataFrame, *keys: str) -> DataFrame:
    """Sketches added up to coarser groups."""
    return bins.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def quartiles(bins: DataFrame, *keys: str) -> DataFrame:
    """``docs, lower, median`` of each sketch: the bins that hold the lowest rank of at least a quarter, and a half."""
    held = bins.groupBy(*keys, "measure").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("docs"))

    def at(parts: int) -> Column:
        step = f"(a, b) -> named_struct('seen', a.seen + b.n, 'bin', if({parts} * a.seen < docs, b.bin, a.bin))"
        return F.expr(f"aggregate(bins, named_struct('seen', cast(0 as bigint), 'bin', cast(0 as bigint)), {step}).bin")

    return held.select(*keys, "measure", "docs", at(4).alias("lower"), at(2).alias("median"))


def thresholds(bins: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source`` and for each measure its highest allowed value, and for those fenced on both sides the lowest."""
    by_group = quartiles(bins, "lang", "source")
    by_lang = quartiles(merge(bins, "lang"), "lang").toDF("lang", "measure", "lang_docs", "lang_lower", "lang_median")
    overall = quartiles(merge(bins)).toDF("measure", "all_docs", "all_lower", "all_median")
    joined = by_group.join(by_lang, ["lang", "measure"]).join(overall, "measure")

    def blended(name: str) -> Column:
        def mix(own: str, docs: str, wider: Column) -> Column:
            share = F.least(docs, F.lit(min_docs))
            return F.call_function("div", share * F.col(own) + (min_docs - share) * wider, F.lit(min_docs))

        return mix(name, "docs", mix(f"lang_{name}", "lang_docs", F.col(f"all_{name}")))

    picked = joined.select("lang", "source", "measure", blended("lower").alias("lower"), blended("median").alias("median"))
    columns = []
    for name, fence in FENCES.items():
        reach = fence.times * F.greatest(F.col("median") - F.col("lower"), F.lit(fence.least))
        mine = F.col("measure") == name
        columns.append(F.max(F.when(mine, F.col("median") + reach)).alias(f"{name}_most"))
        if fence.below:
            columns.append(F.max(F.when(mine, F.col("median") - reach)).alias(f"{name}_least"))
    return picked.groupBy("lang", "source").agg(*columns)


def judge(base: DataFrame, limits: DataFrame) -> DataFrame:
    """The rows with ``kept``; a group without thresholds holds only texts that failed the base rules.

    The thresholds are written, so their size is known when the join is planned: small ones are broadcast, others are
    joined by group and salt, so that a large group spreads over tasks.
    """
    names = {c: unused(base, f"qr_{c}") for c in [*limits.columns, "salt"]}
    salted = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    limits = written(salted, "limits").toDF(*names.values())
    salt = F.pmod(F.xxhash64("n_words", "word_chars", "n_repeat_words"), F.lit(SALTS)).cast("int")
    same = (
        (F.coalesce(base["lang"], F.lit("")) == limits[names["lang"]])
        & (F.coalesce(base["source"], F.lit("")) == limits[names["source"]])
        & (salt == limits[names["salt"]])
    )
    kept = ~F.col("base_failed")
    for name, value in measures().items():
        kept = kept & (value <= F.col(names[f"{name}_most"]))
        if FENCES[name].below:
            kept = kept & (value >= F.col(names[f"{name}_least"]))
    return base.join(limits, same, "left").withColumn("kept", F.coalesce(kept, F.lit(False))).drop(*names.values())


def digest(docs: DataFrame) -> DataFrame:
    base = with_base(docs.select("doc_id", "text", "lang", "source"), keep=["doc_id", "lang", "source"])
    return judge(base, thresholds(sketches(base))).select("doc_id", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents, all their columns, that the rules keep. Measures are taken once, beside the rows."""
    own = [f"c{i}" for i in range(len(docs.columns))]  # the rules' column names may be in use
    at = {c: own[i] for i, c in enumerate(docs.columns)}
    named = docs.toDF(*own).withColumns({"lang": F.col(at["lang"]), "source": F.col(at["source"])})
    base = with_base(named, at["text"])
    return judge(base, thresholds(sketches(base))).where("kept").select(*[F.col(o).alias(c) for o, c in zip(own, docs.columns)])

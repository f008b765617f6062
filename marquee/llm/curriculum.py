"""Mixing sources to target weights along a time-varying curriculum.

Sources take turns, in the order of their names, with ``weights``. All targets come to ``share`` of all words; a target
stops at ``cap`` times its source's words, and what it leaves goes to the others by weight until none is above: the
targets are ``min(weight * level, cap * size)`` for the one level at which they add up.

Over training time 0..1 each source has a weight schedule, piecewise linear between knots. Its integral, scaled to the target, is
the cumulative demand for the source's words. Documents of a source stand in the order of a checksum of their ids; the words of a
document, and of every repeat one source size further on, begin at a place in that demand, and the inverse of
the demand there is its position in training. Where the target ends within a document, its first words are taken up to there, so that
the words taken of a source are its target, rounded. The whole is range-sorted by position.

Prefix sums run in two levels: documents of a source are cut, in their order, into buckets, of ``BUCKET_ROWS`` documents if one
source held them all; sums of buckets are added up first, then documents within a bucket. A source may hold any share of all rows.
Levels are found by rounds over one row a source; two sums a round come to the driver.

Everything is DataFrame functions. Rows: a null or empty text has size 0 and is never taken; a null source is a source, the last;
a row without id is placed by its text; repeated rows are mixed each, those equal in id and size in any order, which does not show; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import numbered, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
# (time, weight) knots, by turns like the weights: early, even, late.
Schedule = Sequence[tuple[float, float]]
SCHEDULES: tuple[Schedule, ...] = (((0.0, 2.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (0.5, 1.0), (1.0, 3.0)))
BUCKET_ROWS = 50_000
WORD = r"[^\x20\x09-\x0D]+"
# Bits of the checksum that orders documents, and of its part that picks the bucket.
KEY_BITS, HIGH_BITS = 60, 36


def segments(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """``start, length, weight at start, slope, area before`` of each stretch between knots; areas add up to the last entry's."""
    out, area = [], 0.0
    for (t, w), (t_next, w_next) in zip(schedule, schedule[1:]):
        if t_next <= t or min(w, w_next) < 0:
            raise ValueError("a schedule's times rise, and its weights are not negative")
        out.append((t, t_next - t, w, (w_next - w) / (t_next - t), area))
        area += (w + w_next) / 2 * (t_next - t)
    if area <= 0:
        raise ValueError("a schedule needs weight")
    return [*out, (schedule[-1][0], 0.0, 0.0, 0.0, area)]


def time_of(demand: Column, schedule: Schedule) -> Column:
    """The time at which the schedule has brought this share, 0 to 1, of its words: the inverse of its integral."""
    *parts, end = segments(schedule)
    area = demand * F.lit(end[4])
    out = F.lit(end[0])
    for start, length, weight, slope, before in reversed(parts):
        within = F.greatest(area - F.lit(before), F.lit(0.0))
        # weight * x + slope / 2 * x * x = within, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(F.lit(weight * weight) + within * F.lit(2 * slope), F.lit(0.0)))
        x = F.coalesce(F.try_divide(within * F.lit(2.0), F.lit(weight) + root), F.lit(0.0))
        after = before + (weight + slope * length / 2) * length
        out = F.when(area <= F.lit(after), F.lit(start) + F.least(x, F.lit(length))).otherwise(out)
    return out


def _of_turn(values: Sequence[Column]) -> Column:
    return F.element_at(F.array(*values), (F.pmod(F.col("place") - 1, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``no_source, source, source_size, place, target`` of each source, from ``no_source, source, size`` of documents."""
    sources = sizes.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    placed = numbered(sources, [F.col("no_source"), F.col("source")], "place")
    weighed = placed.withColumns({"weight": _of_turn([F.lit(float(w)) for w in weights]), "most": cap * F.col("source_size")})
    weighed = written(weighed, "sources")
    total, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total or 0)
    level, stopped = wanted / weight if weight else 0.0, -1
    while True:  # every round stops the sources that the level of the last one fills
        full = F.col("weight") * F.lit(level) >= F.col("most")
        held, free = weighed.agg(F.sum(F.when(full, F.col("most")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if held == stopped or not free:
            break
        level, stopped = (wanted - held) / free, held
    reached = F.col("weight") * F.lit(level)
    target = F.when(reached >= F.col("most"), F.col("most").cast("double")).otherwise(reached)
    return weighed.select("no_source", "source", "source_size", "place", target.alias("target"))


def assign(
    docs: DataFrame,
    keep: Sequence[str],
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    cap: int = CAP,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Columns ``keep`` of every row, as c0, c1, ..., and ``size, source_size, target, taken``: position and words of each time it is taken."""
    own = [f"c{i}" for i in range(len(keep))]
    known = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("no id "), F.coalesce(F.col(text_col), F.lit(""))))
    measured = docs.select(
        *[F.col(c).alias(o) for c, o in zip(keep, own)],
        F.col(id_col).cast("long").alias("id"),
        F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(known), 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
    )
    measured = written(measured, "sizes")
    buckets = -(-measured.count() // BUCKET_ROWS)
    # of the key's order, so that documents stand alike however many buckets there are
    bucket = F.shiftright(F.shiftright("key", KEY_BITS - HIGH_BITS) * F.lit(buckets).cast("long"), HIGH_BITS)
    rows = measured.withColumn("bucket", bucket)
    group = ["no_source", "source"]
    sums = rows.groupBy(*group, "bucket").agg(F.sum("size").alias("bucket_size"))
    before = F.coalesce(F.sum("bucket_size").over(Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = targets(measured, weights, share, cap)
    started = sums.withColumn("start", before).join(wanted, group).drop("bucket_size")
    inside = F.sum("size").over(Window.partitionBy(*group, "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.join(started, [*group, "bucket"]).withColumn("start", F.col("start") + inside - F.col("size"))
    end = F.round("target").cast("long")
    starts = F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda e: F.col("start") + e * F.col("source_size"))
    begun = F.filter(starts, lambda d: (F.col("size") > 0) & (d < end))
    taken = F.transform(
        begun,
        lambda d: F.struct(
            _of_turn([time_of(d / F.col("target"), s) for s in schedules]).alias("position"), F.least("size", end - d).alias("words")
        ),
    )
    return placed.select(*own, "size", "source_size", "target", taken.alias("taken"))


def training_order(docs: DataFrame, **mix) -> DataFrame:
    """The documents, all their columns, once for each time they are taken, and ``position, words``: range-sorted, and how many words are taken then."""
    rows = assign(docs, docs.columns, **mix)
    own = rows.columns[: len(docs.columns)]
    each = rows.select(*own, F.explode("taken").alias("taken")).select(*own, "taken.position", "taken.words")
    order = ["position", *own[:1]]
    return each.repartitionByRange(*order).sortWithinPartitions(*order).toDF(*docs.columns, "position", "words")


def digest(docs: DataFrame) -> DataFrame:
    """Words ``taken`` and the first ``position`` of every document, in the order of training; what is not taken stands first."""
    rows = assign(docs, ["doc_id"])
    words = F.aggregate("taken", F.lit(0).cast("long"), lambda a, t: a + t["words"])
    position = F.get("taken", F.lit(0))["position"].alias("position")
    out = rows.select(F.col("c0").alias("doc_id"), "size", "source_size", "target", words.alias("taken"), position)
    return out.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")

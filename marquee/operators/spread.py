"""Order-dependent numbering without a single-task window.

``row_number`` or ``rank`` over few, very large groups would sort each group in
one task. Ids: rows are range-partitioned by the order instead, so a hot
group spreads over many tasks; positions are counted inside each slice and
shifted by the sizes of the slices before it. Range bounds are sampled, so the placed rows are cut from their lineage with a
reliable checkpoint: a recomputed task could not place rows differently.
Ranks: values are dealt to buckets by a fixed rule instead, which needs neither.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.session import cut_lineage
from marquee.sources import files

# ``monotonically_increasing_id`` keeps the slice above this bit and the
# position inside the slice below it.
SLICE_BIT = 33
# Buckets between a number and its double.
STEPS = 256


def dense_ids(keys: DataFrame, order_by: list[str], id_name: str) -> DataFrame:
    """Number distinct keys 1, 2, 3, ... in the order of ``order_by``."""
    placed = cut_lineage(
        keys.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_position", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_position", SLICE_BIT))
    # One row per slice, so the unpartitioned window and the broadcast are
    # bounded by the number of partitions, not by the data.
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.col("_position") - F.shiftleft("_slice", SLICE_BIT)
    return placed.join(F.broadcast(offsets), "_slice").select(
        (F.col("_offset") + local + 1).alias(id_name), *keys.columns
    )


def stable_ids(keys: DataFrame, order_by: list[str], id_name: str, store: str) -> DataFrame:
    """Ids of distinct keys that stay when keys are added.

    ``store`` is a table of all ids given so far: known keys keep theirs, new ones are numbered behind
    the largest, in the order of ``order_by``, and added to it. Keys that are gone keep their row there, so
    an id is never given twice. One build at a time may use a store.
    """
    spark = keys.sparkSession
    schema = f"{id_name} long, " + ", ".join(f"{name} {kind}" for name, kind in keys.dtypes)
    files.make(spark, store)
    known = spark.read.schema(schema).parquet(store)
    largest = F.coalesce(known.agg(F.max(id_name)).scalar(), F.lit(0))
    renamed = known.withColumnsRenamed({c: f"_k_{c}" for c in known.columns})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys.columns])
    fresh = dense_ids(keys.join(renamed, same, "left_anti"), order_by, id_name)
    fresh.withColumn(id_name, F.col(id_name) + largest).write.mode("append").parquet(store)
    given = spark.read.schema(schema).parquet(store)
    return null_safe_join(keys, given, keys.columns).select(id_name, *keys.columns)


def rank_desc(df: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """``RANK() OVER (PARTITION BY group ORDER BY value DESC)``, NULLs last; see :func:`ranks_desc`."""
    return ranks_desc(df, group, {value: name})


def ranks_desc(df: DataFrame, group: list[str], ranks: dict[str, str]) -> DataFrame:
    """Descending ranks by several number columns within one group, every group spread over many tasks.

    One tally of (group, column, value) serves all columns and folds ties before any shuffle. Its
    values are dealt to buckets of nearly equal size (see :func:`_bucket`), a function of the value alone, so that
    nothing is sampled and no job runs before the first action: a rank is the rows of the buckets above plus those
    of greater values in its own. Values are compared as doubles.
    """
    key = [*group, "_rank"]
    each = F.inline(F.array(*(F.struct(F.lit(v).alias("_rank"), F.col(v).cast("double").alias("_value")) for v in ranks)))
    tally = df.select(*group, each).groupBy(*key, "_value").agg(F.count(F.lit(1)).alias("_rows"))
    tally = tally.withColumn("_bucket", _bucket(F.col("_value")))
    sizes = tally.groupBy(*key, "_bucket").agg(F.sum("_rows").alias("_bucket_rows"))

    def ahead(rows: str, keys: list[str], order: str) -> Column:
        above = W.partitionBy(*keys).orderBy(F.desc_nulls_last(order)).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(rows).over(above), F.lit(0))

    offsets = sizes.select(*key, "_bucket", ahead("_bucket_rows", key, "_bucket").alias("_offset"))
    local = tally.withColumn("_ahead", ahead("_rows", [*key, "_bucket"], "_value"))
    ranked = null_safe_join(local, offsets, [*key, "_bucket"])
    for value, name in ranks.items():
        own = ranked.filter(F.col("_rank") == value).select(*group, F.col("_value").alias(value), (F.col("_offset") + F.col("_ahead") + 1).alias(name))
        df = null_safe_join(df, own, [*group, value])
    return df


def _bucket(value: Column) -> Column:
    """A whole number that never falls as the value rises: steps of about 1/``STEPS`` of the value."""
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    # A line between powers of two instead of the logarithm: continuous, so an exponent rounded the other way does no harm.
    steps = F.floor((exponent + size / F.pow(F.lit(2.0), exponent) - 1) * STEPS) + 2000 * STEPS
    endless = F.isnan(value) | (size == float("inf"))
    return F.when(endless, F.signum(F.nanvl(value, F.lit(1.0))).cast("long") * 4000 * STEPS).when(size == 0, F.lit(0)).otherwise(
        F.signum(value).cast("long") * steps
    )


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner equi-join on ``on`` in which NULL meets NULL."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    match: Column = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, match).drop(*[f"_r_{c}" for c in on])

"""What the operators share: row identity, written steps, small Arrow helpers."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.session import shared_dir

# Bytes of text that a task turns into arrays at once.
TEXT_STEP = 4 << 20
# Rows of a step, whatever a session's batches hold.
STEP_ROWS = 1 << 15
# Bytes of rows that go to a Python worker at once, where the session sets no lower bound.
BATCH_BYTES = 16 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id; a row without one is known by the hash of its text."""
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col), F.lit("no id")))


def bound_batches(spark: SparkSession) -> None:
    """Batches are cut by bytes, since a batch of so many rows may hold any size of text."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", spark.conf.get(_BATCH_SETTING).lower()).groups()
    if not 0 < int(number) << 10 * " kmgtp".index(unit or " ") <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def doc_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, doc_key, text_key, text`` of every row; a null text is empty.

    Rows are one document if they agree in id and text. Other columns of the
    input are not read, so their names cannot clash.
    """
    bound_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        doc_key(id_col, text_col).alias("doc_key"),
        F.hash(F.col(text_col)).alias("text_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, or as many underscores behind it as no column of ``df`` needs."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


_written: dict[str, SparkSession] = {}


def _remove_written() -> None:
    for folder, spark in _written.items():
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session is gone: its folder is left to the owner of the shared folder
            return


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; what is written there goes when the driver ends."""
    if not _written:
        atexit.register(_remove_written)
    folder = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    _written[folder] = spark
    return f"{folder}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ``monotonically_increasing_id`` holds the slice above this bit and the place inside it below.
_SLICE_BIT = 33


def numbered(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with their place 1, 2, ... in ``order``, sorted by range, so that no task sees more than a slice.

    Bounds of ranges are sampled; the placed rows are written, so that all that follows sees the same.
    """
    at, part, offset = (unused(rows, n) for n in ("at", "part", "offset"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    placed = written(placed, "placed").withColumn(part, F.shiftright(at, _SLICE_BIT))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    counts = placed.groupBy(part).agg(F.count("*").alias("n"))
    offsets = counts.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(offset))
    place = F.col(offset) + F.col(at) - F.shiftleft(part, _SLICE_BIT) + 1
    return placed.join(F.broadcast(offsets), part).select(*rows.columns, place.alias(name))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind one another, and the offsets of each."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    view = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return view[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_steps(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = TEXT_STEP
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of text and ``STEP_ROWS`` rows, or of one row."""
    for batch in batches:
        _, bounds = text_buffer(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1)
            high = min(high, low + STEP_ROWS)
            yield batch.slice(low, high - low)
            low = high


def texts_of(column: pa.Array) -> list[bytes]:
    """Each text as its UTF-8 bytes."""
    data, bounds = text_buffer(column)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

"""Session helpers and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Rows of a shuffle that a task sorts, joins or aggregates, about; the bytes, shuffled or of files, that a task
# reads unless a key has more, and those from which on a hot partition of a join is split.
ROWS_A_TASK = 1_000_000
TASK_BYTES = 16 << 20
HOT_BYTES = 4 * TASK_BYTES


def local_session(cores: int | str = 8, app_name: str = "marquee") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    parallelism = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def byte_size(text: str) -> int:
    """Bytes of a size as settings have it: ``64MB``, ``16m``, ``8192``."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def sized(spark: SparkSession, rows: int) -> SparkSession:
    """``spark``, or, to shuffle more than ``ROWS_A_TASK`` rows, a session beside it whose tasks get about that many.

    That session has the settings of ``spark``, but a shuffle partition for every so many rows at least, which adaptive
    execution joins to ``TASK_BYTES`` at most. A task's memory then stays as it is however many rows
    there are. Unlike behind a repartition by number, hot keys of joins are still split.
    """
    if rows <= ROWS_A_TASK:
        return spark
    beside = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if beside.conf.get(name, None) != value:
            with suppress(AnalysisException):  # one of the application, which no session can set
                beside.conf.set(name, value)
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    partitions = "spark.sql.shuffle.partitions"
    for name in (partitions, first):
        given = int(spark.conf.get(name, None) or spark.conf.get(partitions))
        beside.conf.set(name, max(given, -(-rows // ROWS_A_TASK)))
    sizes = {
        "spark.sql.files.maxPartitionBytes": TASK_BYTES,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": HOT_BYTES,
    }
    for name, most in sizes.items():
        beside.conf.set(name, min(byte_size(spark.conf.get(name)), most))
    return beside


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    folder of one machine would vanish with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="marquee-")
        context.setCheckpointDir(folder)
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut_lineage(df):
    """Reliable checkpoint: the rows survive the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def together(*actions: Callable[[], Any]) -> list[Any]:
    """Run independent actions at once, so that the small jobs of one fill the
    executors left idle by another; results come in the order given."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [future.result() for future in [pool.submit(action) for action in actions]]

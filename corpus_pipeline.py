"""The corpus pipeline: documents in, token digests of what is worth training on out.

Each stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept, and
is written to the shared folder before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, decontamination, lines, probminhash, quality
from marquee.llm.common import written
from marquee.llm.queries import benchmark, documents, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", lambda spark, docs, folder: quality.keep_good(docs)),
    ("line dedup", lambda spark, docs, folder: lines.drop_lines(docs)),
    ("near-duplicates", lambda spark, docs, folder: probminhash.keep_first(docs)),
    ("benchmark decontamination", lambda spark, docs, folder: decontamination.clean(docs, benchmark(spark, folder))),
    ("byte-level BPE", lambda spark, docs, folder: bpe.digest(docs, vocabulary())),
]

# Near-duplicate search and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)

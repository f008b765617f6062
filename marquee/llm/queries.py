"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, curriculum, decontamination, lines, prefix_trie, probminhash, quality, secret_scan, substring, survival, tool_calls, urls, warc
from marquee.llm.oracles import ORACLES as ORACLES

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: spark.read.parquet(f"{folder}/{name}.parquet")


documents, pages, benchmark, labels, conversations = (_table(t) for t in ("documents", "pages", "benchmark", "labels", "conversations"))


def vocabulary() -> bpe.Tokenizer:
    return bpe.tokenizer(TOKENIZER, public_tokenizers.PATTERN)


QUERIES: dict[str, Query] = {
    "op1_url_filter": lambda s, d: urls.judge(pages(s, d)),
    "op2_byte_bpe": lambda s, d: bpe.digest(documents(s, d), vocabulary()),
    "op3_warc_revisits": lambda s, d: warc.digest(pages(s, d)),
    "op4_probminhash": lambda s, d: probminhash.digest(documents(s, d)),
    "op5_substring_dedup": lambda s, d: substring.digest(documents(s, d)),
    "op6_decontamination": lambda s, d: decontamination.digest(documents(s, d), benchmark(s, d)),
    "op7_quality_rules": lambda s, d: quality.digest(documents(s, d)),
    "op8_tool_calls": lambda s, d: tool_calls.every_turn(conversations(s, d)),
    "op9_line_dedup": lambda s, d: lines.digest(documents(s, d)),
    "op10_secret_scan": lambda s, d: secret_scan.digest(documents(s, d), digitless_keys=True),
    "op11_prefix_trie": lambda s, d: prefix_trie.digest(conversations(s, d)),
    "op12_curriculum_mix": lambda s, d: curriculum.digest(documents(s, d)),
    "op13_filter_audit": lambda s, d: survival.digest(documents(s, d), labels(s, d)),
}

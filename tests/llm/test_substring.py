import random

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import substring
from tests.llm import brute
from tests.llm.conftest import EDGE_DOCS, expected, numbered, rows_of


def test_digest_of_edge_cases(edge_docs):
    assert rows_of(substring.digest(edge_docs)) == expected(brute.substring(EDGE_DOCS))


def test_digest_of_smoke_documents(smoke_docs, smoke_rows):
    assert rows_of(substring.digest(smoke_docs)) == expected(brute.substring(smoke_rows))


def test_small_windows_and_many_repeats(spark, monkeypatch):
    """Few different words: every minimiser is frequent, runs overlap, documents repeat themselves."""
    pick = random.Random(3)
    docs = [(i, " ".join(pick.choices("abc", k=pick.randint(0, 80)))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for window, gram in ((4, 2), (6, 3), (3, 3), (5, 1)):
        got = rows_of(substring.dedupe(df, window, gram).selectExpr("doc_id", "n_words", "n_removed", "sha2(kept, 256)"))
        assert got == expected(brute.substring(docs, window))


def test_a_passage_in_every_document_is_sent_once_a_batch(spark):
    passage = numbered(99999, 60)
    docs = [(i, f"{numbered(i, 30)} {passage} {numbered(i + 5000, 30)}") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_removed for r in substring.digest(df).collect()}
    assert got == {i: 60 if i else 0 for i, _ in docs}


def test_long_runs_of_one_word_are_cut(spark):
    df = spark.createDataFrame([(1, "again " * 5000), (2, "again " * 100)], "doc_id long, text string")
    assert rows_of(substring.digest(df)) == expected(brute.substring([(1, "again " * 5000), (2, "again " * 100)]))


def test_null_ids_and_one_id_with_two_texts(spark):
    passage = numbered(7, 40)
    docs = spark.createDataFrame([(1, passage), (1, passage + " more"), (None, numbered(8, 40)), (1, passage)], "doc_id long, text string")
    got = sorted((r.n_words, r.n_removed) for r in substring.digest(docs).collect())
    # the two equal rows are one document; the other text of that id repeats it, or is repeated by it
    assert got in ([(40, 0), (40, 0), (40, 0), (41, 40)], [(40, 0), (40, 40), (40, 40), (41, 0)])


def test_no_documents(no_docs):
    assert substring.digest(no_docs).collect() == []


def test_words_that_hold_nul(spark):
    odd = " ".join(f"n\x00{i}" for i in range(45)) + " \x00 \x00\x00 " + numbered(3, 30)
    docs = [(1, odd), (2, f"{numbered(1, 30)} {odd}"), (3, numbered(3, 30)), (4, f"{numbered(2, 25)} \x00 {numbered(1, 30)}")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert rows_of(substring.digest(df)) == expected(brute.substring(docs))


def test_cells_over_a_size_are_split_by_window(spark, monkeypatch):
    """One trigram in different contexts, and one passage in them: single windows and settled ones spread over buckets."""
    monkeypatch.setattr(substring, "BUCKET_BYTES", 400)
    monkeypatch.setattr(substring, "MARKS", 7)
    monkeypatch.setattr(substring, "CELLS", 16)
    docs = [(i, f"{numbered(i, 25)} all rights reserved {numbered(i % 9, 25)} {numbered(-1, 20)} {numbered(i + 500, 3)}") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows_of(substring.digest(df)) == expected(brute.substring(docs))


def test_no_bucket_is_planned_over_the_size():
    sizes = np.array([substring.BUCKET_BYTES // 3] * 10 + [substring.BUCKET_BYTES * 5, 1])
    base, parts = substring.bucket_plan(sizes, sizes * 2, 2)
    assert base.tolist() == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 4, 14] and parts.tolist() == [1] * 10 + [10, 1]


def test_many_short_documents_in_one_batch(spark, set_conf):
    """More documents than two bytes count, in batches without a limit of rows."""
    set_conf("spark.sql.execution.arrow.maxRecordsPerBatch", "0")
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.concat(F.lit("a"), F.col("id") % 35_000, F.lit("x"), i)), " ")
    docs = spark.range(0, 70_000, numPartitions=1).select(F.col("id").alias("doc_id"), words.alias("text"))
    got = substring.digest(docs).groupBy((F.col("doc_id") < 35_000).alias("first")).agg(F.sum("n_removed").alias("n"), F.count("*").alias("docs"))
    assert {(r.first, r.n, r.docs) for r in got.collect()} == {(True, 0, 35_000), (False, 700_000, 35_000)}

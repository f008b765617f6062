import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import lines
from tests.llm import brute
from tests.llm.conftest import EDGE_DOCS, expected, rows_of


def test_digest_of_edge_cases(edge_docs):
    assert rows_of(lines.digest(edge_docs)) == expected(brute.lines(EDGE_DOCS))


def test_digest_of_smoke_documents(smoke_docs, smoke_rows):
    assert rows_of(lines.digest(smoke_docs)) == expected(brute.lines(smoke_rows))


def test_one_line_in_most_documents_spreads_over_ranges(spark, set_conf):
    """The range of one hash is cut between tasks: the first document must still be found."""
    rows = [(i, f"The very common line\nown line number {i}\nthe very common line") for i in range(3000, 0, -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    # as many rows as a task is given to take in, whatever few they are here
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    set_conf("spark.sql.shuffle.partitions", "12")
    hashes = lines.line_hashes(lines.doc_rows(docs), 10).repartitionByRange(*lines._PLACE)
    per_task = hashes.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) < 0.3 * 9000
    got = {r.doc_id: r.n_dropped for r in lines.digest(docs).collect()}
    assert got == {i: 0 if i == 1 else 2 for i, _ in rows}


def test_runs_across_batches_of_a_task():
    place = [(h, h, d, 0, n) for h in (1, 2, 3) for d in (1, 2, 3) for n in (0, 1)]
    names = ["h1", "h2", "doc_key", "text_key", "line"]
    for size in (1, 2, 5, 18):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, p)) for p in place[i : i + size]]) for i in range(0, len(place), size)]
        out = [r for b in lines._later(iter(batches)) for r in b.to_pylist()]
        assert sorted((r["h1"], r["doc_key"], r["line"]) for r in out if not r["edge"]) == [(h, d, n) for h in (1, 2, 3) for d in (2, 3) for n in (0, 1)]
        assert sorted((r["h1"], r["doc_key"], r["line"]) for r in out if r["edge"]) == [(h, 1, n) for h in (1, 3) for n in (0, 1)]


@pytest.mark.parametrize("n", [1, 7, 8, 9, 100])
def test_bitmaps(n):
    places = list(range(0, n, 3))
    keep = lines.unpack(lines.pack(places), n)
    assert np.flatnonzero(~keep).tolist() == places


def test_rows_keep_all_their_columns(edge_docs):
    out = lines.drop_lines(edge_docs)
    assert out.columns == edge_docs.columns
    got = {(r.doc_id, brute.sha(r.text or "")): (r.text is None, r.n_chars, r.bitmap) for r in out.collect()}
    want = {(i, sha): gone for i, _, gone, sha in brute.lines(EDGE_DOCS)}
    assert got.keys() == want.keys()
    assert {k for k, v in got.items() if v[0]} == {(1, brute.sha(""))}
    assert all(r.n_chars == len(r.text) and r.doc_key == "x" for r in out.collect() if r.text is not None)


def test_null_ids_and_one_id_with_two_texts(spark):
    line = "a line that several hold"
    docs = spark.createDataFrame([(1, line), (1, line + "\nmore text of it"), (None, "another line, without id")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_lines, r.n_dropped) for r in lines.digest(docs).collect())
    assert sum(r[2] for r in got) == 1 and len(got) == 3


def test_no_documents(no_docs):
    assert lines.digest(no_docs).collect() == []
    assert lines.drop_lines(no_docs).collect() == []

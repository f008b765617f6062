import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm.oracles import ORACLES
from marquee.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import SMOKE_DIR, expected, rows_of
from tests.llm.test_quality import plain as quality_of


def by_hand(docs, items):
    """(doc_id, text, lang, source) through all stages."""
    kept = {r[0] for r in quality_of(docs) if r[-1]}
    texts = [(i, text) for i, text, *_ in docs if i in kept]
    holders = {}
    for i, text in texts:
        for line in (text or "").split("\n"):
            holders[brute.line_key(line)] = min(i, holders.get(brute.line_key(line), i))
    texts = [
        (i, "\n".join(s for s in (text or "").split("\n") if len(k := brute.line_key(s)) < 10 or holders[k] == i)) for i, text in texts
    ]
    roots = brute.classes(texts)
    texts = [(i, text) for i, text in texts if roots[i] == i]
    hit = {r[0] for r in brute.decontamination(texts, items) if r[-1]}
    yield from brute.bpe([(i, text) for i, text in texts if i not in hit])


def test_run_on_smoke_documents(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    items = spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").select("item_id", "text").collect()
    want = expected(by_hand([tuple(r) for r in docs], [tuple(r) for r in items]))
    assert 0 < len(want) < len(docs)
    assert rows_of(corpus_pipeline.run(spark, SMOKE_DIR)) == want


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").withColumns({n: F.lit(1) for n in ("extra", "doc_key", "kept", "_bitmap")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMOKE_DIR)
        assert out.schema.names == docs.schema.names
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same(spark, name):
    with duckdb.connect() as db:
        for table in ("documents", "pages", "benchmark", "labels", "conversations"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMOKE_DIR}/{table}.parquet'")
        answer = db.execute(ORACLES[name])
        columns = [c[0] for c in answer.description]
        want = expected(answer.fetchall())
    got = QUERIES[name](spark, SMOKE_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.select(*columns)) == want

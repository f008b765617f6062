import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from marquee.llm import survival
from marquee.llm.common import written
from tests.llm.conftest import EDGE_DOCS, SMOKE_DIR, rows_of

LABELS = "doc_id long, quality int, toxic int"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {"A"} if len(words) < 100 else set()
    found |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
    found |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
    return found | ({"D"} if re.search(r"[#$%&*|]", text) else set())


def audit(docs, labels):
    """Every order applied filter by filter. ``docs``: id, text, part; ``labels``: id, quality, toxic."""
    least: dict[str, int] = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    parts: dict[str, list] = {}
    for i, text, part in docs:
        found = fails(text or "") | ({"E"} if i is not None and least[text or ""] < i else set())
        parts.setdefault(part or "", []).append((found, i is not None and i in good, i is not None and i in toxic))
    for part, rows in parts.items():
        out, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[0]]
                left = [r for r in left if name not in r[0]]
                failing = [r for r in rows if name in r[0]]
                shapley[name] += len(gone)
                only = sum(r[0] == {name} for r in rows)
                out.append((part, "".join(order), step, name, len(left), len(gone), len(failing) - len(gone), only, sum(r[1] for r in gone), sum(r[2] for r in gone)))
        yield from ((*row, shapley[row[3]]) for row in out)


def test_smoke_documents(spark, smoke_docs):
    labels = spark.read.parquet(f"{SMOKE_DIR}/labels.parquet").select("doc_id", "quality", "toxic")
    want = audit([(r.doc_id, r.text, r.lang) for r in smoke_docs.collect()], [tuple(r) for r in labels.collect()])
    assert rows_of(survival.digest(smoke_docs, labels)) == sorted(want, key=repr)


def test_edge_cases(spark, edge_docs):
    labels = [(1, 1, None), (2, None, 1), (4, 1, 1), (4, 0, 0), (5, 1, 0), (None, 1, 1), (99, 1, 1), (12, 1, 1)]
    frame = spark.createDataFrame(labels, LABELS).withColumns({c: F.lit("x") for c in ("part", "word", "good", "fails")})
    want = audit([(i, text, "en" if i % 3 else None) for i, text in EDGE_DOCS], [r for r in labels if r[0] is not None])
    assert rows_of(survival.digest(edge_docs, frame)) == sorted(want, key=repr)


def test_rows_without_id_are_no_copies_and_have_no_labels(spark):
    rows = [(None, "same text", "a"), (None, "same text", None), (3, "same text", ""), (3, "same text", "a"), (4, "same text", "a")]
    labels = [(None, 1, 1), (4, 1, 0)]
    got = survival.digest(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, LABELS))
    assert rows_of(got) == sorted(audit(rows, labels[1:]), key=repr)


def test_empty_tables(spark, no_docs, smoke_docs):
    no_labels = spark.createDataFrame([], LABELS)
    assert survival.digest(no_docs, no_labels).collect() == []
    assert {(r.good_lost, r.toxic_lost) for r in survival.digest(smoke_docs, no_labels).collect()} == {(0, 0)}


def test_truth_table(spark):
    rows = spark.range(32).select(F.col("id").cast("int").alias("m")).select("m", survival.survival_word(F.col("m")).alias("w")).collect()
    for r in rows:
        assert [r.w >> s & 1 for s in range(32)] == [int(not s & r.m) for s in range(32)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 2048])
def test_planes_count_every_bit(spark, n):
    """The planes of a block hold the counts, also where every word of the fullest block holds a bit."""
    word = F.hash("id").bitwiseOR(F.lit(-(2**31) + 1))
    rows = spark.range(n).select(word.alias("word"))
    planes = rows.agg(F.collect_list("word").alias("words")).select(F.expr(survival.planes("words")).alias("p")).first().p
    words = [r.word for r in rows.collect()]
    for bit in range(32):
        assert sum((plane >> bit & 1) << k for k, plane in enumerate(planes)) == sum(w >> bit & 1 for w in words)


def test_survivors_of_many_blocks(spark):
    rows = spark.range(0, 10_000, numPartitions=3).select((F.col("id") % 3).alias("k"), F.hash("id").alias("word"))
    got = {(r.k, r.subset): r.n for r in survival.survivors(written(rows, "words"), "k").collect()}
    want = Counter((r.k, bit) for r in rows.collect() for bit in range(32) if r.word >> bit & 1)
    assert got == {(k, bit): want[k, bit] for k in range(3) for bit in range(32)}


def test_a_large_group_of_copies_is_dealt_over_tasks(spark):
    rows = spark.range(3000).select("id", F.lit("d").alias("digest"))
    marked = survival.mark_copies(rows, "id", "digest")
    assert marked.where("not copy").collect()[0].id == 0 and marked.where("copy").count() == 2999
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(survival.SALTS)))
    assert salted.groupBy("salt").count().agg(F.max("count")).first()[0] < 3000 / survival.SALTS * 2

from marquee.llm import decontamination
from tests.llm import brute
from tests.llm.conftest import EDGE_DOCS, SMOKE_DIR, expected, numbered, rows_of

ITEMS = [
    (1, f"Before: {numbered(1, 25)} -- after"),
    (2, "THREE"),
    (3, "Two, three!"),
    (10, numbered(1, 12)),
    (10, numbered(4, 9)),
    (5, None),
    (6, ""),
    (7, " .,; "),
    (8, "nowhere to be found in these ten words of mine"),
    (None, numbered(2, 5)),
    (10, numbered(1, 12)),
]


def items_of(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_digest_of_edge_cases(spark, edge_docs):
    assert rows_of(decontamination.digest(edge_docs, items_of(spark))) == expected(brute.decontamination(EDGE_DOCS, ITEMS))


def test_digest_of_smoke_documents(spark, smoke_docs, smoke_rows):
    items = spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet")
    rows = [(r.item_id, r.text) for r in items.collect()]
    assert rows_of(decontamination.digest(smoke_docs, items)) == expected(brute.decontamination(smoke_rows, rows))


def test_blocks_of_items_give_the_same(spark, edge_docs):
    whole = decontamination.find(edge_docs, items_of(spark))
    parts = decontamination.find(edge_docs, items_of(spark), block_bytes=100)
    assert len(list(decontamination.pattern_blocks(items_of(spark), 10, "item_id", "text", 100))) > 2
    shown = ["doc_id", "n_words", decontamination.hit_words("spans").alias("n_hit"), "items"]
    assert rows_of(parts.select(*shown)) == rows_of(whole.select(*shown))


def test_clean_documents_stay_with_all_columns(spark, edge_docs):
    for block_bytes in (1 << 20, 100):
        out = decontamination.clean(edge_docs, items_of(spark), block_bytes=block_bytes)
        assert out.columns == edge_docs.columns
        want = sorted(r[0] for r in brute.decontamination(EDGE_DOCS, ITEMS) if not r[5])
        assert sorted(r.doc_id for r in out.collect()) == want


def test_shift_table_skips_and_loses_nothing():
    strings = {b"a b c d e f": {"1"}, b"c d e f g h": {"2"}}
    length = decontamination.Length(6, strings)
    assert length.step == 5 and (length.shift == 5).sum() > len(length.shift) - 20
    docs = [(i, " ".join("abcdefgh"[(i * k) % 8] for k in range(40))) for i in range(1, 9)]
    items = [(1, "a b c d e f"), (2, "c d e f g h")]
    found = decontamination.Patterns(items, 6).search(__import__("pyarrow").array([t for _, t in docs]))
    want = list(brute.decontamination(docs, items, 6))
    assert [sum(b - a for a, b in some) for some in found[1]] == [r[2] for r in want]


def test_no_documents_or_no_items(spark, no_docs, edge_docs):
    assert decontamination.digest(no_docs, items_of(spark)).collect() == []
    none = items_of(spark).limit(0)
    assert not any(r.contaminated for r in decontamination.digest(edge_docs, none).collect())

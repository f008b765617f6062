import pytest
from pyspark.sql import functions as F

SMOKE_DIR = "/root/testdata/sf0.001"

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew bitter potions near old mills"


def numbered(seed: int, n: int) -> str:
    """n different words, others for each seed."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


# Nulls, empty and blank texts, ties, repeated rows, shared passages, white space of every kind, long texts.
EDGE_DOCS = [
    (1, None),
    (2, ""),
    (3, " \t\n \v\f\r "),
    (4, f"{PROSE} {numbered(1, 60)}\nA shared line of text\nshort\n\nA shared line of text"),
    (5, f"{numbered(2, 5)} {PROSE} {PROSE}\n  a SHARED line of TEXT\t\nown line of five"),
    (5, f"{numbered(2, 5)} {PROSE} {PROSE}\n  a SHARED line of TEXT\t\nown line of five"),
    (6, numbered(1, 60)),
    (7, "one two three"),
    (8, "one two three"),
    (9, "é" * 10 + "\n" + "é" * 9 + "\nß ü ö x y"),
    (10, "É" * 10 + "\n" + "é" * 10 + "\n" + "é" * 9),
    (11, " ".join(f"long{i % 700}" for i in range(30000))),
    (12, "x" * 5000 + " " + "a " * 3000),
    (13, f"{numbered(3, 30)}\r\n{numbered(3, 30)}\r\n{numbered(4, 300)}"),
    (14, f"{numbered(4, 290)} and {numbered(5, 10)}"),
    (15, "Zero\x00byte and emoji 😀 " + numbered(5, 10)),
]

# Names that the operators use for columns of their own.
CLASHING = ["doc_key", "text_key", "bitmap", "spans", "words", "class_id", "kept", "n_words", "qr_words", "rank", "c0", "bin", "measure"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, text, "en" if i % 3 else None, "web" if i % 4 else None, len(text or "")) for i, text in EDGE_DOCS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({name: F.lit("x") for name in CLASHING}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def smoke_docs(spark):
    return spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def smoke_rows(smoke_docs):
    return [(r.doc_id, r.text) for r in smoke_docs.select("doc_id", "text").collect()]


@pytest.fixture
def set_conf(spark):
    """Sets a setting for the length of a test."""
    old = {}

    def put(key, value):
        old.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def expected(rows):
    return sorted(map(tuple, rows), key=repr)

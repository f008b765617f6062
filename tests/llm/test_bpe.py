import random

import pytest

from marquee.llm import bpe
from marquee.llm.queries import vocabulary
from tests.llm import brute
from tests.llm.conftest import EDGE_DOCS, expected, rows_of


@pytest.fixture(scope="module")
def tokens():
    return vocabulary()


def test_digest_of_edge_cases(edge_docs, tokens):
    assert rows_of(bpe.digest(edge_docs, tokens)) == expected(brute.bpe(EDGE_DOCS))


def test_digest_of_smoke_documents(smoke_docs, smoke_rows, tokens):
    assert rows_of(bpe.digest(smoke_docs, tokens)) == expected(brute.bpe(smoke_rows))


def test_small_chunks_give_the_ids_of_the_whole(spark, tokens):
    """Chunks of 40 characters: contractions, runs of spaces, and words longer than the overlap fall on the cuts."""
    pick = random.Random(5)
    parts = ["don't", "we'll", "I've", "'re", "  ", "\n\n", "   x", "été", "naïve", "12345", "!?...", "😀😀", "a" * 90, "日本語テキスト", " ", "'"]
    texts = [" ".join(pick.choices(parts, k=pick.randint(5, 60))) if i % 2 else "".join(pick.choices(parts, k=60)) for i in range(60)]
    texts += ["b" * 500, " " * 500, "", "'" * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = brute.encoding()
    got = {r.doc_id: r.ids for r in bpe.encode(docs, tokens, chunk_chars=40, overlap=16).collect()}
    assert got == {i: plain.encode_ordinary(text) for i, text in enumerate(texts)}


def test_chunks_of_a_sound_text_are_encoded_apart(spark, tokens):
    docs = spark.createDataFrame([(1, "some words " * 100)], "doc_id long, text string")
    pieces = bpe._long_pieces(bpe.doc_rows(docs), spark.sparkContext.broadcast(tokens), 100, 20).collect()
    assert len(pieces) == 11
    assert "".join(p.text for p in sorted(pieces, key=lambda p: p.piece)) == "some words " * 100


def test_repeated_long_rows_and_null_ids(spark, tokens):
    text = "many words of one text " * 20
    docs = spark.createDataFrame([(1, text), (1, text), (1, text + "x"), (None, text), (None, None)], "doc_id long, text string")
    got = rows_of(bpe.encode(docs, tokens, chunk_chars=50, overlap=20))
    ids, more = (brute.encoding().encode_ordinary(t) for t in (text, text + "x"))
    assert got == expected([(1, ids), (1, ids), (1, more), (None, ids), (None, [])])


def test_decoding_restores_the_bytes(edge_docs, tokens):
    decoded = bpe.decode(bpe.encode(edge_docs, tokens), tokens).collect()
    assert sorted(bytes(r.data) for r in decoded) == sorted((text or "").encode() for _, text in EDGE_DOCS)


def test_no_documents(no_docs, tokens):
    assert bpe.digest(no_docs, tokens).collect() == []

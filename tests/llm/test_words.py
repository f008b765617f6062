import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm.words import LETTERS, NOT_SPACE, gram_hashes, split_words, word_hashes
from tests.llm import brute

TEXTS = st.lists(st.text(alphabet=" \t\nabAB09é😀.-\x00", max_size=40), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_of_each_text(texts):
    for kind, lower, plain in ((NOT_SPACE, False, brute.words), (LETTERS, True, brute.letters)):
        found = split_words(pa.array(texts, pa.string()), kind, lower)
        for i, text in enumerate(texts):
            a, b = found.first[i], found.first[i + 1]
            assert [found.span(k, k + 1).decode() for k in range(a, b)] == plain(text)
            assert found.span(a, b).decode() == " ".join(plain(text))


def test_sliced_and_null_texts():
    column = pa.array(["skip me", None, "a b", "", "c"], pa.string()).slice(1)
    assert np.diff(split_words(column).first).tolist() == [0, 2, 0, 1]


def test_equal_words_hash_alike_and_others_do_not():
    texts = ["a", "b", "ab", "ba", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "z" * 600, "z" * 601, "é"]
    hashes = word_hashes(split_words(pa.array(texts + texts, pa.string())))
    assert hashes[: len(texts)].tolist() == hashes[len(texts) :].tolist()
    assert len(set(hashes.tolist())) == len(texts)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 20])
def test_gram_hash_depends_on_its_words_only(n):
    words = [f"w{i % 7}" for i in range(60)]
    hashes = gram_hashes(word_hashes(split_words(pa.array([" ".join(words)], pa.string()))), n)
    assert len(hashes) == 60 - n + 1
    by_gram = {}
    for i, h in enumerate(hashes.tolist()):
        assert by_gram.setdefault(tuple(words[i : i + n]), h) == h
    assert len(set(by_gram.values())) == len(by_gram)

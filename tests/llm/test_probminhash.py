import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import probminhash
from marquee.llm.components import components
from marquee.llm.words import NOT_SPACE, split_words
from tests.llm import brute
from tests.llm.conftest import EDGE_DOCS, numbered, rows_of


def changed(text: str, share: float, seed: int) -> str:
    pick = random.Random(seed)
    return " ".join(f"z{seed}q{i}" if pick.random() < share else w for i, w in enumerate(text.split()))


def classes_of(df):
    return {r.doc_id: r.class_id for r in df.collect()}


def test_classes_of_edge_cases(edge_docs):
    rows = probminhash.digest(edge_docs).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute.classes(EDGE_DOCS)
    assert len(rows) == len(EDGE_DOCS)


def test_classes_of_smoke_documents(smoke_docs, smoke_rows):
    assert classes_of(probminhash.digest(smoke_docs)) == brute.classes(smoke_rows)


def test_copies_near_copies_and_chains(spark):
    base = numbered(1, 400)
    docs = [(100 + i, base) for i in range(50)]
    docs += [(200 + i, changed(base, 0.01, i)) for i in range(40)]
    docs += [(300 + i, changed(base, 0.2, 50 + i)) for i in range(10)]
    text = numbered(2, 300)  # each link of the chain is similar to the next one only
    for i in range(25):
        docs.append((400 - i, text))
        text = " ".join([*text.split()[12:], *numbered(1000 + i, 12).split()])
    # repeated words weigh
    docs += [(501, numbered(5, 60) + " a b c d e" * 30), (502, numbered(5, 60)), (503, numbered(5, 60) + " a b c d e" * 32)]
    random.Random(1).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert classes_of(probminhash.digest(df)) == brute.classes(docs)


def test_one_of_each_class_stays(spark, edge_docs):
    out = probminhash.keep_first(edge_docs)
    assert out.columns == edge_docs.columns
    want = sorted(i for i, root in brute.classes(EDGE_DOCS).items() if i == root)
    assert sorted(r.doc_id for r in out.collect()) == want


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, numbered(1, 50)), (None, numbered(2, 50)), (7, numbered(1, 50)), (None, None)], "doc_id long, text string")
    rows = probminhash.near_duplicates(docs).collect()
    assert len(rows) == 4 and len({r.class_id for r in rows}) == 3


def test_texts_of_one_id_are_documents_of_their_own(spark):
    """Both survive unless they are alike, and copies of either find it."""
    a, b, c = numbered(1, 60), numbered(2, 60), numbered(3, 60)
    rows = [(5, a), (5, b), (5, b), (5, None), (5, ""), (6, b), (7, changed(a, 0.005, 1)), (8, c), (8, f"  {c}"), (9, c), (9, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("part", "node", "content")})
    found: dict[int, set] = {}
    classes = probminhash._classes(docs, 0.8, 5, 24, 4, "doc_id", "text").join(
        docs.select(probminhash.doc_key().alias("doc_key"), probminhash._part(F.col("text")).alias("part"), "text").distinct(), ["doc_key", "part"]
    )
    for r in classes.collect():
        found.setdefault(r.class_id, set()).add((r.doc_key, (r.text or "").strip()))
    groups = sorted(sorted(g) for g in found.values())
    assert groups == sorted([[(5, "")], sorted([(5, a), (7, rows[6][1]), (9, a)]), sorted([(5, b), (6, b)]), sorted([(8, c), (9, c)])])
    kept = probminhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, (r.text or "").strip()) for r in kept.collect()) == sorted([(5, ""), (5, a), (5, b), (8, c)])
    assert probminhash.digest(docs).count() == len(rows)


def test_no_documents(no_docs):
    assert probminhash.keep_first(no_docs).collect() == []


def test_signatures_estimate_the_similarity():
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base), " ".join(base[:200] + [f"v{i}" for i in range(150)]), " ".join(base[40:] + base[50:120])]
    words = split_words(pa.array(texts), NOT_SPACE, lower=True)
    signature = probminhash.signatures(*probminhash.shingles(words, 5), 3, 4000)
    for a, b in ((0, 1), (0, 2), (1, 2)):
        exact = brute.probability_jaccard(*(brute.shingle_weights(texts[i]) for i in (a, b)))
        x, y = (probminhash.weights(pa.array([texts[i]]), 5)[0] for i in (a, b))
        assert probminhash.probability_jaccard(x, y) == pytest.approx(exact)
        assert (signature[a] == signature[b]).mean() == pytest.approx(exact, abs=0.04)


def test_a_text_has_one_signature_whatever_stands_beside_it():
    texts = [numbered(1, 30), "one", numbered(2, 500)]
    alone = [probminhash.signatures(*probminhash.shingles(split_words(pa.array([t]), NOT_SPACE, True), 5), 1, 96)[0] for t in texts]
    together = probminhash.signatures(*probminhash.shingles(split_words(pa.array(texts), NOT_SPACE, True), 5), 3, 96)
    assert np.array_equal(np.array(alone), together)


def met(spark, texts, threshold):
    """Pairs that the prefix index lets through, of texts each a class of its own."""
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    fronts = probminhash._fronts(probminhash._each(rows.select("node"), rows, 5), threshold)
    return {(r.a, r.b) for r in probminhash._met(fronts.withColumn("class", F.col("node")), threshold).collect()}


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
@pytest.mark.parametrize("repeats", [False, True])
def test_prefix_index_loses_no_pair(spark, threshold, repeats):
    """Texts with edits, cuts and moved halves; words that repeat give shingles of other weights."""
    pick = random.Random(6 + repeats)
    texts = [[f"w{i % 50}" if repeats else f"w{i}" for i in range(90)] + [f"v{i}" for i in range(60)]]
    for _ in range(60):
        rate = pick.choice([0.001, 0.01, 0.03])
        text = [w if pick.random() > rate else f"z{pick.randrange(40)}" for w in pick.choice(texts)]
        cut = pick.randrange(1, max(2, len(text) // 4))
        kinds = [text, text, text[cut:] + text[:cut], text[cut:], text[:-cut]] + [text + text[:cut], text[:cut] * 3 + text] * repeats
        texts.append(pick.choice(kinds))
    texts += [["one"], ["one", "two"], ["one"], ["a"] * 30, ["a"] * 40, ["a"] * 40 + ["b"]]
    texts = [" ".join(t) for t in texts]
    weighed = [brute.shingle_weights(text) for text in texts]
    pairs = [(a, b) for b in range(len(texts)) for a in range(b)]
    exact = {p: brute.probability_jaccard(weighed[p[0]], weighed[p[1]]) for p in pairs if weighed[p[0]].keys() & weighed[p[1]].keys()}
    similar = {p for p, j in exact.items() if j >= threshold}
    found = met(spark, texts, threshold)
    assert similar <= found and len(similar) > 5
    assert len(found) < len(exact) * 0.9


def test_copies_with_edits_of_their_own_do_not_meet(spark):
    """Each pair of the group is just too far apart; no pair of them is compared."""
    base = numbered(1, 150)
    texts = [changed(base, 0.035, 10 + i) for i in range(400)]
    weighed = [brute.shingle_weights(text) for text in texts]
    own = [i for i in range(400) if len(weighed[i].keys() - brute.shingle_weights(base).keys()) > 0.125 * len(weighed[i])]
    assert len(own) > 200
    pairs = met(spark, texts, 0.8)
    assert not any(a in own and b in own for a, b in pairs)


def test_components(spark):
    links = [(1, 2), (3, 2), (5, 4), (5, 5), (9, 8), (8, 7), (7, 6), (6, 9), (2, 1)] + [(20 + i, 21 + i) for i in range(40)]
    found = rows_of(components(spark.createDataFrame(links, "a long, b long")))
    assert found == sorted([(2, 1), (3, 1), (5, 4), (7, 6), (8, 6), (9, 6)] + [(21 + i, 20) for i in range(40)], key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

import math

import pytest
from pyspark.sql import functions as F

from marquee.llm import quality
from tests.llm import brute
from tests.llm.conftest import EDGE_DOCS, expected, numbered, rows_of


def floor_bin(v):
    drop = max(0, len(f"{v:b}") - 5)
    return v >> drop << drop


def blend(value, *narrower):
    """The quantile of all, then of the language and of the group, each as far as its texts go."""
    for own, docs in narrower:
        share = min(docs, quality.MIN_DOCS)
        value = (share * own + (quality.MIN_DOCS - share) * value) // quality.MIN_DOCS
    return value


def plain(rows):
    """The contract and the adaptive rules on (doc_id, text, lang, source)."""
    base = [(i, lang or "", source or "", brute.base_measures(text)) for i, text, lang, source in rows]
    measures = []
    for _, lang, source, (n, chars, symbols, dup, repeat, failed) in base:
        values = {"symbols": 1000 * symbols // max(chars, 1), "dup_lines": 1000 * dup // max(n, 1)}
        values |= {"repeats": 1000 * repeat // max(n, 1), "word_length": 100 * chars // max(n, 1)}
        measures.append(values)

    def quantile(name, keep, parts):
        bins = sorted(floor_bin(m[name]) for m, b in zip(measures, base) if not b[3][5] and keep(b))
        return bins[math.ceil(len(bins) / parts) - 1], len(bins)

    for (i, lang, source, own), values in zip(base, measures):
        kept = not own[5]
        for name, fence in quality.FENCES.items() if kept else ():
            lower, median = (
                blend(quantile(name, lambda b: True, parts)[0], quantile(name, lambda b: b[1] == lang, parts), quantile(name, lambda b: b[1:3] == (lang, source), parts))
                for parts in (4, 2)
            )
            reach = fence.times * max(median - lower, fence.least)
            kept = kept and values[name] <= median + reach and (not fence.below or values[name] >= median - reach)
        yield i, *own, kept


def shown(df):
    return rows_of(df.select("doc_id", *quality.BASE, "base_failed", "kept"))


def edge_rows(edge_docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in edge_docs.collect()]


def test_digest_of_edge_cases(edge_docs):
    assert shown(quality.digest(edge_docs)) == expected(plain(edge_rows(edge_docs)))


def test_digest_of_smoke_documents(smoke_docs):
    rows = [tuple(r) for r in smoke_docs.select("doc_id", "text", "lang", "source").collect()]
    assert shown(quality.digest(smoke_docs)) == expected(plain(rows))


def test_thresholds_follow_their_group(spark):
    """A source of code has symbols in every text; there they are no sign of junk."""
    rows = [(i, numbered(i, 80) + " ## " * (i % 3), "en", "prose") for i in range(150)]
    rows += [(1000 + i, " ".join(f"{w}##" for w in numbered(i, 80).split()), "en", "code") for i in range(150)]
    rows += [(2000, " ".join(f"{w}##" for w in numbered(5000, 80).split()), "en", "prose"), (2001, " ".join(f"{w}##" for w in numbered(5001, 80).split()), "en", "small")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality.digest(df).collect()}
    assert shown(quality.digest(df)) == expected(plain(rows))
    assert not got[2000] and all(kept for i, kept in got.items() if i < 2000)


@pytest.mark.parametrize("value", [0, 1, 15, 31, 32, 33, 63, 64, 1000, 123456789])
def test_bins(spark, value):
    got = spark.range(1).select(quality.bin_of(F.lit(value).cast("long"))).first()[0]
    assert got == floor_bin(value) and got <= value <= got * 17 / 16


def test_sketches_merge(spark, smoke_docs):
    base = quality.with_base(smoke_docs).withColumn("half", F.col("doc_id") % 2)
    parts = [quality.sketches(base.where(f"half = {h}")) for h in (0, 1)]
    merged = quality.merge(parts[0].union(parts[1]), "lang", "source").select("lang", "source", "measure", "bin", "n")
    assert rows_of(merged) == rows_of(quality.sketches(base).select("lang", "source", "measure", "bin", "n"))


def test_a_filter_behind_the_measures_does_not_take_them_again(smoke_docs):
    base = quality.with_base(smoke_docs)
    rows = [brute.base_measures(r.text) for r in smoke_docs.collect()]
    assert base.where("not base_failed and n_dup_lines > 0").count() == sum(not r[5] and r[3] > 0 for r in rows)


def test_small_groups_count_as_far_as_they_go(spark):
    """38 texts of a source with symbols move its threshold 38 parts of 100 from that of the language."""
    rows = [(i, numbered(i, 80), "en", "prose") for i in range(400)]
    rows += [(1000 + i, numbered(i, 80) + " ########" * 3, "en", "code") for i in range(38)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    base = quality.with_base(df)
    limits = {r.source: r.symbols_most for r in quality.thresholds(quality.sketches(base)).collect()}
    own = floor_bin(1000 * 24 // (sum(map(len, numbered(20, 80).split())) + 24))
    assert limits["prose"] == 60 and limits["code"] == own * 38 // 100 + 60
    assert shown(quality.digest(df)) == expected(plain(rows))


def test_a_large_group_is_dealt_over_tasks(spark, smoke_docs, set_conf):
    """Where thresholds are not broadcast, rows of one language and source go to many keys."""
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    set_conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    one = smoke_docs.withColumns({"lang": F.lit("en"), "source": F.lit("web")})
    joined = quality.digest(one)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("pmod(xxhash64(n_words") > 0
    rows = [(r.doc_id, r.text, "en", "web") for r in smoke_docs.collect()]
    assert shown(joined) == expected(plain(rows))


def test_kept_rows_have_all_their_columns(edge_docs):
    out = quality.keep_good(edge_docs)
    assert out.columns == edge_docs.columns
    want = sorted(r[0] for r in plain(edge_rows(edge_docs)) if r[-1])
    assert sorted(r.doc_id for r in out.collect()) == want


def test_nothing_but_functions_in_the_plan(smoke_docs):
    plan = quality.digest(smoke_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_documents(no_docs):
    assert quality.digest(no_docs).collect() == []
    assert quality.keep_good(no_docs).collect() == []

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.llm import urls
from tests.llm.conftest import SMOKE_DIR

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    host, rest = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
    ends = [i for i in (rest.find(c) for c in "?#") if i >= 0]
    path = rest[: min(ends)] if ends else rest
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def best_rule(host, path):
    fits = [
        (len(text), text, verdict)
        for text, verdict in RULES
        for h, p in [text.split("/", 1)]
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p)
    ]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "nothing", "http://", "http://com", "http://com/", "https://Example.COM/en/x", "http://www.example.com/en/x?y", "http://a.www.example.com/en/",
    "http://notexample.com/en/", "http://b.net/es", "http://b.net/es/", "x://net/fr/#?", "http://org/en/", "ftp://a.org?x://b.com/", "http://ÄB.com/ä",
    "http://a.com:80/en/", "http://a\nb.com/en/\n", "http://long.org/" + "x" * 20000, "http://a.org/😀",
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u) for i, u in enumerate([*URLS, URLS[3], URLS[6]])] + [(None, "http://null.org/id")]
    return spark.createDataFrame(rows, "page_id long, url string").withColumns({n: F.lit("x") for n in ("host", "rule", "verdict", "score", "url_key", "gram")})


def test_hosts_paths_and_rules(pages):
    for r, url in zip(urls.judge(pages).orderBy(F.col("page_id").asc_nulls_last()).collect(), [*URLS, URLS[3], URLS[6], "http://null.org/id"]):
        host, path = host_path(url)
        rule, verdict = best_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
        assert url or r.verdict == "allow"


def model(labelled, order=urls.ORDER):
    """Counts of characters by context, for accepted and rejected urls."""
    counts = {True: defaultdict(Counter), False: defaultdict(Counter)}
    for url, accepted in labelled:
        text = urls.START * order + url + urls.END
        for i in range(order, len(text)):
            for k in range(order + 1):
                counts[accepted][text[i - k : i]][text[i]] += 1
    return counts


def log_p(seen, context, char):
    p = 1 / urls.ALPHABET
    for k in range(len(context) + 1):
        own = seen.get(context[len(context) - k :])
        if own:
            p = (own[char] + len(own) * p) / (sum(own.values()) + len(own))
    return math.log(p)


def score(counts, url, order=urls.ORDER):
    text = urls.START * order + url + urls.END
    ratios = [log_p(counts[True], text[i - order : i], text[i]) - log_p(counts[False], text[i - order : i], text[i]) for i in range(order, len(text))]
    return sum(ratios) / len(ratios)


def test_scores_threshold_and_verdicts_of_smoke_pages(spark):
    pages = spark.read.parquet(f"{SMOKE_DIR}/pages.parquet")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    rows = pages.select("page_id", "url", (F.pmod(F.xxhash64("url"), F.lit(urls.HELD_OUT)) == 0).alias("held")).collect()
    assert len(got) == len(rows)
    ruled = {r.url: best_rule(*host_path(r.url))[1] for r in rows}
    held = {r.url for r in rows if r.held}
    counts = model([(u, v == "allow") for u, v in ruled.items() if v and u not in held])
    scores = {u: score(counts, u) for u in ruled}
    for r in rows:
        assert got[r.page_id].score == pytest.approx(scores[r.url], abs=0.0006)
    rounded = {r.url: got[r.page_id].score for r in rows}
    judged = [(rounded[u], ruled[u] == "allow") for u in held if ruled[u]]
    accepted, rejected = sum(a for _, a in judged), sum(not a for _, a in judged)
    threshold = 0.0
    if accepted and rejected:
        def gain(t):
            return sum(a and s >= t for s, a in judged) / accepted + sum(not a and s < t for s, a in judged) / rejected

        least = min((-gain(t), t) for t, _ in judged)[1]
        threshold = (least + max([t for t, _ in judged if t < least], default=least)) / 2
    for r in rows:
        assert got[r.page_id].verdict == (ruled[r.url] or ("allow" if rounded[r.url] >= threshold else "block"))


def test_model_separates_what_the_rules_do_not_see(spark):
    """Labels teach the model; urls of other hosts that look like either kind follow."""
    rows = [f"http://h{i}.com/de/article-{i * 37}" for i in range(200)] + [f"http://h{i}.net/es/win-cash-{i * 37}" for i in range(200)]
    rows += [f"http://x{i}.org/de/article-{i}" for i in range(30)] + [f"http://x{i}.org/es/win-cash-{i}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    verdicts = [r.verdict for r in urls.judge(df).orderBy("page_id").collect()][400:]
    assert verdicts == ["allow"] * 30 + ["block"] * 30


def test_no_pages_and_no_labels(spark, pages):
    assert urls.judge(pages.limit(0)).collect() == []
    plain = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.org/")], "page_id long, url string")
    assert {r.verdict for r in urls.judge(plain).collect()} == {"allow"}


@pytest.mark.parametrize("end", ["com", "net/es"])
def test_labels_of_one_kind_block_nothing(spark, end):
    rows = [(i, f"http://h{i}.{end}/page{i}") for i in range(100)] + [(200, "http://x.org/a"), (201, "http://y.org/win-cash"), (202, None)]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [(got[i].verdict, got[i].score) for i in (200, 201, 202)] == [("allow", 0.0), ("allow", 0.0), ("allow", None)]


def test_one_kind_kept_for_calibration(spark):
    """The threshold is 0: each url goes with the model that finds it likelier."""
    rows = [f"http://h{i}.com/de/article-{i * 37}" for i in range(200)]
    blocked = [f"http://h{i}.net/es/win-cash-{i * 37}" for i in range(200)]
    df = spark.createDataFrame([(u,) for u in blocked], "url string")
    held = {r.url for r in df.where(F.pmod(F.xxhash64("url"), F.lit(urls.HELD_OUT)) == 0).collect()}
    rows += [u for u in blocked if u not in held] + ["http://x.org/de/article-5", "http://x.org/es/win-cash-5"]
    got = urls.judge(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")).orderBy("page_id").collect()
    assert [r.verdict for r in got[-2:]] == ["allow", "block"] and got[-2].score > 0 > got[-1].score

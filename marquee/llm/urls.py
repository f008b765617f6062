"""URL filters: host and path rules, and a character language-model ratio where no rule holds.

Two variable-order Markov models over the characters of urls, one of accepted and one of
rejected urls, are counted over all urls that a rule decides, but for a tenth kept for calibration. Orders 0
to ``ORDER`` are interpolated by Witten-Bell: an order weighs what its
context has seen, and the next lower order as much as the different characters seen
there; an unseen context leaves all to the lower order. A url's score is the mean over its characters of
log P(accepted) - log P(rejected). The threshold is where the scores of the urls kept
for calibration are split best: the highest sum of accepted urls kept and rejected urls
blocked, as shares, midway between the two scores on either side.

Only windows of ``ORDER + 1`` characters are counted and shuffled, and pre-aggregated; lower orders are sums of them. The
model is a table joined by window, so it may grow with the corpus.

Rows: a null url, and an empty one, has empty host and path, no rule, no characters and
no score, and is allowed; repeated rows are judged each; null ids stay null. Without labelled urls of both
kinds to count all scores are 0 and the threshold is 0, so all are allowed; without both kinds among the urls kept for calibration
the threshold is 0, where both models find a url equally likely.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written

ORDER = 4
# Characters that the uniform model below order 0 takes for possible.
ALPHABET = 256
START, END = "\u0002", "\u0003"
# Characters, with what they follow, that are asked for by so many urls that they are salted.
SHORT, SALTS = 2, 32
# Urls that a task cuts into windows, about.
URLS_A_TASK = 10_000
HELD_OUT = 10
# Scores are compared in steps of 1/SCALE, so the calibration table is bounded by the range of scores.
SCALE = 1000


class Rule(NamedTuple):
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return f"{self.host}/{self.path}"


def rule(text: str, allow: bool) -> Rule:
    """A rule like ``example.com/en/``: a host with its subdomains, and a start of the path."""
    host, _, path = text.partition("/")
    return Rule(host.lower(), path, allow)


RULES = [
    rule("com/", True),
    rule("example.com/en/", False),
    rule("www.example.com/en/", True),
    rule("net/es/", False),
    rule("net/fr/", False),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), tail


def _best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``text`` and ``allow`` of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<text:string,allow:boolean>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith("/" + r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.allow).alias("allow"))).otherwise(out)
    return out


def windows(urls: DataFrame, order: int, *keep: str) -> DataFrame:
    """``keep`` and ``gram``: for each character of a url, and its end, it and the ``order`` before it."""
    padded = F.concat(F.lit(START * order), F.col("url"), F.lit(END))
    # a column of its own: within the lambda the split would be made again for each character
    split = urls.where("url != ''").select(*keep, F.split(padded, "").alias("chars"))
    places = F.sequence(F.lit(1), F.size("chars") - order)
    return split.select(*keep, F.explode(F.transform(places, lambda i: F.array_join(F.slice("chars", i, order + 1), ""))).alias("gram"))


def train(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n_accept, n_reject`` of every window of ``url, accepted``."""
    grams = windows(labelled, order, "accepted")
    return grams.groupBy("gram").agg(F.count_if("accepted").alias("n_accept"), F.count_if(~F.col("accepted")).alias("n_reject"))


def log_ratios(counts: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio``: log P(accepted) - log P(rejected) of the last character of each ``gram`` of ``wanted``."""
    # counts of all lower orders, by their last k + 1 characters
    by_order = counts.select(
        "n_accept", "n_reject", F.explode(F.transform(F.sequence(F.lit(1), F.lit(order + 1)), lambda k: F.expr("gram").substr(-k, k))).alias("part")
    )
    parts = written(by_order.groupBy("part").agg(F.sum("n_accept").alias("a"), F.sum("n_reject").alias("r")), "parts")
    context = F.expr("left(part, char_length(part) - 1)")
    contexts = parts.groupBy(context.alias("context")).agg(
        F.sum("a").alias("ca"), F.sum("r").alias("cr"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr")
    )
    # Every url asks for the shortest ones: they are dealt over salted copies.
    short = F.char_length("part") <= SHORT
    asked = wanted.select("gram", F.explode(F.transform(F.sequence(F.lit(1), F.lit(order + 1)), lambda k: F.expr("gram").substr(-k, k))).alias("part"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("a", "r", "ca", "cr", "ta", "tr")}
    copies = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salt = F.when(short, F.pmod(F.xxhash64("gram"), F.lit(SALTS)).cast("int")).otherwise(0)
    parts = parts.withColumn("salt", F.explode(F.when(short, copies).otherwise(F.array(F.lit(0)))))
    contexts = contexts.withColumn("salt", F.explode(F.when(F.char_length("context") < SHORT, copies).otherwise(F.array(F.lit(0)))))
    seen = (
        asked.withColumn("salt", salt)
        .join(parts, ["part", "salt"], "left")
        .withColumn("context", context)
        .join(contexts, ["context", "salt"], "left")
        .groupBy("gram")
        .agg(F.sort_array(F.collect_list(F.struct(F.char_length("part").alias("k"), *(c.alias(n) for n, c in zero.items())))).alias("orders"))
    )

    def log_p(n: str, of: str, kinds: str) -> Column:
        step = f"(p, o) -> case when o.{of} = 0 then p else (o.{n} + o.{kinds} * p) / (o.{of} + o.{kinds}) end"
        return F.ln(F.expr(f"aggregate(orders, cast(1 as double) / {ALPHABET}, {step})"))

    return seen.select("gram", (log_p("a", "ca", "ta") - log_p("r", "cr", "tr")).alias("ratio"))


def scores(urls: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``url_key, score`` of the different urls of ``url_key, url``: the mean ratio, rounded to 1/SCALE."""
    split = windows(urls, order, "url_key")
    ratios = log_ratios(counts, split.select("gram").distinct(), order)
    mean = F.sum("ratio") / F.count("*")
    return split.join(ratios, "gram").groupBy("url_key").agg((F.round(mean * SCALE) / SCALE).alias("score"))


def calibrate(scored: DataFrame) -> float:
    """The threshold on ``score`` that best splits ``accepted`` from the rest; one row per distinct score is compared."""
    by_score = scored.groupBy("score").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
    rows = sorted(by_score.where("score is not null").collect())
    accepted, rejected = sum(row.a for row in rows), sum(row.r for row in rows)
    if not accepted or not rejected:
        return 0.0
    best, threshold, kept, blocked, below = 1.0, rows[0].score, accepted, 0, rows[0].score
    for row in rows:  # urls below the threshold are blocked; it lies midway between two scores
        gain = kept / accepted + blocked / rejected
        if gain > best:
            best, threshold = gain, (below + row.score) / 2
        below = row.score
        kept, blocked = kept - row.a, blocked + row.r
    return threshold


def judge(pages: DataFrame, rules: list[Rule] = RULES, id_col: str = "page_id", url_col: str = "url", order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rows = rows.withColumn("best", _best_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select("page_id", "url", "host", "path", F.col("best.text").alias("rule"), F.col("best.allow").alias("allowed"))
    # different urls, each once: many pages may share one
    urls = rows.groupBy("url").agg(F.first("allowed").alias("accepted"))
    keyed = urls.where("url is not null").select(_url_key().alias("url_key"), "url", "accepted")
    # each url becomes a row a character: by bytes alone a few tasks would read them all
    keyed = written(keyed.repartition(-(-rows.count() // URLS_A_TASK) or 1, "url_key"), "urls")
    held_out = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    labelled = keyed.where("accepted is not null")
    counted = labelled.where(~held_out)
    if counted.select("accepted").distinct().count() == 2:
        scored = written(scores(keyed, written(train(counted, order), "grams"), order), "scores")
    else:  # one model alone says nothing about the other kind
        scored = keyed.where("url != ''").select("url_key", F.lit(0.0).alias("score"))
    threshold = calibrate(labelled.where(held_out).join(scored, "url_key"))
    verdict = F.coalesce("allowed", F.col("score") >= threshold, F.lit(True))
    judged = rows.withColumn("url_key", _url_key()).join(scored, "url_key", "left")
    return judged.select("page_id", "host", "path", "rule", F.when(verdict, "allow").otherwise("block").alias("verdict"), "score")


def _url_key() -> Column:
    return F.unhex(F.md5("url"))

"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is a run of at least ``MIN_CHARS`` characters of keys and tokens that holds a digit or, where asked for, a known
key; a word may hold any number of them. Of ``name=value`` it is the value, if that is a candidate.
The forest sees its length, its character classes and their transitions, how much of it
corpus words cover, path marks in it and in the path of the document, and the words
beside it. The dictionary is the lower-case words found in at least ``DICTIONARY_DOCS``
documents, counted over all documents.

The forest learns from labelled findings: those given, or, without any, those that a rule can decide
by format alone (known key formats; addresses, numbers and the like). At most ``TRAIN_ROWS`` different
findings are used, the first by hash; this bound is the only one. The verdict on a labelled
finding is its label; the forest decides the rest.

Everything is DataFrame functions and the JVM's forest. Rows: a null or empty text has no candidates; repeated rows are
scanned each; null ids stay null. Without findings of both labels no forest is grown and unlabelled findings are kept.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written

MIN_CHARS = 16
DICTIONARY_DOCS = 5
MIN_FRAGMENT = 3
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 11
SPACES = r"[\x20\x09-\x0D]+"
_RUN = "[A-Za-z0-9+/=_.@-]"
_DIGIT = "(?=[A-Za-z+/=_.@-]*[0-9])"
CORE = rf"(?<!{_RUN}){_DIGIT}{_RUN}{{{MIN_CHARS},}}"

# Formats that are secrets, or are not, whatever stands beside them.
_KEY_SHAPES = [
    "(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "gh[pousr]_[A-Za-z0-9]{36,}",
    "xox[abprs]-[A-Za-z0-9-]{10,}",
    "AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])",
]
KEY_FORMATS = [rf"(?<![A-Za-z0-9]){shape}" for shape in _KEY_SHAPES]
SHORTEST_KEY = 15
# Candidates, and known keys without a digit.
CORE_OR_KEY = rf"(?<!{_RUN})(?:{_DIGIT}{_RUN}{{{MIN_CHARS},}}|(?={_RUN}*?(?:{'|'.join(KEY_FORMATS)})){_RUN}{{{SHORTEST_KEY},}})"
NAME = r"^[A-Za-z_][A-Za-z0-9_.-]*=(?=[^=])"
EMAIL = r"^[A-Za-z0-9._+-]+@[A-Za-z0-9-]+[.][A-Za-z0-9.-]+$"
# Repeated groups are possessive: others recurse in Java, once a part, and a long word would exhaust the stack.
HARMLESS_FORMATS = [r"^[0-9._+/=-]+$", r"^[a-z]++(?:[.][a-z0-9]++)++$", r"^/?(?:[a-z]++/)++[a-z]*+$"]
HEX_DIGEST = r"^[0-9a-f]{32,}$"
# Words that name a secret, and signs that assign one.
NAMING = r"(?i)(token|secret|passw|api_?key|apikey|auth|credential|access_?key)"
ASSIGNING = r"^(=|:|:=|=>|->)$"
TEST_PATH = r"(?i)(test|example|sample|fixture|doc)"

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def candidates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", digitless_keys: bool = False
) -> DataFrame:
    """``doc_id, path, position, part, token, lead, core, before1, before2, after``.

    ``position`` is the number of the word and ``part`` that of the candidate in it, ``lead`` what stands between the
    candidate before and this one, ``token`` the same with this one and, behind the last, the rest of the word.
    """
    pattern, least = (CORE_OR_KEY, SHORTEST_KEY) if digitless_keys else (CORE, MIN_CHARS)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(path_col).cast("string").alias("path"),
        F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), SPACES), "").alias("words"),
    )
    words = F.col("words")
    places = rows.withColumn(
        "places",
        F.array_compact(F.transform(words, lambda w, i: F.when((F.length(w) >= least) & w.rlike(pattern), i))),
    )
    found = places.select(
        "doc_id",
        "path",
        F.transform(
            "places",
            lambda i: F.struct(
                i.alias("position"),
                F.get(words, i).alias("token"),
                F.coalesce(F.get(words, i - 1), F.lit("")).alias("before1"),
                F.coalesce(F.get(words, i - 2), F.lit("")).alias("before2"),
                F.coalesce(F.get(words, i + 1), F.lit("")).alias("after"),
            ),
        ).alias("found"),
    )
    each = found.select("doc_id", "path", F.explode("found").alias("f")).select("doc_id", "path", "f.*")
    split = each.withColumns({"runs": F.regexp_extract_all("token", F.lit(pattern), F.lit(0)), "gaps": F.split("token", pattern, -1)})
    zipped = F.arrays_zip("runs", "gaps", F.slice("gaps", F.lit(2), F.size("runs")).alias("rests"))
    beside = ["doc_id", "path", "position", "before1", "before2", "after"]
    parts = split.select(*beside, F.size("runs").alias("n"), F.posexplode(zipped).alias("part", "p")).where("part < n")
    run, lead = F.col("p.runs"), F.col("p.gaps")
    rest = F.when(F.col("part") == F.col("n") - 1, F.col("p.rests")).otherwise("")
    value = F.regexp_replace(run, NAME, "")
    core = F.when(value.rlike(pattern), value).otherwise(run)
    return parts.select(*beside, "part", F.concat(lead, run, rest).alias("token"), lead.alias("lead"), core.alias("core"))


def dictionary(docs: DataFrame, text_col: str = "text", min_docs: int = DICTIONARY_DOCS) -> DataFrame:
    """``fragment`` of every word of ASCII letters found in enough documents."""
    words = F.array_distinct(F.split(F.lower(F.col(text_col)), r"[^a-z]+"))
    each = docs.select(F.explode(words).alias("fragment")).where(F.length("fragment") >= MIN_FRAGMENT)
    return each.groupBy("fragment").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("fragment")


def covered(cores: DataFrame, known: DataFrame) -> DataFrame:
    """``core, covered``: characters of each core that lie in known words."""
    fragments = cores.select("core", F.explode(F.split(F.lower("core"), r"[^a-z]+")).alias("fragment")).where(F.length("fragment") >= MIN_FRAGMENT)
    return fragments.join(known, "fragment").groupBy("core").agg(F.sum(F.length("fragment")).alias("covered"))


def _share(of: Column, characters: str) -> Column:
    return (F.length(of) - F.length(F.translate(of, characters, ""))) / F.length(of)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def features() -> dict[str, Column]:
    core, size = F.col("core"), F.length("core")
    classes = F.translate(core, LOWER + UPPER + DIGITS, "a" * 26 + "A" * 26 + "0" * 10)
    runs = F.length(F.regexp_replace(classes, r"(.)\1*", "x"))
    letters = r"^\p{L}+[.,;:!?]?$"
    return {
        "size": size.cast("double"),
        "lower": _share(core, LOWER),
        "upper": _share(core, UPPER),
        "digits": _share(core, DIGITS),
        "transitions": (runs - 1) / (size - 1),
        "different": F.size(F.array_distinct(F.split(core, ""))) / size,
        "covered": F.coalesce(F.col("covered"), F.lit(0)) / size,
        "slashes": _share(core, "/"),
        "dots": _share(core, ".@"),
        "test_path": _flag(F.col("path").rlike(TEST_PATH)),
        "quoted": _flag(F.col("token").rlike("^[\"'`]")),
        "assigned": _flag(F.col("before1").rlike(ASSIGNING) | F.col("token").rlike(r"^[^A-Za-z0-9]*[A-Za-z_][A-Za-z0-9_-]*[\"']?[=:]")),
        "named": _flag(F.col("before1").rlike(NAMING) | F.col("before2").rlike(NAMING) | F.col("token").rlike(NAMING)),
        "word_before": _flag(F.col("before1").rlike(letters)),
        "word_after": _flag(F.col("after").rlike(letters)),
    }


def format_label() -> Column:
    """1 for a known key format or a named, assigned digest, 0 for harmless formats, else null."""
    core = F.col("core")

    def any_of(patterns: list[str]) -> Column:
        out = F.lit(False)
        for pattern in patterns:
            out = out | core.rlike(pattern)
        return out

    digest = core.rlike(HEX_DIGEST) & (F.col("assigned") > 0) & (F.col("named") > 0)
    # behind a colon an address may be a password and its host
    address = core.rlike(EMAIL) & (~F.col("lead").rlike(":$") | F.col("lead").rlike("(?i)mailto:$"))
    return F.when(any_of(KEY_FORMATS) | digest, 1.0).when(any_of(HARMLESS_FORMATS) | address, 0.0)


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    digitless_keys: bool = False,
) -> DataFrame:
    """``doc_id, position, part, core, score, is_secret`` of every candidate.

    ``labelled``: ``core, label`` of reviewed findings; by format where it is not given.
    """
    findings = labelled_findings(docs, labelled, id_col, text_col, path_col, digitless_keys)
    model = fit(findings)
    if model is None:
        scored = findings.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = score(model, findings)
    is_secret = F.coalesce(F.col("label") == 1, F.col("score") >= 0.5, F.lit(True))
    return scored.select("doc_id", "position", "part", "core", "score", is_secret.alias("is_secret"))


def labelled_findings(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    digitless_keys: bool = False,
) -> DataFrame:
    """Every candidate with its features and, where it is known, its ``label``."""
    found = written(candidates(docs, id_col, text_col, path_col, digitless_keys), "candidates")
    cover = covered(found.select("core").distinct(), dictionary(docs, text_col))
    # the shape features keep their names apart from the columns they are made of
    measured = found.join(cover, "core", "left").select("doc_id", "position", "part", "lead", "core", *(c.alias(n) for n, c in features().items()))
    if labelled is None:
        with_label = measured.withColumn("label", format_label())
    else:
        known = labelled.groupBy("core").agg(F.max("label").cast("double").alias("label"))
        with_label = measured.join(known, "core", "left")
    return written(with_label, "findings")


def fit(findings: DataFrame) -> RandomForestClassificationModel | None:
    """The forest of at most ``TRAIN_ROWS`` different labelled findings, the first by hash; none without both labels."""
    names = list(features())
    order = [F.xxhash64("core", *names), *(F.col(n) for n in ["core", *names])]
    known = findings.where("label is not null").select("core", "label", *names).distinct().orderBy(*order).limit(TRAIN_ROWS)
    known = written(known, "training")
    if known.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    return forest.fit(_vectors().transform(known.coalesce(1)))


def score(model: RandomForestClassificationModel, findings: DataFrame) -> DataFrame:
    """The findings with the forest's ``score``."""
    return model.transform(_vectors().transform(findings)).withColumn("score", F.round(vector_to_array("probability")[1], 6))


def _vectors() -> VectorAssembler:
    return VectorAssembler(inputCols=list(features()), outputCol="features")


def held_out(findings: DataFrame, parts: int = 5) -> DataFrame:
    """``n, secrets, precision, recall`` of the forest on labelled findings it has not seen: one part of them by hash of the finding.

    What equals a finding lies in its part, so nothing is known from another place.
    """
    apart = F.pmod(F.xxhash64("core", F.lit("held out")), F.lit(parts)) == 0
    model = fit(findings.where(~apart))
    if model is None:
        raise ValueError("labels of one kind only")
    asked = score(model, findings.where(apart & F.col("label").isNotNull()))
    says, is_so = F.col("score") >= 0.5, F.col("label") == 1
    both = F.count_if(says & is_so)
    return asked.agg(
        F.count("*").alias("n"),
        F.count_if(is_so).alias("secrets"),
        F.try_divide(both, F.count_if(says)).alias("precision"),
        F.try_divide(both, F.count_if(is_so)).alias("recall"),
    )


def digest(docs: DataFrame, digitless_keys: bool = False) -> DataFrame:
    """The secrets that remain, by digest, so that the result does not carry them."""
    kept = scan(docs, digitless_keys=digitless_keys).where("is_secret")
    return kept.select("doc_id", "position", F.length("core").alias("n_chars"), F.sha2("core", 256).alias("secret_sha256"), "score")

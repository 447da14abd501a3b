"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is a word with a core of CORE or more key characters that has a digit or
mixed classes, or of LONG without either, and every value behind a credential's name, in
its word or in the words before, however short or plain. Its
features are its length, character mix and transitions between character classes, the
share of its letters that dictionary words cover (words of several documents of the
corpus), its path, and the words beside it. A random forest (Spark ML) learns from
labelled findings and scores every candidate.

Only DataFrame functions and Spark ML run. The forest is fitted on at most TRAIN_ROWS
labelled findings, drawn by a hash; the dictionary and the scan cover all documents.

The given tables hold no labels for secrets, so labelled() derives findings whose
label is beyond doubt (published key formats, values assigned to a credential's name;
plain numbers, addresses and mail addresses). Other labels may be passed instead.

Defined results: null and empty texts have no candidates; a null path counts as empty;
without labelled findings of both classes nothing is removed (score 1); repeated rows
repeat their candidates; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import read, saved

CORE, LONG = 12, 20
#: Labelled findings the forest is fitted on, at most about.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED, THRESHOLD = 24, 7, 7, 0.5
#: Documents' occurrences from which a word belongs to the dictionary.
COMMON = 5
NAMES = "password|passwd|pwd|secret|token|api_?key|apikey|access_?key|auth|credential|bearer|private_?key"
IS_NAME = f"(?i)({NAMES})"
OPERATORS = ["=", ":", ":=", "=>", "is"]
#: Words that are candidates whatever stands beside them, besides those with a digit.
MIXED = "[A-Za-z0-9+/_@.:=-]*(?:[a-z][A-Z]|[A-Za-z][+/_@=:]+[A-Za-z])"
OWN = f"(?=[A-Za-z0-9+/_@.:=-]{{{CORE},}}){MIXED}|[A-Za-z0-9+/_@.:=-]{{{LONG},}}|(?i:{NAMES})[\\w.-]*[\"'`]*[=:]+[\"'`]*[^\\s\"'`=:]"

FEATURES = [
    "length", "digits", "uppers", "others", "distinct", "transitions", "hex", "numeric", "covered", "path_parts",
    "path_sample", "named", "assigned", "quoted", "before_named", "before_letters", "after_letters",
]


def candidates(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, path, word_no, word, before2, before, after) of every candidate word."""
    rows = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        F.col(text).cast("string").alias("text"),
    )
    words = F.split("text", r"\s+")
    at = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    # a word that ends in a name or assigns one; or a name, an operator and the value
    behind = lambda i: at(i - 1).rlike(f"(?i)({NAMES})(?:[\"'`]*|.*[=:])$") | (
        at(i - 1).isin(OPERATORS) & at(i - 2).rlike(IS_NAME)
    )
    fits = lambda w, i: (w.rlike("[0-9]") & w.rlike(f"[A-Za-z0-9+/_@.:=-]{{{CORE},}}")) | w.rlike(OWN) | (
        F.col("has_name") & w.rlike(r"[^\s\"'`=:>]") & ~w.isin(OPERATORS) & behind(i)
    )
    places = F.array_compact(F.transform("words", lambda w, i: F.when(fits(w, i), i)))
    found = F.transform(places, lambda i: F.struct(
        i.cast("long").alias("word_no"), at(i).alias("word"), at(i - 2).alias("before2"), at(i - 1).alias("before"),
        at(i + 1).alias("after"),
    ))
    has_name = F.col("text").rlike(IS_NAME)
    return rows.select("doc_id", "path", words.alias("words"), has_name.alias("has_name")).select("doc_id", "path", F.inline(found))


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(part): plain words that occur COMMON times or more in the corpus."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text).cast("string")), r"[^a-z0-9]+")).alias("part"))
    counts = words.filter(F.col("part").rlike("^[a-z]{3,}$")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= COMMON).select("part")


def _share(value: Column, pattern: str) -> Column:
    """Share of a value's characters of a class."""
    return (F.length(value) - F.length(F.regexp_replace(value, pattern, ""))) / F.greatest(F.length(value), F.lit(1))


def described(found: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates with name, value and FEATURES."""
    inner = F.regexp_replace("word", r"^[\"'`(\[{<]+|[\"'`)\]}>.,;!?]+$", "")
    name = F.regexp_extract(inner, r"^([A-Za-z_.-]{2,40})[\"'`]?[=:]", 1)
    value = F.regexp_replace(F.when(name != "", F.regexp_replace(inner, r"^[A-Za-z_.-]{2,40}[\"'`]?[=:]", "")).otherwise(inner),
                             r"^[\"'`]+|[\"'`]+$", "")
    rows = found.withColumn("name", name).withColumn("value", value)
    key = ["doc_id", "path", "word_no", "word"]
    parts = F.array_distinct(F.filter(F.split(F.lower("value"), "[^a-z]+"), lambda p: F.length(p) >= 3))
    # a word's parts are looked up once per different value, not per candidate
    values = rows.select("value").distinct()
    hits = values.select("value", F.explode(parts).alias("part")).join(known, "part").groupBy("value").agg(
        F.sum(F.length("part")).alias("hit")
    )
    rows = rows.join(hits, "value", "left")
    shape = F.col("value")
    for pattern, letter in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), (r"[^aA0]+", "_")):
        shape = F.regexp_replace(shape, pattern, letter)
    size = F.greatest(F.length("value"), F.lit(1))
    operator = F.col("before").isin(OPERATORS)
    made = {
        "length": F.length("value"), "digits": _share(F.col("value"), "[0-9]"), "uppers": _share(F.col("value"), "[A-Z]"),
        "others": _share(F.col("value"), "[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / size, "transitions": (F.length(shape) - 1) / size,
        "hex": F.col("value").rlike("^[0-9a-fA-F]+$"), "numeric": F.col("value").rlike("^[0-9+().:-]+$"),
        "covered": F.coalesce("hit", F.lit(0)) / size, "path_parts": F.size(F.split("path", "[/\\\\]")),
        "path_sample": F.col("path").rlike("(?i)(test|example|sample|fixture|docs?/)"), "named": F.col("name").rlike(IS_NAME),
        "assigned": operator | (F.col("name") != "") | F.col("before").rlike("[=:]$"), "quoted": F.col("word").rlike("^[\"'`]"),
        "before_named": F.col("before").rlike(IS_NAME) | (operator & F.col("before2").rlike(IS_NAME)),
        "before_letters": F.length(F.regexp_replace("before", r"[^\p{L}]", "")),
        "after_letters": F.length(F.regexp_replace("after", r"[^\p{L}]", "")),
    }
    return rows.select(*key, "value", *[made[f].cast("double").alias(f) for f in FEATURES])


def labelled(rows: DataFrame) -> DataFrame:
    """Described candidates whose label is beyond doubt, with label 1.0 or 0.0."""
    value = F.col("value")
    ours = (F.col("named") == 1) | ((F.col("before_named") == 1) & (F.col("assigned") == 1))
    # a short value is beyond doubt with letters and digits, one without digits if it is no dictionary word
    doubtless = F.when(value.rlike("[0-9]"), (F.length("value") >= CORE) | value.rlike("[A-Za-z]")).otherwise(
        (F.length("value") >= CORE) & (F.col("covered") < 0.5)
    )
    yes = value.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$") | value.rlike("^gh[pousr]_[A-Za-z0-9]{36}$") | (
        (F.col("numeric") == 0) & doubtless & ours
    )
    plain = (F.col("covered") >= 1) & (F.col("assigned") == 0)
    no = ((F.col("numeric") == 1) & ~ours) | plain | value.rlike(r"^[^@\s]+@[^@\s]+\.[A-Za-z]+$") | value.rlike("^[a-z]+://")
    return rows.withColumn("label", F.when(yes, 1.0).when(no, 0.0)).filter("label IS NOT NULL")


def fit(rows: DataFrame):
    """The forest, from at most about TRAIN_ROWS labelled findings; None if a class lacks."""
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64("value", "word_no"), F.lit(1_000_000)) / 1e6
    share = lambda label: F.lit(min(1.0, TRAIN_ROWS / 2 / counts[label]))
    sample = rows.filter(draw < F.when(F.col("label") == 1, share(1.0)).otherwise(share(0.0)))
    # bounded by TRAIN_ROWS; one order makes the forest the same in every run
    sample = saved(sample.select(*FEATURES, "label").repartition(1).sortWithinPartitions(*FEATURES, "label"), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample))


def scored(rows: DataFrame, model) -> DataFrame:
    """Described candidates with the chance that they are secrets."""
    if model is None:
        return rows.withColumn("score", F.lit(1.0))
    made = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows).withColumnRenamed("_features", "features"))
    return made.withColumn("score", vector_to_array("probability")[1]).select(*rows.columns, "score")


def scan(docs: DataFrame, findings: DataFrame | None = None, id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, path, word_no, word, value, features, score) of every candidate.
    ``findings``: described candidates with a label, instead of labelled()."""
    rows = saved(described(candidates(docs, id, text, path), dictionary(docs, text)), "secret-candidates")
    return scored(rows, fit(labelled(rows) if findings is None else findings))


def query(spark, folder: str) -> DataFrame:
    made = scan(read(spark, folder, "documents").select("doc_id", "text", "source"))
    return made.select(
        "doc_id", "word_no", F.sha2("value", 256).alias("value_sha256"), F.col("length").cast("long").alias("length"),
        "score", (F.col("score") >= THRESHOLD).alias("secret"),
    )

"""Toxicity by noisy-channel restoration of disguised words.

1. A character trigram model of the whole corpus: word counts of all documents are
   summed by Spark, then their trigrams.
2. A word that shows a disguise (leetspeak, inner separators, stretched letters, or
   single letters in a row) becomes a lattice of readings; a Viterbi search under the
   character model picks the likeliest. Other words have one reading, themselves.
3. Each restored word has features: itself and its beginnings. A feature's evidence
   is the number of different neighbours it has in toxic training texts against its
   occurrences in clean ones, so copies of one text count little. The log-odds that
   a feature marks toxicity pay for the number of features tried.
4. A text is described by its likeliest words' chances and their number; a logistic
   regression on the same sample turns that into its score.

Labels of the fold crc32(id) mod 4 = 2 are never read. The features are fitted on at
most TOXIC_ROWS and CLEAN_ROWS labelled rows, drawn by a hash of the text; all corpus
statistics cover all documents. The model sent to the tasks is bounded by that sample
and by LM_GRAMS trigrams.

Defined results: null and empty texts count as texts without any likely word; without
labels of both classes every text gets BASE; an id
labelled twice counts as toxic if one label does; rows without id are in no fold 2;
repeated rows give repeated result rows; columns named like a new one are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import carried, in_arrow, read, saved

#: Labelled rows the features are fitted on, at most about.
TOXIC_ROWS, CLEAN_ROWS = 4_000, 40_000
#: Trigrams in the character model that tasks get, the most frequent ones.
LM_GRAMS = 200_000
BASE, THRESHOLD, PURE = 0.02, 0.3, 0.97
#: Words counted in a task before their counts go to the shuffle; memoised words.
FLUSH, MEMO = 200_000, 150_000

LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
SEPARATORS = ".-_*~/\\'’·"
_EDGES = " .,;:!?\"'`()[]{}<>*%#&|-_~/\\=+…“”‘’«»¡¿"
_BEFORE = "".join(c for c in _EDGES if c not in "!|+")
_STRETCHED = re.compile(r"(.)\1\1", re.S)


class CharModel:
    """Interpolated log probabilities of character trigrams."""

    def __init__(self, grams: dict[str, int]) -> None:
        self.c3 = grams
        self.c2, self.c1, self.h2, self.h1 = Counter(), Counter(), Counter(), Counter()
        for g, n in grams.items():
            self.c2[g[1:]] += n
            self.c1[g[2]] += n
            self.h2[g[:2]] += n
            self.h1[g[1]] += n
        self.total = sum(self.c1.values())
        self.known: dict[str, float] = {}

    def __call__(self, gram: str) -> float:
        got = self.known.get(gram)
        if got is None:
            p1 = (self.c1[gram[2]] + 0.1) / (self.total + 100)
            p2 = (self.c2[gram[1:]] + 5 * p1) / (self.h1[gram[1]] + 5)
            got = math.log((self.c3.get(gram, 0) + 5 * p2) / (self.h2[gram[:2]] + 5))
            if len(self.known) > MEMO:
                self.known = {}
            self.known[gram] = got
        return got


def disguised(word: str) -> bool:
    return not word.isalpha() and any(map(str.isalpha, word)) or _STRETCHED.search(word) is not None


def _readings(char: str, run: int) -> list[tuple[str, float]]:
    """What a run of one character may stand for, with channel log probabilities."""
    if char in LEET:
        out = [(char * run, -1.0)]
        for letter in LEET[char]:
            out += [(letter, -1.0), *([(letter * 2, -1.5)] if run > 1 else [])]
        return out + ([("", -1.5)] if char in SEPARATORS else [])
    if char in SEPARATORS:
        return [("", -0.5), (char * run, -1.5)]
    if run >= 3:
        return [(char, -0.5), (char * 2, -1.0)]
    return [(char * run, 0.0), *([(char, -3.0)] if run == 2 else [])]


def restore(word: str, model: CharModel) -> str:
    """The likeliest plain word behind ``word`` (lower case)."""
    states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    at = 0
    while at < len(word):
        run = 1
        while at + run < len(word) and word[at + run] == word[at]:
            run += 1
        after: dict[str, tuple[float, tuple | None]] = {}
        for text, cost in _readings(word[at], run):
            for state, (score, path) in states.items():
                total, last = score + cost, state
                for c in text:
                    total += model(last + c)
                    last = last[1] + c
                if last not in after or total > after[last][0]:
                    after[last] = (total, (text, path) if text else path)
        states, at = after, at + run
    ends = ((score + model(state + "$"), state, path) for state, (score, path) in states.items())
    path = max(ends, key=lambda x: x[:2])[2]
    out = []
    while path:
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out))


def raw_words(text: str) -> list[str]:
    return text.lower().split()


def spelled(words: list[str]) -> list[str]:
    """Rows of three or more single characters, joined."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], lengths == 1, [False]])))
    return ["".join(words[a:b]) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= 3]


def plain(word: str, model: CharModel) -> str:
    """A raw word without its edges, restored if it looks disguised."""
    word = word.rstrip(_EDGES).lstrip(_BEFORE)
    if word.endswith("$$$"):
        word = word.rstrip("$")
    return restore(word, model) if word and disguised(word) else word


def features(word: str) -> list[str]:
    return [f"{word}$", *(word[:k] for k in range(3, min(len(word), 6) + 1))] if len(word) >= 3 else []


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all documents; tasks send sums, not words."""

    def work(batches):
        counts: Counter = Counter()

        def out():
            return pa.table({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(raw_words(t or ""))
                if len(counts) > FLUSH:
                    yield out()
                    counts.clear()
        yield out()

    rows = in_arrow(docs.select(F.col(text).cast("string").alias("text")), work, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def char_grams(counts: DataFrame) -> DataFrame:
    """(gram, n): trigrams of all words that are letters only, within ^^ and $."""
    inner = F.concat(F.lit("^^"), F.col("word"), F.lit("$"))
    return (
        counts.withColumn("word", F.regexp_replace("word", r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$", ""))
        .filter(F.col("word").rlike(r"^\p{L}+$"))
        .select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length(inner) - 2), lambda i: F.substr(inner, i, F.lit(3)))).alias("gram"))
        .groupBy("gram").agg(F.sum("n").alias("n"))
    )


def char_model(docs: DataFrame, text: str = "text") -> dict[str, int]:
    counts = saved(word_counts(docs, text), "toxicity-words")
    return {r.gram: r.n for r in char_grams(counts).orderBy(F.desc("n"), "gram").limit(LM_GRAMS).collect()}


def training_rows(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, toxic) of the labelled rows of three folds, bounded by class."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.col("toxic").isNotNull() & (F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(4)) != 2))
    sizes = {r.toxic: r["count"] for r in known.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    share = {t: min(1.0, most / max(1, sizes.get(t, 0))) for t, most in ((True, TOXIC_ROWS), (False, CLEAN_ROWS))}
    draw = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) / 1e6
    known = known.filter(draw < F.when(F.col("toxic") > 0, share[True]).otherwise(share[False]))
    rows = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("string").alias("text"))
    # at most about TOXIC_ROWS + CLEAN_ROWS pairs of numbers, whatever the input
    return rows.join(F.broadcast(known), "_id").select("text", (F.col("toxic") > 0).alias("toxic"))


def _plain_words(text: str, model: CharModel, memo: dict[str, str]) -> list[str]:
    if len(memo) > MEMO:
        memo.clear()
    words = raw_words(text)
    out = []
    for w in words:
        got = memo.get(w)
        if got is None:
            got = plain(w, model)
            if len(w) < 64:
                memo[w] = got
        out.append(got)
    return out + [plain(w, model) for w in spelled(words)]


def fit(rows: DataFrame, grams: dict[str, int]) -> dict[str, float]:
    """feature -> chance that a text that shows it is toxic, from (text, toxic) rows."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(grams)

    def neighbours(batches):
        model, memo, seen = CharModel(shared.value), {}, set()

        def out():
            return pa.table({
                "feature": pa.array([x[0] for x in seen], pa.string()), "side": pa.array([x[1] for x in seen], pa.bool_()),
                "neighbour": pa.array([x[2] for x in seen], pa.string()),
            })

        for batch in batches:
            for t in batch.column(0).to_pylist():
                words = ["", *_plain_words(t or "", model, memo), ""]
                for before, word, after in zip(words, words[1:], words[2:]):
                    for f in features(word):
                        seen.add((f, False, before))
                        seen.add((f, True, after))
                    if len(seen) > FLUSH:
                        yield out()
                        seen.clear()
        yield out()

    toxic = in_arrow(rows.filter("toxic").select("text"), neighbours, "feature string, side boolean, neighbour string")
    sides = toxic.distinct().groupBy("feature", "side").count()
    counted = sides.groupBy("feature").agg(F.min("count").alias("n")).filter("n >= 2")
    hits = {r.feature: r.n for r in counted.collect()}  # bounded by TOXIC_ROWS texts
    wanted = spark.sparkContext.broadcast(frozenset(hits))

    def occurrences(batches):
        model, memo, known, counts = CharModel(shared.value), {}, wanted.value, Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for word, n in Counter(_plain_words(t or "", model, memo)).items():
                    for f in features(word):
                        if f in known:
                            counts[f] += n
        yield pa.table({"feature": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    clean = in_arrow(rows.filter(~F.col("toxic")).select("text"), occurrences, "feature string, n long")
    misses = {r.feature: r.n for r in clean.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    total, against = sum(hits.values()), sum(misses.values())
    q = min(0.5, max(0.02, total / max(1, total + against)))
    out = {}
    for f, a in hits.items():
        b = misses.get(f, 0)
        odds = a * math.log(PURE / q) + b * math.log((1 - PURE) / (1 - q)) - math.log(len(hits) + 1)
        chance = (a + 0.5) / (a + b + 1) / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        if chance > BASE:
            out[f] = chance
    return out


def _described(column, model: CharModel, chances: dict[str, float], memo: dict[str, float]) -> np.ndarray:
    """One line per text: the evidence that the regression weighs."""

    def of(raw: str) -> float:
        word = plain(raw, model)
        return max((chances.get(f, 0.0) for f in features(word)), default=0.0)

    made = []
    for t in column.to_pylist():
        words = raw_words(t or "")
        if len(memo) > MEMO:
            memo.clear()
        each = [x for x in map(of, set(spelled(words))) if x]
        for w in set(words):
            got = memo.get(w)
            if got is None:
                got = of(w)
                if len(w) < 64:
                    memo[w] = got
            if got:
                each.append(got)
        each.sort(reverse=True)
        top = [math.log(x / (1 - x)) + 4 for x in [*each[:3], BASE, BASE, BASE][:3]]
        several = sum(-math.log(1 - x) for x in each)
        made.append([1.0, *top, math.sqrt(several), math.log1p(len(words)), math.sqrt(several) / (1 + math.log1p(len(words)))])
    return np.array(made).reshape(len(made), 7)


def weigh(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression, by Newton steps; the first is the intercept."""
    w, damp = np.zeros(x.shape[1]), np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + damp, x.T @ (y - p) - damp @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def calibrate(rows: DataFrame, grams: dict[str, int], chances: dict[str, float]) -> list[float]:
    """Regression weights from the training rows (text, toxic), a bounded sample."""
    shared = rows.sparkSession.sparkContext.broadcast((grams, chances))

    def work(batches):
        grams, chances = shared.value
        model, memo = CharModel(grams), {}
        for batch in batches:
            x = _described(batch.column(0), model, chances, memo)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["toxic", "x"]
            )

    made = in_arrow(rows.select("text", "toxic"), work, "toxic boolean, x array<double>").collect()
    made.sort(key=lambda r: (r.toxic, r.x))
    y = np.array([float(r.toxic) for r in made])
    return [] if len(set(y)) < 2 else weigh(np.array([r.x for r in made]), y).tolist()


def score(docs: DataFrame, model: tuple, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the chance that each text is toxic. ``model``: trigrams, chances, weights."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(column):
        grams, chances, weights = shared.value
        if not weights:
            yield 0, len(column), pa.array([BASE] * len(column), pa.float64())
            return
        if _worker.get("of") is not grams:
            _worker.update(of=grams, model=CharModel(grams), memo={})
        x = _described(column, _worker["model"], chances, _worker["memo"])
        yield 0, len(column), pa.array(1 / (1 + np.exp(-np.clip(x @ np.array(weights), -30, 30))), pa.float64())

    return carried(docs, text, out, "double", work)


_worker: dict = {}


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with score: model, fit and scoring in one."""
    grams = char_model(docs, text)
    rows = saved(training_rows(docs, labels, id, text), "toxicity-sample")
    chances = fit(rows, grams)
    return score(docs, (grams, chances, calibrate(rows, grams, chances)), text, out)


def query(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    made = toxicity(spark, docs, read(spark, folder, "labels").select("doc_id", "toxic"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return made.select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

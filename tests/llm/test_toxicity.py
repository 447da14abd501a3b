"""Restoration by hand-made cases, the trigram model by recount, scores by held-out labels."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from presswork.llm import toxicity as tx

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    words = "you are an idiot and a stupid loser this text is about trains boots feed the all see".split()
    grams = Counter()
    for w in words:
        padded = f"^^{w}$"
        grams.update({padded[i : i + 3]: 10 for i in range(len(padded) - 2)})
    return tx.CharModel(dict(grams))


@pytest.mark.parametrize("raw, want", [
    ("idiot", "idiot"), ("1d10t", "idiot"), ("!d!ot", "idiot"), ("stuuuupid", "stupid"), ("l0$er", "loser"),
    ("i.d.i.o.t", "idiot"), ("(i-d-i-o-t)", "idiot"), ("feed", "feed"), ("2024", "2024"), ("trains$$$", "trains"),
    ("", ""), ("...", ""), ("allll", "all"),
])
def test_restore(model, raw, want):
    assert tx.plain(raw, model) == want


def test_spelled():
    assert tx.spelled(tx.raw_words("you i d i o t and a b")) == ["idiot"]
    assert tx.spelled([]) == []


def test_very_long_word(model):
    assert tx.plain("1d10t" * 3000, model).startswith("idiot")


def test_trigrams_cover_all_documents(spark):
    docs = spark.createDataFrame([(1, "Ab ab, c-d"), (2, None), (3, ""), (3, "ab é")], "doc_id long, text string")
    assert tx.char_model(docs) == {"^^a": 3, "^ab": 3, "ab$": 3, "^^é": 1, "^é$": 1}


def test_held_out_labels(spark):
    rows = {r.doc_id: r for r in tx.query(spark, FOLDER).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    held = [(rows[i], y) for i, y in labels.items() if rows[i].held_out]
    caught = [r.predicted for r, y in held if y]
    wrong = [r.predicted for r, y in held if not y]
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.06
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 5) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    from zlib import crc32

    used = {r.text.split()[0] for r in tx.training_rows(docs, labels).collect()}
    assert used == {f"word{i}" for i in range(40) if crc32(str(i).encode()) % 4 != 2}


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a", 1), (2, "", "b", 2), (None, "x y", "c", 3), (1, None, "a", 1), (4, "é " * 50_000, "d", 4)],
        "doc_id int, text string, `so.me` string, SCORE int",
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, None)], "doc_id int, toxic int")
    got = tx.toxicity(spark, docs, labels)
    assert got.columns == ["doc_id", "text", "so.me", "score"]
    assert [r.score for r in got.collect()] == [tx.BASE] * 5
    assert tx.toxicity(spark, docs.limit(0), labels.limit(0)).collect() == []

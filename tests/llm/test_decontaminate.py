"""Benchmark spans against plain string work and against SQL."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from checks.compare import compare, duck
from presswork.llm import decontaminate as dc
from presswork.llm.fm_index import FMIndex

FOLDER = "/root/testdata/sf0.001"


def plain(text, items, width):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, ids = find(text), set(), set()
    for item, body in items:
        body = find(body)
        size = min(width, len(body))
        for a in range(len(body) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == body[a : a + size]:
                    hit.update(range(i, i + size))
                    ids.add("" if item is None else str(item))
    return len(words), sorted(hit), sorted(ids)


def test_index_finds_every_occurrence():
    rnd = np.random.default_rng(1)
    for alphabet, size in ((2, 300), (9, 500), (1, 64), (40, 3)):
        text = rnd.integers(1, alphabet + 1, size)
        phrases = np.zeros((60, 5), np.int64)
        for row in phrases:
            k = rnd.integers(1, 6)
            row[:k] = rnd.integers(1, alphabet + 3, k)
        index = FMIndex(text)
        low, high = index.search(phrases)
        for row, a, b in zip(phrases, low, high):
            want = [i for i in range(size) if (k := (row > 0).sum()) and i + k <= size and (text[i : i + k] == row[:k]).all()]
            assert sorted(index.locate(np.arange(a, b))) == want


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_marks(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "ﬁ", "x1"]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([2, 3, 5, 9])))) for i in range(20)]
    items += [(20, None), (21, ""), (22, " ,. "), (3, items[4][1]), (None, "w1 w2, w3"), (25, "solo")]
    rows = []
    for i in range(150):
        words = rnd.choices(vocabulary + [f"z{j}" for j in range(40)], k=rnd.randrange(60))
        if i % 3 == 0:
            words[3:3] = rnd.choice(items[:20])[1].split() if i % 2 else ["Solo"]
            words[5:5] = items[i % 20][1].upper().split()
        rows.append((i, rnd.choice([" ", "\n", " - "]).join(words)))
    rows += [(200, None), (201, ""), (202, "  "), (3, rows[3][1]), (204, " ".join(items[0][1] for _ in range(4000)))]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id int, text string, n_words int, `a.b` string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = dc.mark(docs.repartition(4), bench, width=5).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        if r.doc_id == 204:
            assert sum(s.last - s.first for s in r.spans) == r.n_words
            continue
        n, hit, ids = plain(texts[r.doc_id], items, 5)
        assert (r.n_words, [w for s in r.spans for w in range(s.first, s.last)], r["items"]) == (n, hit, ids)
        raw = (texts[r.doc_id] or "").encode()
        for s in r.spans:
            assert len(dc.words_of(raw[s.start : s.stop])) == s.last - s.first


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.mark(docs.limit(0), bench).collect() == []
    assert dc.mark(docs, bench.limit(0)).first().spans == []


def test_query_matches_sql(spark):
    _, rows, problem = compare(spark, duck(FOLDER), "op8", dc.query, dc.SQL, FOLDER)
    assert rows and not problem, problem

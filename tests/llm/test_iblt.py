"""Likeness against multisets of pieces, edits against plain strings, retries forced by narrow sketches."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from presswork.llm import iblt

PIECE = re.compile(iblt.PIECE)


def pieces(text):
    return Counter(m[0] for m in PIECE.finditer(text) if m[0].strip(" "))


def near(a, b):
    a, b = pieces(a), pieces(b)
    either = sum((a | b).values())
    return sum((a & b).values()) / either if either else 1.0


def plain(rows):
    """id -> (n, sha of the edited text, likeness to it, likeness to the next)."""
    order = sorted({(i, t or "") for i, t in rows}, key=lambda x: -x[0])
    out = {}
    for k, (i, t) in enumerate(order):
        other, half = order[(k + 1) % len(order)][1], len(t) // 2
        edited = t[: len(t) - half] + other[:half]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), near(t, edited), near(t, other))
    return out


@pytest.mark.parametrize("least, per", [(256, 32), (4, 1)])
def test_small_table(spark, monkeypatch, least, per):
    monkeypatch.setattr(iblt, "LEAST", least)
    monkeypatch.setattr(iblt, "PER_DIGEST", per)
    rnd = random.Random(least)
    words = ["one", "two é", "three", "vier", "5.5"]
    sentence = lambda: " ".join(rnd.choices(words, k=rnd.randrange(1, 4))) + rnd.choice(".!?\n\n")
    rows = [(i * 3, "".join(sentence() for _ in range(rnd.randrange(40)))) for i in range(60)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "🙂"), (1004, rows[5][1]), (1005, "a. " * 9000), (6, rows[2][1])]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id int, text string, `own.x` double").repartition(6)
    got = iblt.fingerprints(docs).collect()
    want = plain(rows)
    assert len(got) == len(rows)
    prints = {}
    for r in got:
        n, sha, edited, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(edited) and r.near_next == pytest.approx(after)
        prints.setdefault(dict(rows)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in prints.values())
    assert len({next(iter(x)) for t, x in prints.items() if pieces(t)}) == len([t for t in prints if pieces(t)])


def test_edge_tables(spark):
    one = spark.createDataFrame([(None, "a b. c"), (None, "a b. c")], "doc_id long, text string")
    got = iblt.fingerprints(one).collect()
    assert [(r.doc_id, r.near_edited < 1, r.near_next) for r in got] == [(None, True, 1.0)] * 2
    assert iblt.fingerprints(one.limit(0)).collect() == []


def test_an_inserted_sentence_is_one_difference(spark):
    text = "First of all. Then two! Three? A second paragraph\nof two lines. Four. Five...\nSix. Seven. Eight"
    docs = spark.createDataFrame([(2, text), (1, "New one. " + text)], "doc_id long, text string")
    got = {r.doc_id: r for r in iblt.fingerprints(docs).collect()}
    assert got[2].near_next == got[1].near_next == pytest.approx(10 / 11)
    assert not any("\n" in p for p in pieces(text))

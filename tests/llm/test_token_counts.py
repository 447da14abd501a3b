"""Counts after edits against the full encoding of the edited text."""

from __future__ import annotations

import random

import public_tokenizers
import pytest

from presswork.llm import token_counts as tc

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def count():
    return tc.Counter(PATH, PATTERN)


def edited(text, start, removed, insert):
    start = min(max(start or 0, 0), len(text))
    end = min(start + max(removed or 0, 0), len(text))
    return text[:start] + (insert or "") + text[end:]


def test_random_edits(count):
    rnd = random.Random(8)
    alphabet = "ab  \n't.1é中 \x1c"
    some = lambda k: "".join(rnd.choices(alphabet, k=rnd.randrange(k)))
    for _ in range(150):
        text = some(rnd.choice([1, 5, 40, 2000]))
        tree = tc.PieceTree(text, count)
        assert tree.total == len(count.encode(text))
        for _ in range(12):
            change = (rnd.randrange(-2, len(text) + 4), rnd.choice([0, 0, 1, 2, 9, 300]), some(rnd.choice([1, 2, 4, 30])))
            text = edited(text, *change)
            tree.edit(*change)
            assert (tree.text, tree.total) == (text, len(count.encode(text)))
            assert sum(c for c, _ in tree.pieces()) == len(text) == tree.chars[1]


def test_only_touched_pieces_are_counted_again(count):
    tree = tc.PieceTree("word " * 50_000, count)
    tree.edit(125_000, 3, "x")
    assert tree.recounted < 20 and tree.total == len(count.encode(tree.text))


def test_frames(spark, count):
    rows = [(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (None, "no id"), (None, "no id"), (4, "b " * 9000)]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id int, text string, seq string").repartition(3)
    changes = [(1, 2, 3, 1, "Q"), (1, 1, 0, 0, "x y"), (2, 1, 5, 9, "new"), (9, 1, 0, 0, "?"), (None, 1, 0, 0, "?"), (4, 1, None, None, None)]
    changes += [(3, i, i, 0, "a") for i in range(500)]
    edits = spark.createDataFrame(changes, "doc_id int, seq int, start int, removed int, insert string")
    got = tc.recount(docs, edits, PATH, PATTERN, keep_trees=True).collect()
    want = []
    for i, text in rows:
        text = text or ""
        before = len(count.encode(text))
        for c in sorted((c for c in changes if c[0] == i and i is not None), key=lambda c: c[1]):
            text = edited(text, *c[2:])
        want.append((str(i), before, len(count.encode(text)), text))
    assert sorted((str(r.doc_id), r.n_tokens_before, r.n_tokens, r.text) for r in got) == sorted(want)
    assert all(sum(p.tokens for p in r.pieces) == r.n_tokens and r.n_chars == len(r.text) for r in got)
    assert tc.recount(docs.limit(0), edits, PATH, PATTERN).collect() == []
    assert len(tc.recount(docs, edits.limit(0), PATH, PATTERN).collect()) == len(rows)


def test_query(spark, count):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = tc.query(spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        text = docs[r.doc_id].text
        n = len(text)
        after = edited(text, n // 2, 0, text[:40])
        after = edited(after, n // 4, min(60, n // 8), "")
        after = f"{docs[r.doc_id].source} {after}"
        assert (r.n_tokens_before, r.n_tokens, r.n_chars) == (len(count.encode(text)), len(count.encode(after)), len(after))

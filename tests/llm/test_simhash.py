"""SimHash groups against all pairs of a small table."""

from __future__ import annotations

import random

import pytest
import xxhash

from presswork.llm.simhash_dedup import classes, drop_near_duplicates, near_duplicates, simhash


def plain(text: str | None) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes: dict, linked) -> dict:
    """node -> smallest value reachable, by all pairs."""
    keys, root = list(nodes), {k: k for k in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(a, b):
                root[find(a)] = find(b)
    best = {}
    for k in keys:
        v = nodes[k]
        old = best.get(find(k))
        best[find(k)] = v if old is None else old if v is None else min(old, v)
    return {k: best[find(k)] for k in keys}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a b c", "A b  C d", "x" * 5000, "É é É x y\x1cz w", "w " * 9000])
def test_fingerprint(text):
    assert simhash((text or "").encode()) == plain(text)


def test_groups_match_all_pairs(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([0, 2, 30, 120])))) for i in range(60)]
    for i in range(60, 200):
        words = (rows[rnd.randrange(i)][1] or "").split()
        if words and rnd.random() < 0.8:
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(None, rows[3][1]), (7, rows[7][1]), (500, None), (501, "")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id int, text string, fp int, label string")
    fps = {}
    for i, t in rows:
        old = fps.get(plain(t))
        fps[plain(t)] = i if old is None else old if i is None else min(old, i)
    want_of = groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    got = sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in near_duplicates(docs).collect())
    assert got == sorted((str(i), plain(t), want_of[plain(t)]) for i, t in rows)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # one row of each group, also where an id or a whole row is repeated
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want_of.values()))


def test_an_id_with_two_texts_loses_no_group(spark):
    a, b = "one long story about the river and the sea behind it", "nothing like that but a list of tools for the garden"
    rows = [(1, a), (2, a), (2, b), (3, b), (None, "quite alone without any id in this table of five"), (None, a)]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([rows[0], rows[2], rows[4]], key=repr)


def test_dense_fingerprints_match_all_pairs(spark):
    rnd = random.Random(9)
    base, values = rnd.getrandbits(64), {rnd.getrandbits(64) for _ in range(50)}
    for _ in range(700):
        values.add(base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(9))))
    signed = [v - (v >> 63 << 64) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.label for r in classes(frame).collect()}
    want = groups({v: v for v in signed}, lambda a, b: ((a ^ b) % 2**64).bit_count() <= 4)
    assert {v: got.get(v, v) for v in signed} == want


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == []
    assert drop_near_duplicates(docs).collect() == []

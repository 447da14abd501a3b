"""Deleted runs against all runs of a small table, and against SQL."""

from __future__ import annotations

import random

import pytest

from checks.compare import compare, duck
from presswork.llm import line_dedup as ld


def plain(rows, min_words):
    """Every run of enough words that an earlier run equals loses its lines."""
    docs = {i: t.split("\n") for i, t in rows if t is not None}
    first, gone = {}, {i: set() for i in docs}
    for i in sorted(docs):
        for s in range(len(docs[i])):
            for e in range(s, len(docs[i])):
                run = tuple(docs[i][s : e + 1])
                if sum(len(x.encode().split()) for x in run) >= min_words:
                    if first.setdefault(run, (i, s)) < (i, s):
                        gone[i].update(range(s, e + 1))
    return {
        i: (len(x), len(gone[i]), "\n".join(y for k, y in enumerate(x) if k not in gone[i])) for i, x in docs.items()
    }


@pytest.mark.parametrize("min_words", [1, 6])
def test_small_table(spark, min_words):
    rnd = random.Random(min_words)
    pool = ["a b", "a b c", "", " ", "solo", "d e f g h i j", "x\tyé", "a b c d"]
    rows = [(i, "\n".join(rnd.choices(pool, k=rnd.randrange(1, 9)))) for i in range(60)]
    rows += [(i, "\n".join([*rnd.choices(pool, k=3), f"own {i}", *rows[i % 50][1].split("\n")])) for i in range(60, 120)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "a b c\n" * 40), (204, "long " * 30_000 + "\n" + "z " * 50)]
    docs = spark.createDataFrame([(*r, "s", 5) for r in rows], "doc_id int, text string, `q.x` string, N_lines int")
    got = ld.drop_repeated_runs(docs.repartition(5), min_words=min_words)
    assert got.columns == ["doc_id", "text", "q.x", "n_lines", "n_removed"]
    want = plain(rows, min_words)
    result = {r.doc_id: r for r in got.collect()}
    assert len(result) == len(rows)
    for i, t in rows:
        r = result[i]
        assert (r.n_lines, r.n_removed, r.text) == (want[i] if t is not None else (0, 0, None)), i


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c\nx"), (None, None), (2, "q r s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text or "", r.n_removed) for r in ld.drop_repeated_runs(docs, min_words=3).collect())
    assert got == [("1", "a b c", 0), ("1", "a b c", 0), ("2", "q r s", 0), ("None", "", 0), ("None", "x", 1)]
    assert ld.drop_repeated_runs(docs.limit(0)).collect() == []


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.01"
    _, rows, problem = compare(spark, duck(folder), "op2", ld.query, ld.SQL, folder)
    assert rows and not problem, problem[:900]

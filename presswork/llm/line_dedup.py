"""Removal of repeated line runs by distributed prefix doubling.

Lines are numbered in order of their 128-bit digests; lines that occur once end every
repeat and leave at once. Round k ranks the blocks of 2^k lines at every position by
the pair of ranks (block at i, block at i + 2^(k-1)), in sorted order; a rank stands
for an interval of the suffix array whose longest common prefix covers the block, and
blocks that occur once leave. The rounds stop when 2^k reaches the longest run that a
decision needs.

A run qualifies with at least ``min_words`` words. Every qualifying repeated run is
the union of the shortest qualifying windows that start or end at its lines, so those
windows are looked up: a window of length l is named by the ranks of the two blocks of
2^k lines, 2^k <= l, that cover it (its interval in the suffix array). Of equal windows
the first, by (id, text digest, line), stays; all lines of later ones are deleted, also
where a later copy overlaps the first.

Defined results: null texts stay null; a text may become empty; blank lines are lines
of no words; a null id counts as the largest; rows of the same id and text are one
document and get the same result; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.llm.common import in_arrow, parts, read, saved

MIN_WORDS = 50
#: Text whose lines are put out together, in bytes.
SLICE = 4 << 20
LAST = (1 << 63) - 1


def _keys(docs: DataFrame, id: str, text: str) -> list:
    of = F.col("`" + text.replace("`", "``") + "`").cast("string")
    own = F.col("`" + id.replace("`", "``") + "`").cast("long")
    return [F.coalesce(own, F.lit(LAST)), F.xxhash64(of), of]


def lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, mark, pos, h1, h2, words) of every line; a document is (id, mark)."""

    def work(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            for a, b in parts([len(t) + 1 for t in texts], SLICE):
                split = [t.split(b"\n") for t in texts[a:b]]
                counts = np.fromiter(map(len, split), np.int64, len(split))
                flat = [line for each in split for line in each]
                digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, flat)), "<i8").reshape(-1, 2)
                at = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
                take = pa.array(np.repeat(np.arange(a, b), counts))
                yield pa.table({
                    "id": batch.column(0).take(take), "mark": batch.column(1).take(take), "pos": at.astype("i4"),
                    "h1": digests[:, 0].copy(), "h2": digests[:, 1].copy(),
                    "words": np.fromiter((len(x.split()) for x in flat), np.int32, len(flat)),
                })

    own, mark, of = _keys(docs, id, text)
    rows = docs.select(own.alias("id"), mark.alias("mark"), of.alias("text")).filter("text IS NOT NULL")
    return in_arrow(rows, work, "id long, mark long, pos int, h1 long, h2 long, words int")


def _ranked(pairs: DataFrame, *by: str) -> DataFrame:
    """Values of ``by`` that occur more than once, with ranks in their order."""
    often = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    ordered = often.repartitionByRange(*by).sortWithinPartitions(*by)
    return saved(ordered.withColumn("rank", F.monotonically_increasing_id()), "line-ranks")


def _windows(blocks: DataFrame, min_words: int) -> DataFrame:
    """(id, mark, pos, size): the shortest qualifying windows of repeated lines."""

    def work(batches):
        for batch in batches:
            ids, marks, starts, sizes = [], [], [], []
            for own, mark, rows in zip(*(c.to_pylist() for c in batch.columns)):
                pos = np.array([r["pos"] for r in rows])
                words = np.array([r["words"] for r in rows])
                found = set()
                for part in np.split(np.arange(len(pos)), np.flatnonzero(np.diff(pos) != 1) + 1):
                    upto = np.concatenate([[0], np.cumsum(words[part])])
                    n, first = len(part), int(pos[part[0]])
                    # the first end with enough words for each start, the last start for each end
                    ends = np.searchsorted(upto, upto[:-1] + min_words, "left")
                    found.update((first + s, int(e) - s) for s, e in enumerate(ends) if e <= n)
                    begins = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
                    found.update((first + int(s), e + 1 - int(s)) for e, s in enumerate(begins) if s >= 0)
                for start, size in sorted(found):
                    ids.append(own), marks.append(mark), starts.append(start), sizes.append(size)
            yield pa.table({
                "id": pa.array(ids, pa.int64()), "mark": pa.array(marks, pa.int64()),
                "pos": pa.array(starts, pa.int32()), "size": pa.array(sizes, pa.int32()),
            })

    each = blocks.groupBy("id", "mark").agg(F.sort_array(F.collect_set(F.struct("pos", "words"))).alias("rows"))
    return in_arrow(each, work, "id long, mark long, pos int, size int")


def _later_copies(windows: DataFrame, ranks: DataFrame, block: int) -> DataFrame:
    """(id, mark, pos, size) of the windows that an earlier window equals."""
    end = ranks.select("id", "mark", F.col("pos").alias("tail"), F.col("rank").alias("rank2"))
    named = (
        windows.join(ranks.select("id", "mark", "pos", "rank"), ["id", "mark", "pos"])
        .withColumn("tail", F.col("pos") + F.col("size") - block)
        .join(end, ["id", "mark", "tail"]).drop("tail")
    )
    named = saved(named.distinct(), "line-windows")
    at = F.struct("id", "mark", "pos")
    groups = named.groupBy("size", "rank", "rank2").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    kept = groups.filter("first <> last").drop("last")
    return (
        named.join(kept, ["size", "rank", "rank2"]).filter(at != F.col("first")).select("id", "mark", "pos", "size")
    )


def repeated_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(id, mark, pos, size): line ranges to delete; they may overlap."""
    if min_words < 1:
        raise ValueError("a run needs at least one word")
    all_lines = saved(lines(docs, id, text), "lines")
    ranks = saved(
        all_lines.join(_ranked(all_lines, "h1", "h2"), ["h1", "h2"]).select("id", "mark", "pos", "words", "rank"),
        "line-blocks",
    )
    windows = saved(_windows(ranks, min_words), "line-candidates")
    longest = windows.agg(F.max("size")).first()[0] or 0
    out, block = None, 1
    while block <= longest:
        here = windows.filter((F.col("size") >= block) & (F.col("size") < 2 * block))
        found = _later_copies(here, ranks, block)
        out = found if out is None else out.unionByName(found)
        if 2 * block <= longest:
            at = Window.partitionBy("id", "mark").orderBy("pos").rangeBetween(block, block)
            pairs = (
                ranks.select("id", "mark", "pos", F.col("rank").alias("a"), F.max("rank").over(at).alias("b"))
                .filter("b IS NOT NULL")
            )
            pairs = saved(pairs, "line-pairs")
            ranks = saved(
                pairs.join(_ranked(pairs, "a", "b"), ["a", "b"]).select("id", "mark", "pos", "rank"), "line-blocks"
            )
        block *= 2
    if out is None:
        return windows
    return saved(out, "line-repeats")


def drop_repeated_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with its texts shortened, and n_lines and n_removed per document."""
    spans = repeated_runs(docs, id, text, min_words).groupBy("id", "mark").agg(
        F.collect_set(F.struct("pos", "size")).alias("spans")
    )
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    place = next(i for i, c in enumerate(kept) if c.lower() == text.lower())
    own, mark, of = _keys(docs, id, text)
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    rows = docs.select(
        *[(of if i == place else quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)],
        own.alias("id"), mark.alias("mark"),
    ).join(spans, ["id", "mark"], "left").select(*[f"c{i}" for i in range(len(kept))], "spans")

    def work(batches):
        for batch in batches:
            texts, totals, gone = [], [], []
            for t, cuts in zip(batch.column(place).to_pylist(), batch.column(len(kept)).to_pylist()):
                n = removed = 0
                if t is not None:
                    if cuts:
                        split = t.split("\n")
                        drop = {i for c in cuts for i in range(c["pos"], c["pos"] + c["size"])}
                        n, removed = len(split), len(drop)
                        t = "\n".join(x for i, x in enumerate(split) if i not in drop)
                    else:
                        n = t.count("\n") + 1
                texts.append(t), totals.append(n), gone.append(removed)
            columns = list(batch.columns[: len(kept)])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64()), pa.array(gone, pa.int64())], names
            )

    names = [*rows.columns[:-1], "n_lines", "n_removed"]
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes[:-1]) + ", n_lines long, n_removed long"
    return in_arrow(rows, work, schema).toDF(*kept, "n_lines", "n_removed")


def query(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return drop_repeated_runs(docs).select("doc_id", "n_lines", "n_removed", "text")


SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM l),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM w),
pairs AS (
  SELECT a.doc_id, a.pos AS s, b.pos AS e FROM c a JOIN c b
  ON a.doc_id = b.doc_id AND a.pos <= b.pos AND b.upto - a.upto + a.words >= {MIN_WORDS}),
windows AS (
  SELECT doc_id, s, min(e) AS e FROM pairs GROUP BY doc_id, s
  UNION SELECT doc_id, max(s) AS s, e FROM pairs GROUP BY doc_id, e),
runs AS (
  SELECT v.doc_id, s, e, string_agg(line, chr(10) ORDER BY pos) AS run
  FROM windows v JOIN c ON v.doc_id = c.doc_id AND pos BETWEEN s AND e GROUP BY v.doc_id, s, e),
later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS n FROM runs) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS pos FROM later),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(gone.pos) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL), '') AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept.text
FROM documents d LEFT JOIN kept USING (doc_id)
"""

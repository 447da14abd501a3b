"""Benchmark decontamination: an FM-index per shard of training text.

Phrases are all runs of ``width`` consecutive words of a benchmark item; an item of
fewer words is one phrase. A shard (a few MB of documents in one task) is reduced to
its runs of benchmark words, as a phrase can occur nowhere else; runs too short for
any phrase go. Phrases are searched backwards in the shard's FM-index, occurrences
are located by sampled suffix positions and merged to removal spans per document.

The documents are never shuffled. Benchmarks are sent to the tasks in blocks of at
most BLOCK_BYTES of text; a larger benchmark takes one more pass per block.

Defined results: null texts have no words; items without words have no phrases; an
item without id counts under the empty id; repeated rows give repeated result rows;
empty tables give empty results or no hits. Columns named like a new one are replaced.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import in_arrow, parts, read, text_bytes
from presswork.llm.fm_index import FMIndex

WIDTH = 13
#: Benchmark text sent to tasks at once; training text in one index.
BLOCK_BYTES, SHARD_BYTES = 16 << 20, 2 << 20

NEW = ("n_words", "spans", "items")
SPAN = "struct<first:long,last:long,start:long,stop:long>"

#: Lower-cased word bytes; zero for all others.
_LOWER = np.zeros(256, "u1")
for _b in range(256):
    if 48 <= _b <= 57 or 97 <= _b <= 122 or _b >= 128:
        _LOWER[_b] = _b
    elif 65 <= _b <= 90:
        _LOWER[_b] = _b + 32
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _hashes(lowered: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word of the concatenated words."""
    starts = np.cumsum(lengths) - lengths
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    within = np.arange(len(lowered)) - np.repeat(starts, lengths)
    mixed = np.add.reduceat((lowered.astype(np.uint64) + np.uint64(7)) * powers[within], starts)
    mixed ^= mixed >> np.uint64(29)
    return mixed * _BASE


class Phrases:
    """The phrases of a block of items, ready to be sought in shards."""

    def __init__(self, items: list[tuple[str, bytes]], width: int) -> None:
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            size = min(width, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                found.setdefault(tuple(words[at : at + size]), set()).add(item)
        vocabulary = sorted({w for phrase in found for w in phrase})
        self.items = [sorted(x) for x in found.values()]
        self.shortest = min(map(len, found), default=0)
        if not found:
            return
        self.lengths = np.array([len(w) for w in vocabulary])
        self.bytes = np.frombuffer(b"".join(vocabulary), "u1")
        self.starts = np.cumsum(self.lengths) - self.lengths
        hashes = _hashes(self.bytes, self.lengths)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two benchmark words share a hash; change _BASE")
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(hashes >> np.uint64(48)).astype(np.int64)] = True
        number = {w: i + 2 for i, w in enumerate(vocabulary)}  # 1 parts runs
        self.matrix = np.zeros((len(found), max(map(len, found))), np.int64)
        for i, phrase in enumerate(found):
            self.matrix[i, : len(phrase)] = [number[w] for w in phrase]
        self.sizes = (self.matrix > 0).sum(axis=1)

    def symbols(self, lowered: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of words, 0 for others; hash hits are compared bytewise."""
        hashes = _hashes(lowered, lengths)
        out = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        known = self.hashes[place] == hashes[at]
        at, word = at[known], self.order[place[known]]
        same = self.lengths[word] == lengths[at]
        at, word = at[same], word[same]
        if len(at):
            size = lengths[at]
            offsets = np.cumsum(size) - size
            inside = np.arange(int(size.sum())) - np.repeat(offsets, size)
            starts = np.cumsum(lengths) - lengths
            mine = lowered[np.repeat(starts[at], size) + inside]
            equal = mine == self.bytes[np.repeat(self.starts[word], size) + inside]
            same = np.logical_and.reduceat(equal, offsets)
            out[at[same]] = word[same] + 2
        return out


def seek(texts: list[bytes], phrases: Phrases):
    """For each text: word count, merged spans (first, last word; start, stop byte)
    and the ids of the items that occur."""
    none = [(0, [], []) for _ in texts]
    raw = np.frombuffer(b"\0".join(texts), "u1")
    lowered = _LOWER[raw]
    if not lowered.any():
        return none
    is_word = lowered > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], is_word, [False]])))
    starts, ends = edge[::2], edge[1::2]
    sizes = np.array([len(t) + 1 for t in texts])
    doc_start = np.cumsum(sizes) - sizes
    first_word = np.searchsorted(starts, np.append(doc_start, sizes.sum()))
    n_words = np.diff(first_word)
    out = [(int(n), [], []) for n in n_words]
    if not phrases.shortest:
        return out
    symbols = phrases.symbols(lowered[is_word], ends - starts)
    doc = np.repeat(np.arange(len(texts)), n_words)
    known = symbols > 0
    # runs of benchmark words inside one document
    opens = known & ~np.concatenate([[False], known[:-1] & (doc[1:] == doc[:-1])])
    run = np.cumsum(opens)[known] - 1
    if not len(run):
        return out
    length = np.bincount(run)
    words = np.flatnonzero(known)[length[run] >= phrases.shortest]
    if not len(words):
        return out
    breaks = np.concatenate([[False], opens[words][1:]])
    where = np.arange(len(words)) + np.cumsum(breaks)
    text = np.ones(int(where[-1]) + 1, np.int64)
    text[where] = symbols[words]
    word_at = np.full(len(text), -1, np.int64)
    word_at[where] = words
    index = FMIndex(text)
    low, high = index.search(phrases.matrix)
    count = high - low
    hit = np.flatnonzero(count)
    if not len(hit):
        return out
    count = count[hit]
    rows = np.repeat(low[hit], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    which = np.repeat(hit, count)
    begin = word_at[index.locate(rows)]
    marks = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(marks, begin, 1)
    np.add.at(marks, begin + phrases.sizes[which], -1)
    covered = np.cumsum(marks[:-1]) > 0
    cut = covered & ~np.concatenate([[False], covered[:-1] & (doc[1:] == doc[:-1])])
    heads = np.flatnonzero(cut)
    last = np.concatenate([covered[:-1] & (~covered[1:] | cut[1:]), covered[-1:]])
    for a, b in zip(heads.tolist(), np.flatnonzero(last).tolist()):
        d = int(doc[a])
        out[d][1].append(
            (a - int(first_word[d]), b + 1 - int(first_word[d]), int(starts[a] - doc_start[d]), int(ends[b] - doc_start[d]))
        )
    for d, w in np.unique(np.stack([doc[begin], which], axis=1), axis=0).tolist():
        out[d][2].extend(phrases.items[w])
    return out


def merged(spans: list[tuple]) -> list[tuple]:
    """Union of spans; spans that only touch stay apart no longer."""
    out: list[list] = []
    for first, last, start, stop in sorted(spans):
        if out and first <= out[-1][1]:
            if last > out[-1][1]:
                out[-1][1], out[-1][3] = last, stop
        else:
            out.append([first, last, start, stop])
    return [tuple(x) for x in out]


def _blocks(benchmark: DataFrame, item: str, text: str):
    """Lists of (id, text) of at most about BLOCK_BYTES each."""
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).distinct()
    total = rows.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 64)).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r.item, r.text.encode()) for r in part.collect()]


def mark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """``docs`` with n_words, spans (merged word and byte ranges of benchmark
    passages) and items (sorted ids of the items that occur)."""
    kept = [c for c in docs.columns if c.lower() not in NEW]
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    n = len(kept)
    frame = docs.select(
        *[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)], quoted(text).cast("string").alias("sought"),
        F.lit(0).cast("long").alias("n_words"), F.array().cast(f"array<{SPAN}>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    names = frame.columns
    schema = ", ".join(f"{c} {t}" for c, t in frame.dtypes)
    span_type = pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "last", "start", "stop")]))
    for block in _blocks(benchmark, item, item_text):

        def work(batches, block=block):
            phrases = Phrases(block, width)
            for batch in batches:
                texts = text_bytes(batch.column(n))
                for a, b in parts([len(t) + 1 for t in texts], SHARD_BYTES):
                    found = seek(texts[a:b], phrases)
                    cut = batch.slice(a, b - a)
                    spans, items = [], []
                    for (_, new, ids), old, had in zip(found, cut.column(n + 2).to_pylist(), cut.column(n + 3).to_pylist()):
                        spans.append([
                            dict(zip(("first", "last", "start", "stop"), s))
                            for s in merged([*(tuple(x.values()) for x in old), *new])
                        ])
                        items.append(sorted({*had, *ids}))
                    yield pa.RecordBatch.from_arrays(
                        [*cut.columns[: n + 1], pa.array([f[0] for f in found], pa.int64()),
                         pa.array(spans, span_type), pa.array(items, pa.list_(pa.string()))],
                        names,
                    )

        frame = in_arrow(frame, work, schema)
    return frame.drop("sought").toDF(*kept, *NEW)


def n_hit():
    """Words inside a span, of a frame that mark() made."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"])


def contaminated():
    """A twentieth of the words or more lie inside benchmark passages."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def query(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    marked = mark(docs, read(spark, folder, "benchmark"))
    return marked.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


_UPPER, _WORDS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPLIT = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORDS}')"
SQL = f"""
WITH d AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SPLIT} AS w FROM benchmark),
p AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
      FROM (SELECT item, w, least(len(w), {WIDTH}) AS n, unnest(range(1, len(w) - least(len(w), {WIDTH}) + 2)) AS i
            FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
o AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, i, o.n, item FROM o JOIN p ON o.n = p.n AND o.phrase = p.phrase),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

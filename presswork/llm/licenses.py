"""License statements by ordered signature rules.

A text becomes words (bytes lower-cased from A to Z; every other byte of ASCII but digits
and letters ends a word) joined by single spaces. One Aho-Corasick pass over them finds
the keywords of all rules; a rule's regex runs only where one of its keywords stands, as
every match holds one. Findings overlap, as a notice holds a license's name and that may
hold a shorter one: a finding inside the words of another goes if the other has a higher
priority, or the same one and more words, or the same words and an earlier rule. Findings
of the base phrases always stay.

Rows keep their place: scan() adds columns and shuffles nothing. A text is in memory
three times at once at most, whatever its length; the kept findings are sorted by start,
so suppression takes n log n steps for n findings of a text.

Defined results: null and empty texts have no words, no findings and score 0; repeated
rows are scored each on its own; an empty table gives an empty result; columns of the
input keep their names and values, and a clashing one moves the new column to a name
with underscores (the caller may name them).
"""

from __future__ import annotations

from bisect import bisect_right, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import carried, once_per_worker, parts, read, text_bytes
from presswork.llm.license_rules import KINDS, rules

FOUND = "struct<n_words: bigint, found: array<struct<label: string, kind: string, rule: int, first: bigint, stop: bigint>>>"
#: Bytes of text whose findings go out as one batch.
SLICE = 4 << 20

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(b if b in _KEEP or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    # bytes.lower() knows A to Z only
    return text.lower().translate(_TABLE).split()


def _compile():
    import ahocorasick

    table, gates = rules(), {}
    for rule in table:
        for gate in rule.gates:
            gates.setdefault(gate, []).append(rule.number)
    automaton = ahocorasick.Automaton()
    for gate, numbers in gates.items():
        automaton.add_word(gate, tuple(numbers))
    automaton.make_automaton()
    return table, automaton


def _compiled():
    return once_per_worker("license rules", _compile)


def suppressed(findings: list[tuple[int, int, int]], table) -> list[tuple[int, int, int]]:
    """The (first, stop, rule) that stay, by place.

    Taken from the strongest to the weakest, a finding stays unless one that stays
    covers it. Those that can cover are kept as a staircase: starts and stops both rise."""
    order = sorted(findings, key=lambda f: (-table[f[2]].priority, f[0] - f[1], f[2], f[0]))
    kept, stairs = [], []
    for first, stop, number in order:
        base = table[number].kind == "base"
        at = bisect_right(stairs, (first, float("inf")))
        covered = at > 0 and stairs[at - 1][1] >= stop
        if covered and not base:
            continue
        kept.append((first, stop, number))
        if covered or base:
            continue
        while at < len(stairs) and stairs[at][1] <= stop:
            stairs.pop(at)
        if at > 0 and stairs[at - 1][0] == first:
            stairs.pop(at - 1)
        insort(stairs, (first, stop))
    return sorted(kept)


def findings(text: bytes) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of words, and the kept (first word, word after the last, rule)."""
    table, automaton = _compiled()
    words = words_of(text)
    if not words:
        return 0, []
    plain = b" ".join(words).decode("latin-1")
    allowed = set()
    for _, numbers in automaton.iter(plain):
        allowed.update(numbers)
    places = [(m.start(), m.end(), n) for n in sorted(allowed) for m in table[n].pattern.finditer(plain)]
    if not places:
        return len(words), []
    # word numbers of the byte places, counted once from left to right
    number, last, seen = {}, 0, 0
    for at in sorted({p for a, b, _ in places for p in (a, b)}):
        seen += plain.count(" ", last, at)
        number[at], last = seen, at
    return len(words), suppressed([(number[a], number[b] + 1, n) for a, b, n in places], table)


def _found(column: pa.Array):
    table, _ = _compiled()
    texts = text_bytes(column)
    kind = pa.struct([
        ("n_words", pa.int64()),
        ("found", pa.list_(pa.struct([
            ("label", pa.string()), ("kind", pa.string()), ("rule", pa.int32()), ("first", pa.int64()), ("stop", pa.int64()),
        ]))),
    ])
    for a, b in parts([len(t) + 64 for t in texts], SLICE):
        rows = []
        for text in texts[a:b]:
            n, places = findings(text)
            rows.append({"n_words": n, "found": [
                {"label": table[r].label, "kind": table[r].kind, "rule": r, "first": f, "stop": s} for f, s, r in places
            ]})
        yield a, b, pa.array(rows, kind)


def scan(frame: DataFrame, text: str = "text", out: str = "licenses") -> DataFrame:
    """``frame`` with struct ``out``: n_words and the findings of ``text``, by place."""
    return carried(frame, text, out, FOUND, _found)


def _labels(found):
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")


def _weight(kind):
    return F.coalesce(*[F.when(kind == name, F.lit(weight)) for name, (_, weight) in KINDS.items()])


def report(column: str = "licenses") -> list:
    """Columns of a scan: word and base counts, places, labels and a score.

    The score is 1 minus the product, over the kinds that occur, of one minus the
    kind's weight: several kinds of evidence add up, repeated ones do not."""
    found = F.col(f"{column}.found")
    base = F.filter(found, lambda f: f["kind"] == "base")
    kinds = F.array_sort(F.array_distinct(F.transform(found, lambda f: f["kind"])))
    left = F.aggregate(kinds, F.lit(1.0), lambda rest, k: rest * (1 - _weight(k)))
    return [
        F.col(f"{column}.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda f: f["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda f: f["first"])).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(found).alias("labels"),
        (1 - left).alias("score"),
    ]


def query(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = scan(docs).drop("text")
    return found.select("doc_id", *report())

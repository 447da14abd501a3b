"""The corpus pipeline: stages over documents, each written and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which becomes the next stage's docs.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from presswork.llm import bpe, decontaminate, line_dedup, simhash_dedup, toxicity  # noqa: E402
from presswork.llm.common import fresh, read, saved  # noqa: E402


def reject_toxic(spark, docs, sf_dir):
    """Documents whose score reaches the threshold go; the others stay as they are,
    null and empty texts too unless the model finds them toxic."""
    score = fresh(docs, "score")
    made = toxicity.toxicity(spark, docs, read(spark, sf_dir, "labels"), out=score)
    return made.filter(made[score] < toxicity.THRESHOLD).drop(score)


def _aside(docs, work, *names):
    """``work`` on docs while columns named like its own new ones stand aside."""
    taken = {c: c for c in docs.columns if c.lower() in names}
    for c in taken:
        taken[c] = fresh(docs, f"kept_{c}")
    made = work(docs.withColumnsRenamed(taken))
    return made.select(*[F.col("`" + taken.get(c, c).replace("`", "``") + "`").alias(c) for c in docs.columns])


def drop_lines(spark, docs, sf_dir):
    """Later copies of line runs of 50 words or more go; every document stays, null
    texts as null. n_chars, if there, is that of the shorter text."""
    made = _aside(docs, line_dedup.drop_repeated_runs, "n_lines", "n_removed")
    sizes = {c: F.length("text").cast("long") for c in docs.columns if c.lower() == "n_chars"}
    return made.withColumns(sizes).select(docs.columns)


def near_dedup(spark, docs, sf_dir):
    """One row of each SimHash component stays, that of the smallest id (nulls last);
    null and empty texts have one fingerprint, so one of them all stays."""
    return simhash_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents with a twentieth of their words inside benchmark passages go; null
    and empty texts have no words and stay."""

    def clean(rows):
        made = decontaminate.mark(rows, read(spark, sf_dir, "benchmark"))
        return made.filter(~decontaminate.contaminated())

    return _aside(docs, clean, "n_words", "spans", "items")


def tokenize(spark, docs, sf_dir):
    """doc_id, the token ids of the text (null: none), their number, and whether they
    decode to it; one row per row, whatever other columns there are."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return bpe.round_trip(docs.select("doc_id", "text"), path, pattern).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip")
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", near_dedup),
    ("decontamination", drop_contaminated),
    ("tokens", tokenize),
]

#: No stage is plain SQL (a trained score, fingerprints, byte-pair merges): tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

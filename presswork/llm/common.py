"""What the operators share: reading, written intermediate tables, Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.session import new_run_folder

#: Bytes of Arrow data handed to a Python worker at once, whatever the row count.
BATCH_BYTES = 8 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def saved(frame: DataFrame, job: str) -> DataFrame:
    """``frame`` as a table in the shared folder: lineage ends here, and a lost
    executor costs at most the tasks that were running."""
    spark = frame.sparkSession
    folder = new_run_folder(spark, job)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def bounded_batches(spark: SparkSession) -> None:
    """Long texts must not pile up in one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that ``frame`` does not use (names are case-insensitive)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_arrow(frame: DataFrame, work, schema: str) -> DataFrame:
    """mapInArrow with batches bounded by bytes. ``work`` maps an iterator of
    record batches to one of record batches or tables of the schema."""
    bounded_batches(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(batches):
            yield from (out.to_batches() if isinstance(out, pa.Table) else [out])

    return frame.mapInArrow(run, schema)


def parts(sizes: list[int], most: int):
    """(from, to) of consecutive rows whose sizes sum to about ``most``."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def carried(frame: DataFrame, source: str, new: str, kind: str, work) -> DataFrame:
    """``frame`` with column ``new``: ``work`` maps batches of ``source`` to arrays.

    Columns travel under plain names, as Spark refuses dots in them here."""
    kept = [c for c in frame.columns if c.lower() != new.lower()]
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    rows = frame.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)], quoted(source).alias("source"))
    names = [*rows.columns[:-1], "made"]

    def run(batches):
        for batch in batches:
            for a, b, made in work(batch.column(len(kept))):
                cut = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*cut.columns[:-1], made], names)

    schema = ", ".join([*(f"{n} {t}" for n, t in rows.dtypes[:-1]), f"made {kind}"])
    return in_arrow(rows, run, schema).toDF(*kept, new)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]



def once_per_worker(name: str, make):
    """``make()``, kept under ``name`` as long as the Python process lives.

    Functions travel to executors by value, so the globals of their modules are new
    in every task; a module of its own outlives the task in a reused worker."""
    kept = sys.modules.setdefault("presswork_kept", types.ModuleType("presswork_kept")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]

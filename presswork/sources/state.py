"""Keyed state tables: one latest row per key, one folder per version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.ordering import first_per_key


def upsert(state: DataFrame, updates: DataFrame, keys: list[str], newest: list[Column | str]) -> DataFrame:
    """State after ``updates``: per key the newest row, updates before old state.

    ``newest`` orders rows of one key, the wanted one first.
    """
    both = state.withColumn("_fresh", F.lit(0)).unionByName(updates.withColumn("_fresh", F.lit(1)))
    return first_per_key(both, keys, [F.desc("_fresh"), *newest]).drop("_fresh")


def state_verdict(required: list[str]) -> Column:
    """A stored state row must carry all required fields."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return F.when(
        F.coalesce(*missing).isNotNull(), F.concat(F.lit("invalid_checkpoint:"), F.coalesce(*missing))
    )


def version_folder(root: str, version: int) -> str:
    return f"{root}/version={version:012d}"


def write_version(state: DataFrame, root: str, version: int) -> str:
    """Writes a whole version; repeating a version replaces it, so a restarted
    batch ends in the same place."""
    folder = version_folder(root, version)
    state.write.mode("overwrite").parquet(folder)
    return folder


def read_deltas(spark: SparkSession, root: str, before: int, schema: str) -> DataFrame:
    """Rows that versions below ``before`` added to an insert-only state.

    Each version holds its own additions only, so a batch writes as much as it
    brings, however large the state has become. The version is a partition
    column: later folders, left by a batch that is being repeated, are not read.
    """
    if before <= 0:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(f"{schema}, version bigint").parquet(root)
    return stored.filter(F.col("version") < before).drop("version")


def read_latest(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """State of the newest version below ``root``."""
    stored = spark.read.schema(f"{schema}, version bigint").parquet(root)
    newest = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == F.lit(newest)).drop("version")


def read_version(spark: SparkSession, root: str, version: int, schema: str) -> DataFrame:
    """State of a version; version -1 is the empty state."""
    if version < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_folder(root, version))

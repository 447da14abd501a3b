"""Keyed state as sorted runs, merged on read and compacted by level.

A version of the state is a short list of runs. A batch adds one run of the keys it
changed, dealt out to hash buckets and sorted inside them; nothing else is rewritten.
FAN runs of a level are merged into one of the next level, so a key is rewritten once
per level, a version has fewer than FAN runs a level, and levels grow with the logarithm
of the state. A reader takes the newest row of each key; one that looks some keys up
names them, and the join on bucket and key lets Spark skip buckets without any.

Runs and versions are named after the batch that writes them: a repeated batch reads the
version before it and replaces its own run, its merges and its version. Rows carry the
version that wrote them and whether they end their key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LIVE = "level int, run bigint"
#: Columns of a run beside those of the state: who wrote a row last, whether its key has
#: ended, and its bucket.
SEQ, GONE, BUCKET = "run_seq", "run_gone", "run_bucket"
WRITTEN = f"{SEQ} bigint, {GONE} boolean"


@dataclass(frozen=True)
class KeyedRuns:
    """State below ``root``: ``schema`` holds the key columns and the values.

    ``group``: the leading key columns that buckets are made of, for readers that look
    whole groups up (all items of some feeds); by default the whole key.
    """

    root: str
    keys: tuple[str, ...]
    schema: str
    buckets: int = 16
    fan: int = 4
    group: tuple[str, ...] = ()

    def _bucket(self):
        return F.pmod(F.xxhash64(*(self.group or self.keys)), F.lit(self.buckets)).cast("int")

    def _run_folder(self, level: int, run: int) -> str:
        return f"{self.root}/runs/run_level={level}/run_number={run:012d}"

    def _version_folder(self, version: int) -> str:
        return f"{self.root}/versions/version={version:012d}"

    def live(self, spark: SparkSession, version: int) -> list[tuple[int, int]]:
        """(level, run) of a version; version -1 is the empty state."""
        if version < 0:
            return []
        rows = spark.read.schema(LIVE).parquet(self._version_folder(version)).collect()
        return sorted((r.level, r.run) for r in rows)

    def latest(self, spark: SparkSession) -> int:
        """The newest version."""
        versions = spark.read.schema(f"{LIVE}, version bigint").parquet(f"{self.root}/versions")
        return versions.agg(F.max("version")).first()[0]

    def _rows(self, spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame:
        full = f"{self.schema}, {WRITTEN}, run_level int, run_number bigint, {BUCKET} int"
        if not runs:
            return spark.createDataFrame([], full)
        reader = spark.read.schema(full).option("basePath", f"{self.root}/runs")
        return reader.parquet(*[self._run_folder(*r) for r in runs])

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key: the one written last."""
        values = [c for c in rows.columns if c not in (*self.keys, BUCKET, "run_level", "run_number")]
        newest = F.max_by(F.struct(*values), SEQ).alias("_newest")
        return rows.groupBy(BUCKET, *self.keys).agg(newest).select(BUCKET, *self.keys, "_newest.*")

    def read(self, spark: SparkSession, version: int, of: DataFrame | None = None) -> DataFrame:
        """The state at a version, or its rows for the keys (or groups) of ``of``."""
        runs = self.live(spark, version)
        rows = self._rows(spark, runs)
        if of is not None and runs:
            on = [c for c in self.keys if c in of.columns]
            wanted = of.select(*on).distinct().withColumn(BUCKET, self._bucket())
            rows = rows.join(wanted, [BUCKET, *on], "left_semi")
        names = spark.createDataFrame([], self.schema).columns
        return self._newest(rows).filter(~F.col(GONE)).select(*names)

    def _write_run(self, rows: DataFrame, level: int, run: int) -> None:
        placed = rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(self._run_folder(level, run))

    def write(self, changes: DataFrame, version: int) -> None:
        """Makes ``version`` of the one before it and the batch's changes: at most one
        row per key, with the columns of the schema and, if keys end, ``gone``."""
        spark = changes.sparkSession
        names = spark.createDataFrame([], self.schema).columns
        gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in changes.columns else F.lit(False)
        added = changes.select(*names, F.lit(version).cast("bigint").alias(SEQ), gone.alias(GONE))
        self._write_run(added.withColumn(BUCKET, self._bucket()), 0, version)
        runs = [*self.live(spark, version - 1), (0, version)]
        level = 0
        while len(mine := [r for r in runs if r[0] == level]) >= self.fan:
            older = [r for r in runs if r[0] > level]
            merged = self._newest(self._rows(spark, mine))
            if not older:
                merged = merged.filter(~F.col(GONE))
            self._write_run(merged, level + 1, version)
            runs = [r for r in runs if r[0] != level] + [(level + 1, version)]
            level += 1
        listed = spark.createDataFrame(runs, LIVE).coalesce(1)
        listed.write.mode("overwrite").parquet(self._version_folder(version))

    def dead_runs(self, spark: SparkSession, oldest: int) -> list[str]:
        """Folders of runs that no version from ``oldest`` on reads: what a cleaning job
        may delete once nobody goes back further."""
        versions = spark.read.schema(f"{LIVE}, version bigint").parquet(f"{self.root}/versions")
        kept = versions.filter(F.col("version") >= oldest).select("level", "run").distinct()
        gone = versions.select("level", "run").distinct().join(kept, ["level", "run"], "left_anti")
        return sorted(self._run_folder(r.level, r.run) for r in gone.collect())

"""Session helpers: defaults for local runs and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Where a local session without spark.checkpoint.dir, which cannot be set later, keeps its files.
OWN_FOLDER = "spark.presswork.folder"


def local_session(cpus: int | str = 8, name: str = "presswork") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.presswork.spread", str(cpus))
        # plans are built in many small calls; their call sites are not asked for
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares (spark.checkpoint.dir).

    Only a local session may fall back to a temporary folder of its own: on a
    cluster the executors would not see it, so a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = spark.conf.get(OWN_FOLDER, None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="presswork-")
        spark.conf.set(OWN_FOLDER, folder)
    return folder


def new_run_folder(spark: SparkSession, job: str) -> str:
    """A fresh folder below the shared one, never reused by another run."""
    return os.path.join(shared_folder(spark), f"{job}-{uuid.uuid4().hex}")

"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths given out inside the innermost ``scratch_scope``.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def build_session(app_name: str = "tidepost", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time and adaptive execution.

    Arrow batches are limited by bytes, so that long texts don't fill a Python worker, and plans
    are built without recording the Python line of each expression.

    ``master`` stays unset on a cluster (spark-submit names it). Dots in config
    names are given as ``__``: ``spark__sql__shuffle__partitions="64"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder; a cluster
    without it is an error, because executors could not read each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidepost-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (given := _SCOPE.get()) is not None:
        given.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables of a job when the block ends.

    Results that read them must be written or collected inside the block.
    """
    given: list[str] = []
    token = _SCOPE.set(given)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in given:
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage at a table that survives the loss of executors, and fixes the
    outcome of expressions that must not be evaluated twice (ids by position, model scores).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

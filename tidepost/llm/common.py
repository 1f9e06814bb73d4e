"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepost.session import materialize

#: White space of the contracts: space and the control characters tab to carriage return.
WHITE = r"[\x20\x09-\x0D]+"
#: Name of the helper column that identifies a row; not a name that input tables use.
ROW_KEY = "__row_key"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back, so that its rows are fixed."""
    return materialize(df, name)


def bounded_batches(spark: SparkSession, rows: int = 2_000, size: str = "8m") -> None:
    """Prepare a session for Python workers that read texts.

    Limits rows and bytes of an Arrow batch, so that long texts don't fill a worker, and puts the
    folder of this package on the workers' path (for a local session, or an installation that
    all machines share; else the package is sent with ``--py-files``).
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def crc32_bucket(doc_id: Column | str, buckets: int) -> Column:
    """``crc32`` of the id written as text, modulo ``buckets``; null ids count as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % buckets


def row_key(doc_id: Column, digest: Column) -> Column:
    """One string per (id, digest); a null id is a value of its own."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), digest)


def keep_keyed(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is in ``kept`` (column ``ROW_KEY``), one row per key.

    The semi join and the choice among repeated rows share one exchange of the texts.
    """
    order = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map" not in kind and "variant" not in kind]
    rank = F.row_number().over(Window.partitionBy(ROW_KEY).orderBy(*order))
    return (
        docs.withColumn(ROW_KEY, key)
        .join(kept.select(ROW_KEY), ROW_KEY, "left_semi")
        .withColumn("__rank", rank)
        .filter("__rank = 1")
        .select(*docs.columns)
    )

"""Replacement of whole tables: the new version is written beside the old one, checked, and swapped in.

Until the swap the old version is untouched, so it can be read by the job that replaces it, and a job
that fails leaves it as it was. What a broken-off swap leaves behind is put right by the next
replacement, or by ``recover``. A folder is swapped by renaming, which is one step in a file system; in
object stores without folders it is a copy, and a catalog table is the better target there.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

#: Formats whose tables are folders, and those of them that know their rows without being read.
FOLDER_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro")
COUNTED_FORMATS = ("parquet", "orc")
_NEXT, _OLD = ".next-", ".old-"


class Folder:
    """A path in any file system that Spark writes."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        plain = self._path(path.rstrip("/"))
        self.fs = plain.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.path = self.fs.makeQualified(plain)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def sibling(self, mark: str) -> str:
        """A new path beside this one, hidden from readers of the folder above."""
        name = f".{self.path.getName()}{mark}{uuid.uuid4().hex}"
        return self._path(self.path.getParent().toString() + "/" + name).toString()

    def siblings(self, mark: str) -> list[str]:
        """Paths that ``sibling`` gave out, oldest first."""
        above = self.path.getParent()
        if not self.fs.exists(above):
            return []
        start = f".{self.path.getName()}{mark}"
        found = [s for s in self.fs.listStatus(above) if s.getPath().getName().startswith(start)]
        found.sort(key=lambda s: s.getModificationTime())
        return [s.getPath().toString() for s in found]

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def rename(self, source: str, target: str) -> None:
        if not self.fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be renamed to {target}")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def swap_in(self, following: str) -> None:
        """Put ``following`` in this path's place; if that fails, the old version is put back."""
        old = self.sibling(_OLD)
        before = self.exists()
        if before:
            self.rename(self.path.toString(), old)
        try:
            self.rename(following, self.path.toString())
        except BaseException:
            if before and not self.exists():
                self.rename(old, self.path.toString())
            raise
        if before:
            self.delete(old)


def recover(spark: SparkSession, path: str) -> bool:
    """Put the last old version back if a swap broke off between its two renames."""
    folder = Folder(spark, path)
    if folder.exists():
        return False
    old = folder.siblings(_OLD)
    if not old:
        return False
    logger.warning("%s: the last swap was not finished, the old version is put back", path)
    folder.rename(old[-1], folder.path.toString())
    return True


def replace_folder(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    check: bool = True,
) -> int:
    """Replace the table at ``path`` by ``df``, which may read it, and return the rows written.

    Rows are counted while they are written; with ``check`` the new files must hold as many. Parquet
    and ORC files tell their rows in their footers, other formats are read for it.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    recover(spark, path)
    following = folder.sibling(_NEXT)
    watch = Observation("replace_folder")
    writer = df.observe(watch, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    try:
        writer = writer.format(fmt).options(**(options or {}))
        (writer.partitionBy(*partition_by) if partition_by else writer).save(following)
        sent = watch.get.get("rows", 0)
        if check:
            reader = spark.read.format(fmt).options(**(options or {})).schema(df.schema)
            arrived = reader.load(following).count()
            if sent != arrived:
                raise RuntimeError(f"{path}: sent {sent} rows, found {arrived}")
        folder.swap_in(following)
    except BaseException:
        folder.delete(following)
        raise
    spark.catalog.refreshByPath(path)
    for rest in folder.siblings(_OLD):
        folder.delete(rest)
    return sent


def _exists(spark: SparkSession, table: str) -> bool:
    try:
        return spark.catalog.tableExists(table)
    except AnalysisException:
        return False


def _quoted(table: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in table.split("."))


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
    """Replace a catalog table by ``df``, which may read it, and return the rows written.

    The new version is a table of its own until its rows have been counted; then the two change names.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    following, old = f"{table}__next_{mark}", f"{table}__old_{mark}"
    watch = Observation("replace_table")
    writer = df.observe(watch, F.count(F.lit(1)).alias("rows")).write
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(following)
        sent, arrived = watch.get.get("rows", 0), spark.table(following).count()
        if sent != arrived:
            raise RuntimeError(f"{table}: sent {sent} rows, found {arrived}")
        before = _exists(spark, table)
        if before:
            spark.sql(f"ALTER TABLE {_quoted(table)} RENAME TO {_quoted(old)}")
        try:
            spark.sql(f"ALTER TABLE {_quoted(following)} RENAME TO {_quoted(table)}")
        except BaseException:
            if before:
                spark.sql(f"ALTER TABLE {_quoted(old)} RENAME TO {_quoted(table)}")
            raise
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(following)}")
        raise
    if before:
        spark.sql(f"DROP TABLE {_quoted(old)}")
    return sent

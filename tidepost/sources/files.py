"""CSV and parquet sources and sinks."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidepost.functions.columns import in_dates, month_of
from tidepost.operators.shape import union_all
from tidepost.sources.headers import data_files, files_by_header, literal_path
from tidepost.sources.replace import FOLDER_FORMATS, replace_folder, replace_table


logger = logging.getLogger(__name__)

#: Bytes of the files that a table comes from for each task that writes it.
PART_BYTES = 128 * 1024 * 1024


def read_posts_csv(
    spark: SparkSession,
    paths: Sequence[str],
    source: str = "source_file",
    multi_line: bool = True,
    encoding: str = "UTF-8",
    optional: Sequence[str] = (),
    malformed: str | None = None,
) -> DataFrame:
    """Read CSV files or folders with a header as strings and note the file of each row.

    A path that does not exist is an error, unless it is among ``optional``: then it is skipped
    with a warning in the log. Files of one path may differ in their columns and in their order: the
    header lines are read first, files that share one are one scan, and the scans are united by
    name; a column that a file lacks is null in its rows, files without a line have none. With
    ``malformed``, a column of that name holds the text of rows with more or fewer cells than their
    header; missing cells are null, surplus ones are in that text only, and ``malformed_rows`` counts
    such rows for each file. A file with line breaks inside cells cannot be split, so such data should
    come as many files; ``multi_line=False`` reads others in splits.
    """
    options = {
        "header": True,
        "inferSchema": False,
        "multiLine": multi_line,
        "escape": '"',
        "encoding": encoding,
    }
    frames = []
    for path in paths:
        try:
            files = data_files(spark, path)
        except AnalysisException as error:
            if path not in optional or error.getCondition() != "PATH_NOT_FOUND":
                raise
            logger.warning("optional input %s does not exist and is skipped", path)
            continue
        for same in files_by_header(spark, files, encoding).values():
            inputs = [literal_path(f) for f in same]
            reader = spark.read.options(**options)
            names = reader.csv(inputs[0])
            if malformed is not None:
                schema = names.schema.add(malformed, "string")
                # all cells have to be looked at, whatever columns are asked for
                reader = reader.schema(schema).options(
                    columnNameOfCorruptRecord=malformed, columnPruning=False
                )
            else:
                reader = reader.schema(names.schema)
            rows = reader.csv(inputs)
            if malformed is not None and names.columns:
                # Spark does not read this column alone; a test that always holds brings in another
                always = F.xxhash64(F.col(f"`{names.columns[0]}`")) >= F.lit(-(2**63))
                rows = rows.withColumn(malformed, F.when(always, F.col(f"`{malformed}`")))
            frames.append(rows.withColumn(source, F.col("_metadata.file_name")))
    if not frames:
        raise FileNotFoundError(f"none of {list(paths)} can be read")
    return union_all(frames)


def malformed_rows(
    posts: DataFrame, malformed: str, source: str = "source_file"
) -> DataFrame:
    """Rows and malformed rows of each file: ``source, rows, malformed_rows``."""
    return posts.groupBy(source).agg(
        F.count(F.lit(1)).alias("rows"), F.count(malformed).alias("malformed_rows")
    )


def read_labelled_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Labelled posts: the same format without provenance."""
    return read_posts_csv(spark, paths, source="_source").drop("_source")


def load_lookup(spark: SparkSession, path: str, optional: bool = False) -> dict[str, str]:
    """Token dictionary from a JSON object in any file system that Spark reads.

    The last of repeated keys counts. A missing file is an error, or empty if it is ``optional``.
    """
    try:
        text = spark.read.text(path, wholetext=True).first()
    except AnalysisException as error:
        if not optional or error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("optional dictionary %s does not exist", path)
        return {}
    return json.loads(text[0]) if text else {}


def read_stage(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Read a stage table."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def input_bytes(df: DataFrame) -> int:
    """Bytes of all files that a frame reads, 0 if there are none."""
    files = [literal_path(unquote(f)) for f in df.inputFiles()]
    if not files:
        return 0
    found = df.sparkSession.read.format("binaryFile").load(files)  # only lengths are read
    return found.agg(F.sum("length")).first()[0] or 0


def write_stage(
    df: DataFrame,
    path: str,
    partitions: int | None = None,
    rebalance: bool = False,
    partition_by: Sequence[str] = (),
) -> int:
    """Replace a stage table and return the number of rows written.

    The new table is swapped in when it is complete, so ``df`` may read the old one, which stays if
    the job fails. Rows are written where they are and counted meanwhile. ``partitions`` or
    ``rebalance`` (files sized by adaptive execution) shuffle the table first; ``partition_by`` makes a
    folder for each value of these columns. There are more than ``partitions`` where the files that the
    table comes from have more than ``PART_BYTES`` for each, so that a task's share does not grow.
    """
    if partitions is not None:
        df = df.repartition(max(partitions, -(-input_bytes(df) // PART_BYTES)))
    elif rebalance:
        df = df.hint("rebalance")
    options = {"compression": "snappy"}
    return replace_folder(df, path, "parquet", options, partition_by, check=False)


def load_table(
    df: DataFrame,
    target: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> int:
    """Replace a result table, and fail if its row count is not what was sent.

    ``target`` is a catalog table, or with ``fmt`` a path (or what the format takes as one). Tables in
    the catalog and in folders are replaced as a whole once they are complete; ``df`` may read the
    table that it replaces. Other formats, such as JDBC, truncate their table and are read for the
    count.
    """
    if fmt is None:
        return replace_table(df, target, partition_by)
    if fmt in FOLDER_FORMATS:
        return replace_folder(df, target, fmt, options, partition_by)
    watch = Observation("load_table")
    writer = df.observe(watch, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    writer.format(fmt).options(**(options or {})).save(target)
    loaded = df.sparkSession.read.format(fmt).options(**(options or {})).load(target)
    sent, arrived = watch.get["rows"], loaded.count()
    if sent != arrived:
        raise RuntimeError(f"{target}: sent {sent} rows, found {arrived}")
    return arrived


def export_csv(df: DataFrame, path: str) -> str:
    """Write a CSV folder with a header. White space and line breaks survive a round trip; an empty
    string is read back as null."""
    df.write.mode("overwrite").options(
        header=True,
        escape='"',
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


#: Partition column of results that are stored by month.
MONTH = "month"


def write_results(df: DataFrame, path: str, ts: str = "created_at") -> int:
    """Replace a result table that is stored by month of a time, and return the rows written.

    Every month is a folder, rows are sorted by time in its files, and a crowded month has several
    files (sized by adaptive execution). Rows without a time are a folder of their own.
    """
    rows = df.withColumn(MONTH, month_of(ts)).hint("rebalance", MONTH)
    rows = rows.sortWithinPartitions(MONTH, ts)
    return replace_folder(rows, path, "parquet", {"compression": "snappy"}, [MONTH])


def load_results(
    results: DataFrame,
    columns: Sequence[str],
    ts: str = "created_at",
    limit: int | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Chosen columns of the rows that have a time; columns and filters reach the scan.

    ``start`` and ``end`` are dates, both included. Of a table that ``write_results`` has stored, only
    the months between them are read.
    """
    rows = results.filter(in_dates(ts, start, end))
    if MONTH in results.columns:
        if start is not None:
            rows = rows.filter(F.col(MONTH) >= start[:7])
        if end is not None:
            rows = rows.filter(F.col(MONTH) <= end[:7])
    rows = rows.select(*columns)
    return rows if limit is None else rows.limit(limit)


def write_summary(summary: DataFrame, path: str) -> str:
    """Write a one-row summary as JSON."""
    summary.write.mode("overwrite").json(path)
    return path

"""Header lines of CSV files, read before the files are."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession

#: Lines that a header may go on for, when a quoted name has line breaks.
_LINES = 100
_THREADS = 16


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files below a path, folder or pattern, as Spark lists them; a missing path is an error."""
    return sorted(unquote(f) for f in spark.read.text(path).inputFiles())


def header_of(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """First line of a file, compressed or not, without byte order mark; None for an empty file.

    Only the beginning of the file is read. A quoted name may hold line breaks.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
    stream = file.getFileSystem(conf).open(file)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, encoding))
        lines: list[str] = []
        for _ in range(_LINES):
            line = reader.readLine()
            if line is None:
                break
            lines.append(line)
            if sum(part.count('"') for part in lines) % 2 == 0 and "".join(lines).strip():
                break
        return "\n".join(lines).lstrip("\ufeff").strip("\r\n") or None
    finally:
        stream.close()


def files_by_header(
    spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8"
) -> dict[str, list[str]]:
    """Files with the same header line; files without any line are left out.

    One short read a file, several at a time; the driver holds what it holds anyway to plan the scan,
    a name for each file.
    """
    with ThreadPoolExecutor(_THREADS) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f, encoding), files))
    groups: dict[str, list[str]] = {}
    for file, header in zip(files, headers, strict=True):
        if header is not None:
            groups.setdefault(header, []).append(file)
    return groups


def literal_path(path: str) -> str:
    """A path whose characters Spark doesn't take for a pattern."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)

"""Exact duplicates by progressive refinement: length, hash of a prefix, hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import ROW_KEY, WHITE, keep_keyed, row_key, save


def normalised(text: Column) -> Column:
    """Text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def exact_dedup(
    docs: DataFrame,
    prefix_chars: int = 128,
    broadcast_bytes: int = 32 << 20,
    digest: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are compared after ``normalised``. The first pass keeps the length and the hash of the
    first ``prefix_chars`` characters of each text. Lengths that occur once are settled; among the
    others, so are pairs of length and prefix hash that occur once. Only texts of the pairs that
    are left are hashed whole, in a second pass, and only those hashes meet in a shuffle. While
    the pairs need less than ``broadcast_bytes`` (counted) they go to the texts; beyond that, the
    texts are hashed where they are read and narrow rows meet the pairs. No text is shuffled.

    The row with the smallest ``doc_id`` stays, null ids last; of rows that repeat an id and its
    text, one stays. ``keep_id`` is null for a group without ids. ``text_sha256`` is null for
    texts settled early unless ``digest`` asks for all. An empty table gives no rows; empty and
    null texts are equal to each other; other columns play no part.
    """
    rows = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    length = F.length("norm").alias("length")
    prefix = F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix")
    keys = save(rows.select(length, prefix), "exact-keys")
    lengths = keys.groupBy("length").agg(F.count("*").alias("n")).filter("n > 1").select("length")
    pairs = save(
        keys.join(lengths, "length", "left_semi")
        .groupBy("length", "prefix")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select("length", "prefix", F.lit(True).alias("open")),
        "exact-pairs",
    )
    small = pairs.count() * 32 <= broadcast_bytes
    whole = F.sha2(F.col("norm"), 256)
    if small:
        read = rows.select("doc_id", "norm", length, prefix)
        met = read.join(F.broadcast(pairs), ["length", "prefix"], "left")
        sha = whole if digest else F.when(F.col("open"), whole)
    else:
        read = rows.select("doc_id", length, prefix, whole.alias("sha"))
        met = read.join(pairs, ["length", "prefix"], "left")
        sha = F.col("sha") if digest else F.when(F.col("open"), F.col("sha"))
    hashed = save(
        met.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            "length",
            F.coalesce("open", F.lit(False)).alias("open"),
            sha.alias("sha"),
        ),
        "exact-hashed",
    )
    alike = hashed.filter("open")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = alike.groupBy("length", "sha").agg(first, F.count("*").alias("group_size"))
    settled = hashed.filter("NOT open").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    grouped = alike.join(groups, ["length", "sha"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return settled.unionByName(grouped)


def drop_exact(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, one row for each, with the columns of ``docs``."""
    kept = exact_dedup(docs, digest=True, **options).filter("kept")
    kept = kept.select(row_key(F.col("doc_id"), F.col("text_sha256")).alias(ROW_KEY))
    key = row_key(F.col("doc_id"), F.sha2(normalised(F.col("text")), 256))
    return keep_keyed(docs, key, kept)

"""Row numbers, top-n and cut-offs without a single-task sort of the whole table."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepost import fixed
from tidepost.session import materialize

# Largest n that goes through Spark's top-k operator, which gathers n rows of every task.
TOP_K_ROWS = 1_000
# Rows of a range that are few enough to be sorted as one.
RANGE_ROWS = 100_000

_POSITION_BITS = 33
#: Two hashes of a whole row that stand for it.
_ROW = ["_row", "_again"]


def row_hash(df: DataFrame, seed: int | None = None) -> Column:
    """Hash of all columns; null differs from other values."""
    parts = [] if seed is None else [F.lit(seed)]
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        parts += [column.isNull(), F.to_json(column) if "map" in kind or "variant" in kind else column]
    return F.xxhash64(*parts)


def _hashed(df: DataFrame) -> DataFrame:
    return df.select("*", row_hash(df).alias(_ROW[0]), row_hash(df, 1).alias(_ROW[1]))


def _fetched(df: DataFrame, places: DataFrame) -> DataFrame:
    """Whole rows of ``places`` (the hashes, ``_times`` and other columns), each ``_times`` times.

    Rows with the same hashes are equal, so where there are several, one of them stands for all;
    ``_time`` numbers them from 0.
    """
    rows = _hashed(df)
    if places.filter("_times > 1").isEmpty():
        return rows.join(places, _ROW).withColumn("_time", F.lit(0))
    times = F.explode(F.sequence(F.lit(0), F.col("_times") - 1))
    return rows.dropDuplicates(_ROW).join(places, _ROW).withColumn("_time", times)


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str = "row_number", start: int = 1
) -> DataFrame:
    """Contiguous numbers in ``order``, which must be total.

    Only what is compared and a hash of each row go into the range shuffle, and only the hash and a
    place are written: the increasing id of a row holds its partition and its position there, and the
    partition sizes (one row per partition, hence small) belong to the same placement. The columns are
    fetched afterwards, by the hash. Rows that are equal in all columns get numbers of their own.
    """
    placed = (
        _hashed(df)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*_ROW, F.monotonically_increasing_id().alias("_place"))
    )
    placed = materialize(placed, "numbered").withColumn(
        "_part", F.shiftright("_place", _POSITION_BITS)
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    numbers = placed.join(F.broadcast(starts), "_part").select(
        *_ROW, (F.col("_start") + position + F.lit(start)).alias("_number")
    )
    # equal rows stand together in a total order
    equal = numbers.groupBy(*_ROW).agg(
        F.min("_number").alias("_number"), F.count(F.lit(1)).alias("_times")
    )
    number = (F.col("_number") + F.col("_time")).alias(name)
    return _fetched(df, equal).select(*df.columns, number)


def _first_places(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """Hashes of the first ``n`` rows, sorting no more than one small range of them.

    Rows are dealt to ranges and counted; ranges before the n-th row are in as a whole, and the rows of
    the one that holds it are dealt again, until they are few.
    """
    chosen, current, need = [], _hashed(df), n
    while True:
        placed = current.repartitionByRange(*order).select(
            *_ROW, F.spark_partition_id().alias("_part")
        )
        placed = materialize(placed, "ranges")
        sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("rows")).collect()
        before, border = 0, None
        for part in sorted(sizes):
            if before + part["rows"] > need:
                border = part
                break
            before += part["rows"]
        if border is None:
            chosen.append(placed)
            break
        chosen.append(placed.filter(F.col("_part") < F.lit(border["_part"])))
        need -= before
        near = placed.filter(F.col("_part") == F.lit(border["_part"])).select(*_ROW).distinct()
        current = current.join(near, _ROW, "left_semi")
        if border["rows"] <= RANGE_ROWS or len(sizes) == 1:
            chosen.append(current.orderBy(*order).limit(need))
            break
    return functools.reduce(DataFrame.unionByName, [c.select(*_ROW) for c in chosen])


def top_n(
    df: DataFrame, order: Sequence[str | Column], n: int, in_order: bool = True
) -> DataFrame:
    """The first ``n`` rows in ``order``, which must be total; in that order unless it isn't asked for.

    Rows are the same for any n. Up to ``TOP_K_ROWS`` Spark's top-k does it; beyond, which would bring n
    rows of every task to one task, rows are counted by range (``_first_places``) and the columns of the
    chosen ones are fetched afterwards. Hashes of rows are written while the frame is built.
    """
    if n <= TOP_K_ROWS:
        return df.orderBy(*order).limit(n)
    places = _first_places(df, order, n).groupBy(*_ROW).agg(F.count(F.lit(1)).alias("_times"))
    found = _fetched(df, materialize(places, "first-places"))
    return (found.orderBy(*order) if in_order else found).select(*df.columns)


def smallest_scores(df: DataFrame, score: Column, n: int, bins: int = 65_536) -> DataFrame:
    """Rows that can be among the ``n`` smallest of a score in [0, 1], and few others.

    Counts per score bin (at most ``bins`` + 2 rows) give the bin in which the n-th row lies;
    everything above it is filtered out before any sort. NaN and null scores come last, as they do
    in a sort.
    """
    slot = F.least(F.floor(F.when(~F.isnan(score.cast("double")), score) * bins), F.lit(bins))
    slot = F.coalesce(slot, F.lit(bins + 1))
    counts = df.groupBy(slot.alias("_bin")).agg(F.count(F.lit(1)).alias("_rows"))
    running = F.sum("_rows").over(Window.orderBy("_bin"))
    cut = (
        counts.withColumn("_running", running)
        .filter(F.col("_running") >= n)
        .agg(F.coalesce(F.min("_bin"), F.lit(bins + 1)))
        .scalar()
    )
    return df.filter(slot <= cut)


def most_uncertain(
    df: DataFrame, n: int, margin: str, entropy: str, ties: Sequence[str | Column]
) -> DataFrame:
    """Least certain rows first: margin ascending, entropy descending, then ``ties``.

    The frame is read twice; give it as a written table when its scores come from a model.
    """
    order = [F.col(margin).asc_nulls_last(), F.col(entropy).desc_nulls_last(), *ties]
    return top_n(smallest_scores(df, F.col(margin), n), order, n)


def review_queue(
    df: DataFrame,
    flag: str,
    confidence: str,
    ties: Sequence[str | Column],
    rows: int = fixed.REVIEW_QUEUE_ROWS,
) -> DataFrame:
    """Rows waiting for review, least confident first, unknown confidence last."""
    order = [F.col(confidence).asc_nulls_last(), *ties]
    return df.filter(F.col(flag)).orderBy(*order).limit(rows)


def by_time(df: DataFrame, ts: str, ties: Sequence[str | Column]) -> DataFrame:
    """Full ordering by time; the ties keep a crowded moment from becoming one range."""
    return df.orderBy(ts, *ties)


def preview(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)

"""Duplicate removal with a stated survivor.

``row_number() = 1`` lets Spark keep one row per key in every task before the shuffle
(window group limit), so a key that holds a large share of the rows sends at most one row per
task to its partition. Null keys form one group.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per key: the first in ``order``, which must be total for a repeatable result.

    Null is a key like others, so one of the rows without any key stays, as in ``dropDuplicates``; with
    ``keep_null_keys`` all rows stay that lack all keys, as nothing tells that they are copies.
    """
    if keep_null_keys:
        columns = [F.col(k) if isinstance(k, str) else k for k in keys]
        none = functools.reduce(operator.and_, [c.isNull() for c in columns])
        return dedup(df.filter(~none), keys, order).unionByName(df.filter(none))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def keep_best(
    df: DataFrame, key: str, metric: str, ties: Sequence[str | Column] = ()
) -> DataFrame:
    """Per key the row with the largest metric; a missing metric counts as zero."""
    best = F.coalesce(F.col(metric), F.lit(0)).desc()
    return dedup(df, [key], [best, *ties])


def removed_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before, after and removed, as one row."""
    return before.agg(F.count(F.lit(1)).alias("rows_before")).select(
        "rows_before", after.agg(F.count(F.lit(1))).scalar().alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))

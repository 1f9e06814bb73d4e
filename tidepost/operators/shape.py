"""Column sets: validation, alignment, renaming, unions."""

from __future__ import annotations

import functools
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)


def require(df: DataFrame, columns: Sequence[str], what: str = "input") -> DataFrame:
    """Fail at plan time with one message that names every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def first_available(df: DataFrame, candidates: Sequence[str]) -> str:
    """First of the candidate columns that the frame has."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of {list(candidates)} in {df.columns}")


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def add_missing(df: DataFrame, columns: Mapping[str, str | T.DataType]) -> DataFrame:
    """Add absent columns as typed nulls."""
    absent = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def align(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames cut to their shared columns, in the order of the left one."""
    shared = [c for c in left.columns if c in right.columns]
    return left.select(*shared), right.select(*shared)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that a frame lacks is null in its rows."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def project_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename by ``{source: target}``; absent sources are skipped and named in the log."""
    present = [F.col(s).alias(t) for s, t in mapping.items() if s in df.columns]
    if absent := [s for s in mapping if s not in df.columns]:
        logger.warning("columns %s are absent and skipped", absent)
    if not present:
        raise ValueError(f"none of {list(mapping)} in {df.columns}")
    return df.select(*present)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique, increasing, not contiguous; write the result before the id is used as a key."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Constant provenance columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions are evaluated once per row, whatever reads them.

    A plain projection is merged into the filters above it, so that an expensive expression would
    run again for every test on its result; a generator in between keeps them apart.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline_outer(F.array(row)))


def rows_of(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn the columns of a one-row frame into several rows."""
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))

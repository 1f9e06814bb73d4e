"""Typed columns from loose ones: flags, labels, numbers, times, buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepost import fixed
from tidepost.functions.text import strip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_bool(c: Column | str) -> Column:
    """``true``, ``1``, ``yes`` in any case are true; anything else, null included, is false."""
    text = F.lower(F.trim(_col(c).cast("string")))
    return F.coalesce(text.isin(fixed.TRUE_WORDS), F.lit(False))


def to_bool_strict(c: Column | str) -> Column:
    """``true``/``1`` and ``false``/``0``; anything else is null."""
    text = F.lower(strip(_col(c).cast("string")))
    return F.when(text.isin(fixed.STRICT_TRUE), True).when(text.isin(fixed.STRICT_FALSE), False)


def to_double(c: Column | str) -> Column:
    """Number or null; NaN counts as missing."""
    number = _col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_long(c: Column | str) -> Column:
    """Whole number or null; the fraction of a decimal text is cut off."""
    return F.coalesce(_col(c).try_cast("bigint"), to_double(c).try_cast("bigint"))


def number_or_zero(c: Column | str) -> Column:
    return F.coalesce(to_double(c), F.lit(0.0))


def clean_label(c: Column | str) -> Column:
    return F.trim(F.lower(_col(c)))


def encode_label(c: Column | str, labels: Sequence[str]) -> Column:
    """Position of the label in ``labels``; unknown or null gives -1."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), _col(c))
    return F.coalesce(position.cast("int") - 1, F.lit(-1))


def decode_label(c: Column | str, labels: Sequence[str]) -> Column:
    """Label at a position; a position outside the list gives null."""
    c = _col(c)
    return F.when(c >= 0, F.get(F.array(*[F.lit(x) for x in labels]), c))


def display_label(c: Column | str, names: Mapping, default: str = "Unknown") -> Column:
    c = _col(c)
    chain = None
    for value, name in names.items():
        chain = (F if chain is None else chain).when(c == F.lit(value), F.lit(name))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def engagement(*counts: Column | str) -> Column:
    """Sum of interaction counts; a missing count is zero."""
    total = F.lit(0)
    for c in counts:
        total = total + F.coalesce(_col(c), F.lit(0))
    return total


def author_of(url: Column | str, pattern: str = fixed.AUTHOR_PATTERN) -> Column:
    """Account name in a post address, null where there is none."""
    return F.nullif(F.regexp_extract(_col(url), pattern, 1), F.lit(""))


def month_of(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def in_dates(ts: Column | str, start: str | None = None, end: str | None = None) -> Column:
    """Dates from ``start`` to ``end``, both included.

    Written as a half-open range on the raw timestamp so that it reaches the scan.
    """
    ts = _col(ts)
    test = ts.isNotNull()
    if start is not None:
        test = test & (ts >= F.lit(start).cast("date"))
    if end is not None:
        test = test & (ts < F.date_add(F.lit(end).cast("date"), 1))
    return test


def bucket_index(c: Column | str, edges: Sequence[float] = fixed.CONFIDENCE_EDGES) -> Column:
    """Position of the right-closed bucket, lowest edge included; outside gives null."""
    c = _col(c)
    chain = F.when((c >= edges[0]) & (c <= edges[1]), 0)
    for i in range(1, len(edges) - 1):
        chain = chain.when((c > edges[i]) & (c <= edges[i + 1]), i)
    return chain


def bucketize(
    c: Column | str,
    edges: Sequence[float] = fixed.CONFIDENCE_EDGES,
    labels: Sequence[str] = fixed.CONFIDENCE_LABELS,
) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), bucket_index(c, edges))


def resolve_sentiment(
    sentiment: Column | str, irony: Column | str, flips: Sequence[str], to: str
) -> Column:
    """Final sentiment: a label in ``flips`` becomes ``to`` where the text is ironic."""
    sentiment = _col(sentiment)
    return F.when((_col(irony) == 1) & sentiment.isin(list(flips)), F.lit(to)).otherwise(sentiment)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0 for an empty whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))

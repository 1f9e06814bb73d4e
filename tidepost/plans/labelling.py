"""Labelled baseline and unlabelled pool."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidepost.functions.columns import clean_label, encode_label
from tidepost.operators.dedup import dedup
from tidepost.operators.lookup import (
    BROADCAST_BYTES,
    digest_of,
    exclude_matches,
    with_clean_text,
)
from tidepost.operators.shape import compute_once, require, with_constants
from tidepost.session import materialize

# Bytes of a row of digests that are broadcast: two digests and a fixed amount.
_DIGESTS = 128


def valid_labels(df: DataFrame, label: str, text: str, labels: Sequence[str]) -> DataFrame:
    """Rows with a known label (trimmed, lower case) and a text that is not blank."""
    return (
        df.withColumn(label, clean_label(label))
        .filter(F.col(label).isin(list(labels)))
        .filter(F.col(text).isNotNull() & (F.trim(text) != ""))
    )


def labelled_baseline(
    df: DataFrame,
    labels: Sequence[str],
    order: Sequence[str | Column],
    label: str = "sentiment",
    text: str = "text",
    lookup: Mapping[str, str] | None = None,
    source: str = "baseline_manual",
) -> DataFrame:
    """Valid labels, one row per text, label ids, provenance.

    The text is cleaned like the pool, so that a classifier is trained on what it scores later.
    """
    require(df, [label, text], "labelled posts")
    one_per_text = dedup(valid_labels(df, label, text, labels), [text], order)
    return with_constants(
        with_clean_text(
            one_per_text.withColumn("label_id", encode_label(label, labels)),
            text,
            "text_clean",
            lookup,
        ),
        label_source=source,
        review_required=False,
    )


def unlabelled_pool(
    posts: DataFrame,
    baseline: DataFrame,
    order: Sequence[str | Column],
    url: str = "url",
    text: str = "text",
    clean: str = "text_clean",
    salts: int = 1,
) -> DataFrame:
    """Posts whose url and text are not in the baseline, one row per cleaned text, marked.

    Urls and texts are compared by digests, which are computed where the posts are, so that only
    columns which are asked for go through the shuffles. The baseline is read once: its digests are
    written while the frame is built, and broadcast if they are few enough.
    """
    is_text = {c: posts.schema[c].dataType == StringType() for c in (url, text, clean)}
    for c in (url, text):
        is_text[c] &= baseline.schema[c].dataType == StringType()
    keys = {c: digest_of(c) if is_text[c] else F.col(c) for c in (url, text, clean)}
    known = materialize(
        baseline.select(keys[url].alias("_url_key"), keys[text].alias("_text_key")), "known"
    )
    if salts <= 1 and known.count() * _DIGESTS <= BROADCAST_BYTES:
        known = F.broadcast(known)
    marked = compute_once(posts, _url_key=keys[url], _text_key=keys[text], _clean_key=keys[clean])
    # rows without a key are spread by what tells them apart
    row = [*[c for c in order if isinstance(c, str)], "_url_key", "_text_key", "_clean_key"]
    rest = exclude_matches(marked, known, "_url_key", salts=salts, row=row)
    rest = exclude_matches(rest, known, "_text_key", salts=salts, row=row)
    return with_constants(
        dedup(rest, ["_clean_key"], order).select(*posts.columns),
        label_source="unlabeled",
        review_required=True,
    )

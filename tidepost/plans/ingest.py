"""Raw posts to cleaned posts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost import fixed
from tidepost.functions.columns import to_bool
from tidepost.functions.text import contains_any, contains_word, token_count
from tidepost.operators.dedup import dedup
from tidepost.operators.lookup import with_clean_text
from tidepost.operators.shape import first_available, require


def keyword_filter(df: DataFrame, column: str, keywords: Sequence[str]) -> DataFrame:
    """Rows whose text holds a keyword as a substring; null text is dropped."""
    return df.filter(contains_any(column, keywords))


def word_filter(
    df: DataFrame, column: str, words: Sequence[str] = (), phrases: Sequence[str] = ()
) -> DataFrame:
    """Rows whose text holds a whole word or a phrase; null text is dropped."""
    return df.filter(contains_word(column, words, phrases))


def min_tokens(df: DataFrame, column: str, least: int = fixed.MIN_TOKENS) -> DataFrame:
    """Add ``token_count`` and drop texts with fewer tokens."""
    return df.withColumn("token_count", token_count(column)).filter(
        F.col("token_count") >= least
    )


def with_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Booleans ``{source: target}`` from loose text; a missing source gives false."""
    return df.withColumns(
        {
            target: to_bool(source) if source in df.columns else F.lit(False)
            for source, target in flags.items()
        }
    )


def with_ingestion_time(df: DataFrame, name: str = "ingestion_ts") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def clean_posts(
    raw: DataFrame,
    keywords: Sequence[str],
    lookup: Mapping[str, str] | None = None,
    flags: Mapping[str, str] | None = None,
    keys: Sequence[str] = ("id", "url", "text"),
    order: Sequence[str] | None = None,
    least: int = fixed.MIN_TOKENS,
) -> DataFrame:
    """Relevance filter, dedup, cleaning, short-text filter, flags, ingestion time.

    Duplicates are dropped on the first of ``keys`` that the frame has. The survivor is the first
    relevant copy in ``order`` (all columns if not given), so irrelevant rows are filtered out
    before the shuffle. Texts are cleaned once, after it.
    """
    require(raw, ["text"], "raw posts")
    key = first_available(raw, keys)
    relevant = keyword_filter(raw, "text", keywords)
    kept = dedup(relevant, [key], list(order) if order else raw.columns)
    cleaned = with_clean_text(kept, "text", "text_clean", lookup)
    cleaned = min_tokens(cleaned, "text_clean", least)
    return with_ingestion_time(with_flags(cleaned, flags or {}))

"""Sentiment and irony predictions to a final sentiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.functions.columns import display_label, resolve_sentiment
from tidepost.operators.lookup import attach_predictions
from tidepost.operators.shape import require

IRONY_NAMES = {1: "sarcasm"}


def fill_irony(df: DataFrame) -> DataFrame:
    """A post without an irony prediction counts as not ironic, with confidence 0."""
    return df.withColumns(
        {
            "sarcasm_label": F.coalesce("sarcasm_label", F.lit(0)),
            "sarcasm_confidence": F.coalesce("sarcasm_confidence", F.lit(0.0)),
        }
    )


def merge_predictions(
    scored: DataFrame,
    irony: DataFrame,
    flips: Sequence[str],
    to: str,
    key: str = "id",
    label: str = "sentiment",
    salts: int = 1,
) -> DataFrame:
    """Attach irony by key, fill the gaps, name the class and resolve the final sentiment."""
    require(scored, [key, label], "scored posts")
    require(irony, [key, "sarcasm_label", "sarcasm_confidence"], "irony predictions")
    as_text = F.col(key).cast("string")
    posts = scored.withColumn(key, as_text).withColumnRenamed(label, "sentiment_label")
    merged = attach_predictions(
        posts, irony.withColumn(key, as_text), key, ["sarcasm_confidence", "sarcasm_label"], salts
    )
    matched = F.col("sarcasm_label").isNotNull()
    return fill_irony(merged.withColumn("irony_matched", matched)).withColumns(
        {
            "sarcasm_text": display_label("sarcasm_label", IRONY_NAMES, "non_sarcasm"),
            "final_sentiment": resolve_sentiment("sentiment_label", "sarcasm_label", flips, to),
        }
    )

"""Typed export of the final table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost import fixed
from tidepost.functions.columns import to_bool_strict, to_double, to_long
from tidepost.functions.times import is_lost, parse_time
from tidepost.operators.shape import project_map, rows_of
from tidepost.sources.files import export_csv, load_table, write_results

# Columns of the result table and where they come from.
EXPORT_COLUMNS = {
    "id": "tweet_id",
    "url": "url",
    "createdAt": "created_at",
    "text": "text",
    "text_clean": "text_clean",
    "lang": "lang",
    "retweetCount": "retweet_count",
    "replyCount": "reply_count",
    "likeCount": "like_count",
    "quoteCount": "quote_count",
    "viewCount": "view_count",
    "is_reply": "is_reply",
    "is_retweet": "is_retweet",
    "is_quote": "is_quote",
    "sentiment_label": "sentiment_label",
    "predicted_sentiment": "predicted_sentiment",
    "model_confidence": "model_confidence",
    "prob_negatif": "prob_negatif",
    "prob_netral": "prob_netral",
    "prob_positif": "prob_positif",
    "label_source": "label_source",
    "review_required": "review_required",
    "uncertainty_entropy": "uncertainty_entropy",
    "uncertainty_margin": "uncertainty_margin",
    "sarcasm_label": "sarcasm_label",
    "sarcasm_text": "sarcasm_text",
    "sarcasm_confidence": "sarcasm_confidence",
    "final_sentiment": "final_sentiment",
    "ingestion_ts": "ingestion_ts",
    "source_file": "source_file",
    "token_count": "token_count",
}


@dataclass(frozen=True)
class ExportTypes:
    """Result columns by the type they get; the names are fixed values of the result table."""

    strings: Sequence[str] = ("tweet_id",)
    addresses: Sequence[str] = ("url",)
    flags: Sequence[str] = ("is_reply", "is_retweet", "is_quote", "review_required")
    whole: Sequence[str] = (
        "retweet_count",
        "reply_count",
        "like_count",
        "quote_count",
        "view_count",
        "sarcasm_label",
        "token_count",
    )
    decimals: Sequence[str] = (
        "model_confidence",
        "prob_negatif",
        "prob_netral",
        "prob_positif",
        "uncertainty_entropy",
        "uncertainty_margin",
        "sarcasm_confidence",
    )
    times: Sequence[str] = ("created_at",)
    time_formats: Sequence[str] = field(default_factory=tuple)


def _casts(columns: Sequence[str], types: ExportTypes) -> dict[str, Column]:
    casts = {
        **{c: F.col(c).cast("string") for c in types.strings},
        **{c: F.substring(F.col(c).cast("string"), 1, fixed.URL_LENGTH) for c in types.addresses},
        **{c: to_bool_strict(c) for c in types.flags},
        **{c: to_long(c) for c in types.whole},
        **{c: to_double(c) for c in types.decimals},
        **{c: parse_time(c, types.time_formats) for c in types.times},
    }
    return {name: cast for name, cast in casts.items() if name in columns}


def coerce_export(df: DataFrame, types: ExportTypes | None = None) -> DataFrame:
    """Cast the columns that are present; what cannot be cast becomes null, null stays null."""
    return df.withColumns(_casts(df.columns, types or ExportTypes()))


def export_losses(df: DataFrame, types: ExportTypes | None = None) -> DataFrame:
    """``column, filled, lost``: values that aren't blank, and those among them that become null.

    One row for each column that ``coerce_export`` casts, from one pass over the table.
    """
    casts = _casts(df.columns, types or ExportTypes())
    filled = {c: F.trim(F.col(c).cast("string")) != "" for c in casts}
    counts = df.agg(
        *[F.count_if(filled[c]).alias(f"{c}_filled") for c in casts],
        *[F.count_if(is_lost(c, cast)).alias(f"{c}_lost") for c, cast in casts.items()],
    )
    rows = [
        {"column": F.lit(c), "filled": F.col(f"{c}_filled"), "lost": F.col(f"{c}_lost")}
        for c in casts
    ]
    return rows_of(counts, rows)


def export_frame(
    final: DataFrame,
    columns: Mapping[str, str] = EXPORT_COLUMNS,
    types: ExportTypes | None = None,
) -> DataFrame:
    return coerce_export(project_map(final, columns), types)


def export_results(
    final: DataFrame,
    target: str,
    fmt: str | None = None,
    csv_path: str | None = None,
    columns: Mapping[str, str] = EXPORT_COLUMNS,
    types: ExportTypes | None = None,
    by_month: str | None = None,
) -> int:
    """Load the result table, check it, and optionally copy it as CSV from the loaded table.

    ``by_month`` names a time: the table is then a folder of parquet files for each of its months.
    """
    if final.isEmpty():
        raise ValueError("nothing to export")
    results = export_frame(final, columns, types)
    if by_month is not None:
        if fmt not in (None, "parquet"):
            raise ValueError(f"results by month are parquet, not {fmt}")
        fmt, rows = "parquet", write_results(results, target, by_month)
    else:
        rows = load_table(results, target, fmt)
    if csv_path is not None:
        spark = final.sparkSession
        loaded = spark.table(target) if fmt is None else spark.read.format(fmt).load(target)
        export_csv(loaded, csv_path)
    return rows

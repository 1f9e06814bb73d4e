"""Report aggregates over the final table.

Labels are few, so every aggregate is partial in the tasks first and nothing is windowed per
label over the table; windows run over grouped rows only. Rows without a label are a group of their
own wherever rows are counted, so that the groups add up to all rows; means and medians by label
(``counts.mean_by``, ``counts.median_by``) leave them out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepost import fixed
from tidepost.functions.columns import (
    bucket_index,
    display_label,
    in_dates,
    month_of,
    number_or_zero,
    percent,
)
from tidepost.operators.counts import distribution
from tidepost.operators.shape import rows_of


def _rows() -> Column:
    return F.count(F.lit(1))


def report_rows(df: DataFrame, ts: str, label: str, numbers: Sequence[str]) -> DataFrame:
    """Rows a report reads: with a time, lower-case label, numbers without gaps, month and year."""
    return df.filter(F.col(ts).isNotNull()).withColumns(
        {
            label: F.lower(label),
            **{c: number_or_zero(c) for c in numbers},
            "month": month_of(ts),
            "year": F.year(ts),
        }
    )


def report_filter(
    df: DataFrame,
    label: str,
    labels: Sequence[str],
    ts: str,
    start: str | None = None,
    end: str | None = None,
    irony: str | None = None,
) -> DataFrame:
    """Label in a set, dates with both ends, optionally ironic texts only."""
    rows = df.filter(F.col(label).isin(list(labels)))
    if start is not None or end is not None:
        rows = rows.filter(in_dates(ts, start, end))
    return rows if irony is None else rows.filter(F.col(irony) == 1)


def sentiment_summary(df: DataFrame, label: str, irony: str, pending: str) -> DataFrame:
    """Rows, rows waiting for review and percentage of all, per label and irony."""
    grouped = df.groupBy(label, irony).agg(
        _rows().alias("count"), F.count_if(F.col(pending)).alias("pending_review")
    )
    total = F.sum("count").over(Window.partitionBy())
    return grouped.withColumn("percentage", F.round(F.col("count") * 100.0 / total, 2)).orderBy(
        F.desc("count"), label, irony
    )


def kpi_row(
    df: DataFrame, label: str, labels: Sequence[str], confidence: str, irony: str
) -> DataFrame:
    """One row: total, number and percentage per label, mean confidence in percent, irony."""
    one = df.agg(
        _rows().alias("total"),
        *[F.count_if(F.col(label) == x).alias(f"n_{x}") for x in labels],
        (F.avg(confidence) * 100).alias("avg_confidence"),
        F.coalesce(F.sum(F.col(irony)), F.lit(0)).cast("bigint").alias("n_irony"),
    )
    shares = {f"pct_{x}": percent(F.col(f"n_{x}"), F.col("total")) for x in labels}
    return one.withColumns({**shares, "pct_irony": percent(F.col("n_irony"), F.col("total"))})


def monthly_counts(df: DataFrame, ts: str, label: str) -> DataFrame:
    return (
        df.groupBy(month_of(ts).alias("month"), label)
        .agg(_rows().alias("count"))
        .orderBy("month", label)
    )


def monthly_share(
    df: DataFrame,
    ts: str,
    label: str,
    labels: Sequence[str],
    watched: str,
    threshold: float = fixed.ALERT_PERCENT,
) -> DataFrame:
    """Per month a column per label, their total, the percentage of one label, and an alert."""
    wide = df.groupBy(month_of(ts).alias("month")).agg(
        *[F.count_if(F.col(label) == x).alias(x) for x in labels]
    )
    total = sum((F.col(x) for x in labels[1:]), F.col(labels[0]))
    share = F.when(F.col("total") > 0, F.col(watched) / F.col("total") * 100)
    return (
        wide.withColumn("total", total)
        .withColumn("pct", share)
        .withColumn("alert", F.coalesce(F.col("pct") >= threshold, F.lit(False)))
        .orderBy("month")
    )


def _per_bucket(column: str, edges: Sequence[float]) -> list[Column]:
    slot = bucket_index(column, edges)
    return [F.count_if(slot == i).alias(f"_b{i}") for i in range(len(edges) - 1)]


def bucket_distribution(
    df: DataFrame,
    column: str,
    edges: Sequence[float] = fixed.CONFIDENCE_EDGES,
    labels: Sequence[str] = fixed.CONFIDENCE_LABELS,
) -> DataFrame:
    """Rows per bucket in bucket order; empty buckets have zero, values outside are not counted."""
    rows = [
        {"position": F.lit(i), "bucket": F.lit(name), "count": F.col(f"_b{i}")}
        for i, name in enumerate(labels)
    ]
    return rows_of(df.agg(*_per_bucket(column, edges)), rows)


def label_by_bucket(
    df: DataFrame,
    label: str,
    column: str,
    edges: Sequence[float] = fixed.CONFIDENCE_EDGES,
    labels: Sequence[str] = fixed.CONFIDENCE_LABELS,
) -> DataFrame:
    """Rows per occurring label and every bucket, empty cells included."""
    grouped = df.filter(F.col(label).isNotNull()).groupBy(label).agg(*_per_bucket(column, edges))
    rows = [
        {
            label: F.col(label),
            "position": F.lit(i),
            "bucket": F.lit(name),
            "count": F.col(f"_b{i}"),
        }
        for i, name in enumerate(labels)
    ]
    return rows_of(grouped, rows)


def irony_by_label(df: DataFrame, irony: str, label: str, names: Mapping) -> DataFrame:
    """Rows per irony class, by display name, and label."""
    return (
        df.groupBy(irony, label)
        .agg(_rows().alias("count"))
        .select(display_label(irony, names).alias("irony"), label, "count")
        .orderBy("irony", label)
    )


def high_uncertainty(
    df: DataFrame, label: str, entropy: str, threshold: float = fixed.HIGH_ENTROPY
) -> DataFrame:
    """Rows above an entropy per label, with their total and its percentage of all rows."""
    grouped = df.groupBy(label).agg(
        F.count_if(F.col(entropy) > threshold).alias("count"), _rows().alias("_rows")
    )
    everything = Window.partitionBy()
    return (
        grouped.withColumns(
            {
                "high_total": F.sum("count").over(everything),
                "_all": F.sum("_rows").over(everything),
            }
        )
        .withColumn("high_pct", percent(F.col("high_total"), F.col("_all")))
        .filter(F.col("count") > 0)
        .drop("_rows", "_all")
    )


def label_source_share(df: DataFrame, source: str) -> DataFrame:
    return distribution(df, [source], share=True, few_values=True)


def irony_changes(df: DataFrame, before: str, after: str, matched: str) -> DataFrame:
    """One row: total, labels changed by irony, rows without an irony prediction."""
    return df.agg(
        _rows().alias("total"),
        F.count_if(F.col(before) != F.col(after)).alias("changed"),
        F.count_if(~F.col(matched)).alias("unmatched"),
    )


def changed_examples(
    df: DataFrame, before: str, after: str, columns: Sequence[str], order: Sequence[str], n: int = 10
) -> DataFrame:
    rows = df.filter(F.col(before) != F.col(after)).orderBy(*order).limit(n)
    return rows.select(*columns)

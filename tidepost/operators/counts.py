"""Counts, distributions, histograms, profiles and medians."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidepost import fixed
from tidepost.operators.shape import rows_of, union_all
from tidepost.session import materialize

# Inverse of the relative rank error of the sketch that divides values into intervals, the shares at
# which they end, and the number of different values that are few enough to be put in order.
_SKETCH = 50_000
_QUANTILES = [i / 128 for i in range(1, 128)]
RANKED_VALUES = 1_000_000


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every stage, in the given order."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(i).alias("position"), F.lit(name).alias("stage"), "rows"
            )
            for i, (name, df) in enumerate(stages.items())
        ]
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here while another action runs; read ``.get["rows"]`` after it."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def distribution(
    df: DataFrame,
    columns: Sequence[str],
    n: int | None = None,
    share: bool = False,
    few_values: bool = False,
) -> DataFrame:
    """Rows per value, most frequent first; optionally the top ``n`` and the percentage.

    The total is a scalar subquery over the counts, because the number of values is not bounded;
    it may read the input again. For columns known to have few values (labels, languages, sources)
    ``few_values`` adds up the count rows in one window instead.
    """
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    result = counts
    if share:
        if few_values:
            total = F.sum("count").over(Window.partitionBy())
        else:
            total = counts.agg(F.sum("count")).scalar()
        result = counts.withColumn("percent", F.col("count") / total * 100)
    result = result.orderBy(F.desc("count"), *columns)
    return result if n is None else result.limit(n)


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, non-null, null, null percentage and distinct values.

    Exact distinct counts shuffle every distinct value once; ``approx`` uses a sketch per column
    and no shuffle of values.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggregates += [F.count(F.col(c)).alias(f"_n{i}"), distinct(F.col(c)).alias(f"_d{i}")]
    one = df.agg(*aggregates)
    rows = []
    for i, (name, kind) in enumerate(df.dtypes):
        nulls = F.col("_rows") - F.col(f"_n{i}")
        rows.append(
            {
                "column": F.lit(name),
                "dtype": F.lit(kind),
                "non_null": F.col(f"_n{i}"),
                "null_count": nulls,
                "null_pct": F.round(
                    F.when(F.col("_rows") > 0, nulls / F.col("_rows") * 100).otherwise(0.0), 2
                ),
                "unique": F.col(f"_d{i}"),
            }
        )
    return rows_of(one, rows).orderBy(F.desc("null_pct"), "column")


def histogram(df: DataFrame, column: str, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over the range of the column, the last one closed, empty ones included.

    Null, NaN and infinite values are in no bin and don't widen the range.
    """
    value = F.col(column).cast("double")
    value = F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        ).alias("ends")
    )
    placed = df.select(value.alias("v")).filter("v IS NOT NULL").withColumn("ends", ends.scalar())
    width = F.col("ends.hi") - F.col("ends.lo")
    slot = F.least(F.floor((F.col("v") - F.col("ends.lo")) / width * bins), F.lit(bins - 1))
    counts = placed.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    step = (F.col("ends.hi") - F.col("ends.lo")) / bins
    every = ends.select("ends", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (
        every.join(F.broadcast(counts), "bin", "left")  # at most ``bins`` rows
        .select(
            F.col("bin").cast("bigint").alias("bin"),
            (F.col("ends.lo") + F.col("bin") * step).alias("bin_start"),
            (F.col("ends.lo") + (F.col("bin") + 1) * step).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def unpivoted(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Long form ``key, metric, value`` with values as doubles."""
    wide = df.select(key, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot([key], list(metrics), "metric", "value")


def mean_by(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Mean of every metric per key, in long form; rows without a key are left out."""
    wide = df.filter(F.col(key).isNotNull()).groupBy(key)
    return unpivoted(wide.agg(*[F.avg(m).alias(m) for m in metrics]), key, metrics).select(
        key, "metric", F.col("value").alias("mean")
    )


def median_by(df: DataFrame, key: str, metrics: Sequence[str], approx: bool = False) -> DataFrame:
    """Median of every metric per key, in long form; rows without a key are left out.

    The exact median never gathers the values of a key. Values are counted and written; where a key
    has more than ``RANKED_VALUES`` different ones, quantiles of them divide them into intervals, the
    rows of each interval are counted, and only the intervals in which the middle lies are kept, again
    and again until few values are left to be put in order.
    """
    long = unpivoted(df.filter(F.col(key).isNotNull()), key, metrics).filter("value IS NOT NULL")
    if approx:
        return long.groupBy(key, "metric").agg(
            F.percentile_approx("value", 0.5, _SKETCH).alias("median")
        )
    by = [key, "metric"]
    counted = long.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("_n"))
    near = materialize(
        counted.withColumns({"_below": F.lit(0).cast("bigint"), "_total": F.lit(None).cast("bigint")}),
        "median-values",
    )
    while True:
        groups = near.groupBy(*by)
        sizes = groups.agg(
            F.count(F.lit(1)).alias("_values"),
            F.coalesce(F.first("_total"), F.sum("_n")).alias("_total"),
        )
        sizes = materialize(sizes, "median-sizes")
        near = near.drop("_total").join(sizes, by)
        if (sizes.agg(F.max("_values")).first()[0] or 0) <= RANKED_VALUES:
            break
        edges = groups.agg(F.percentile_approx("value", _QUANTILES, _SKETCH).alias("_edges"))
        # an interval ends with its edge
        slot = F.size(F.filter("_edges", lambda e: e < F.col("value")))
        slots = near.join(materialize(edges, "median-edges"), by).withColumn("_slot", slot)
        rows = slots.groupBy(*by, "_slot").agg(
            F.sum("_n").alias("_rows"), F.first("_below").alias("_below"), F.first("_total").alias("_total")
        )
        upto = F.sum("_rows").over(Window.partitionBy(*by).orderBy("_slot")) + F.col("_below")
        before = upto - F.col("_rows")
        lower, upper = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
        middle = rows.select(*by, "_slot", upto.alias("_upto"), before.alias("_before"), lower.alias("_lower"), upper.alias("_upper"))
        middle = middle.filter((F.col("_upto") >= F.col("_lower")) & (F.col("_before") < F.col("_upper")))
        middle = middle.groupBy(*by).agg(
            F.min("_slot").alias("_from"), F.max("_slot").alias("_to"), F.min("_before").alias("_start")
        )
        near = materialize(
            slots.join(middle, by)
            .filter(F.col("_slot").between(F.col("_from"), F.col("_to")))
            .select(*by, "value", "_n", F.col("_start").alias("_below"), "_total"),
            "median-values",
        )
    in_order = Window.partitionBy(*by).orderBy("value")
    ranked = near.withColumn("_upto", F.sum("_n").over(in_order) + F.col("_below"))
    return ranked.groupBy(*by).agg(median_of_counts("value").alias("median"))


def median_of_counts(value: str) -> Column:
    """Median over rows that hold a value, the running count ``_upto`` and the number ``_total``."""
    lower = F.floor((F.col("_total") + 1) / 2)
    upper = F.floor(F.col("_total") / 2) + 1

    def at(rank: Column) -> Column:
        return F.min_by(F.col(value), F.when(F.col("_upto") >= rank, F.col("_upto")))

    return (at(lower) + at(upper)) / 2


def with_running_total(hist: DataFrame, value: str, weight: str) -> DataFrame:
    """Add ``_upto`` and ``_total`` to a table of values and how often each occurs.

    For tables that are small by nature, such as counts per key or words per text. Rows without a
    weight get no running count and so stay out of a median.
    """
    upto = F.sum(weight).over(Window.orderBy(value))
    return hist.withColumns(
        {
            "_upto": F.when(F.col(weight).isNotNull(), upto),
            "_total": F.sum(weight).over(Window.partitionBy()),
        }
    )


def count_histogram(per_key: DataFrame, count: str, flag: str | None = None) -> DataFrame:
    """How many keys have each count: ``count, keys``.

    With N rows there are at most sqrt(2 N) different counts, so this table is small enough for a
    window without partitions whatever the number of keys.
    """
    keys = [count] if flag is None else [count, flag]
    return per_key.groupBy(*keys).agg(F.count(F.lit(1)).alias("keys"))

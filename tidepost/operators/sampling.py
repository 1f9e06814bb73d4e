"""Splits and samples that depend on a key and a seed, not on the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepost.operators.ranking import row_hash, smallest_scores, top_n
from tidepost.session import materialize

# Digits of the digest by which rows are counted at once, and rows that are few enough to be ranked.
_DIGITS = 3
_RANKED = 100_000
_DIGEST = 32


def _digest(key: Column | str, seed: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.md5(F.concat(text, F.lit(f"|{seed}")))


def hash_unit(key: Column | str, seed: int = 42) -> Column:
    """Number in [0, 1) that is fixed by the key and the seed; null is a key like others."""
    first = F.conv(F.substring(_digest(key, seed), 1, 8), 16, 10).cast("bigint")
    return first / F.lit(float(1 << 32))


def split_by_hash(
    df: DataFrame, key: str, fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training and evaluation part; every label keeps about ``fraction``, without a shuffle."""
    unit = hash_unit(key, seed)
    return df.filter(unit < fraction), df.filter(unit >= fraction)


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    labels: Sequence[str],
    eval_fraction: float = 0.2,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Exact split, marked ``train`` or ``eval``; ``key`` must identify rows.

    The evaluation part has ``ceil(eval_fraction * rows)`` rows, shared out over the labels by
    largest remainder. Where a label is missing or has one row only, the split ignores labels.
    Rows with other labels are left out. A row's part depends on the digest of its key: digests are
    counted by their first digits, further digits only at the border (``_cuts``), and then compared
    with the border; digests are written for it while the frame is built.
    """
    rows = df.filter(F.col(label).isin(list(labels)))
    n = F.count(F.lit(1))
    per_label = rows.groupBy(F.col(label).alias("_label")).agg(n.alias("_n"))
    stratify = per_label.agg((F.count("_n") == len(labels)) & (F.min("_n") >= 2)).scalar()
    marked = rows.withColumns(
        {
            "_stratum": F.when(stratify, F.col(label)).otherwise(F.lit("")),
            "_order": _digest(key, seed),
        }
    )

    # At most len(labels) rows from here on.
    everything = Window.partitionBy()
    total = F.sum("_n").over(everything)
    quota = (total - F.ceil(total * eval_fraction)) * F.col("_n") / total
    shares = (
        marked.groupBy("_stratum")
        .agg(n.alias("_n"))
        .withColumns({"_total": total, "_quota": quota})
        .withColumn("_base", F.floor("_quota"))
    )
    left_over = (
        F.col("_total")
        - F.ceil(F.col("_total") * eval_fraction)
        - F.sum("_base").over(everything)
    )
    by_remainder = Window.orderBy((F.col("_quota") - F.col("_base")).desc(), F.col("_stratum"))
    shares = shares.withColumns(
        {"_left": left_over, "_turn": F.row_number().over(by_remainder)}
    ).select(
        "_stratum",
        (F.col("_base") + (F.col("_turn") <= F.col("_left")).cast("int")).alias("_train"),
    )

    keys = materialize(marked.select("_stratum", "_order"), "split-keys")
    placed = marked.join(F.broadcast(_borders(keys, shares)), "_stratum").withColumn(
        "_head", F.substring(F.col("_order"), F.lit(1), F.length("_digits"))
    )
    # rows with the border's digits are few; equal keys are told apart by the rest of their row
    turn = F.row_number().over(Window.partitionBy("_stratum").orderBy("_order", key, "_row"))
    near = placed.filter("_head = _digits").withColumn("_row", row_hash(df))
    parts = [
        (placed.filter("_head <> _digits"), F.col("_head") < F.col("_digits")),
        (near.withColumn("_turn", turn), F.col("_turn") <= F.col("_room")),
    ]
    marks = [
        part.select(*df.columns, F.when(train, "train").otherwise("eval").alias(name))
        for part, train in parts
    ]
    return marks[0].unionByName(marks[1])


def _borders(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """``_stratum, _digits, _room``: first digits of the digest of each stratum's last training row.

    ``rows`` has ``_stratum`` and ``_order`` (the digest), ``shares`` the number of training rows; ``_room`` of
    those with these digits are training rows. Rows are counted by their first digits, and only those
    at which the number is reached are counted by the next ones, until at most ``_RANKED`` rows have
    the digits. There is a row for each label.
    """
    border = shares.withColumnsRenamed({"_train": "_room"}).withColumn("_digits", F.lit(""))
    for digits in range(_DIGITS, _DIGEST + _DIGITS, _DIGITS):
        near = rows.join(F.broadcast(border), "_stratum").filter(
            F.startswith("_order", F.col("_digits"))
        )
        left = near.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_n"))
        if (left.agg(F.max("_n")).first()[0] or 0) <= _RANKED:
            break
        counts = near.groupBy(
            "_stratum", "_room", F.substring("_order", 1, digits).alias("_digits")
        ).agg(F.count(F.lit(1)).alias("_n"))
        # at most 4096 rows a stratum
        upto = F.sum("_n").over(Window.partitionBy("_stratum").orderBy("_digits"))
        room = F.col("_room") - upto + F.col("_n")
        reached = counts.withColumns({"_upto": upto, "_left": room})
        first = F.min(F.struct("_digits", F.col("_left").alias("_room"))).alias("_first")
        reached = reached.filter("_upto >= _room").groupBy("_stratum").agg(first)
        border = materialize(reached.select("_stratum", "_first.*"), "split-border")
    return border


def fixed_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by the hash of a key that identifies rows; fewer rows give them all."""
    near = smallest_scores(df, hash_unit(key, seed), n)
    return top_n(near, [_digest(key, seed).asc(), F.col(key).asc()], n)

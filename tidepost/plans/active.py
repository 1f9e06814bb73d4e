"""Active learning: candidates for review and the set assembled from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.operators.ranking import TOP_K_ROWS, most_uncertain, row_hash, top_n
from tidepost.operators.shape import align, drop_present, union_all
from tidepost.session import materialize


def select_candidates(
    scored: DataFrame,
    labelled_rows: int,
    target: int,
    ties: Sequence[str | Column],
    source: str = "al_prediction",
    strict: bool = False,
    written: bool = False,
    posts: DataFrame | None = None,
    key: str = "id",
    row: str | None = None,
) -> DataFrame:
    """The least certain rows of a scored pool that fill the labelled rows up to ``target``.

    None are needed when the baseline is large enough. An empty pool is an error, and with
    ``strict`` also one that is too small. The prediction becomes a weak label to be reviewed.
    This runs jobs while the frame is built: the ranking reads the scores more than once, so they
    are written first unless ``written`` says that the pool is a table already. With ``posts``, the
    table that was scored, only the scores, ``key`` and a hash of the row are written and ranked,
    and the other columns are fetched for the chosen rows by both. Keys may be null or repeated:
    rows that have the key and the hash in common are equal, so each chosen one gets that row once.
    ``row`` names a column of both that holds such a hash already, so that the scored pool needs no
    other column of ``posts``. Up to ``TOP_K_ROWS`` rows, those of ``posts`` are looked for by key first.
    """
    needed = max(0, target - labelled_rows)
    columns = scored.columns
    if posts is not None:
        shared = [c for c in posts.columns if c in columns]
        hashed = (F.col(row) if row else row_hash(posts.select(*shared))).alias("__row")
        scored = scored.select(key, *[c for c in columns if c not in shared], hashed)
        ties = [*ties, "__row"]
    if needed and not written:
        scored = materialize(scored, "scored-pool")
    if needed and scored.isEmpty():
        raise ValueError("the pool is empty")
    if strict:
        if not needed:
            raise ValueError("the labelled rows already reach the target")
        if scored.count() < needed:
            raise ValueError(f"the pool has fewer than the {needed} rows needed")
    ranked = (
        most_uncertain(scored, needed, "uncertainty_margin", "uncertainty_entropy", ties)
        if needed
        else scored.filter(F.lit(False))
    )
    if posts is not None:
        order = [F.asc_nulls_last("uncertainty_margin"), F.desc_nulls_last("uncertainty_entropy")]
        scores = F.struct(*[c for c in columns if c not in shared])
        chosen = ranked.groupBy(F.col(key).alias("__key"), F.col("__row").alias("__chosen")).agg(
            F.collect_list(scores).alias("__scores")
        )
        same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__row") == F.col("__chosen"))
        if 0 < needed <= TOP_K_ROWS:
            keys = ranked.agg(F.collect_set(key)).scalar()
            posts = posts.filter(F.coalesce(F.array_contains(keys, F.col(key)), F.lit(True)))
            chosen = F.broadcast(chosen)  # at most TOP_K_ROWS
        found = posts.select(*shared, hashed).join(chosen, same).dropDuplicates([key, "__row"])
        ranked = (
            found.select(*shared, "__row", F.explode("__scores").alias("__score"))
            .select(*shared, "__row", "__score.*")
            .orderBy(*order, *ties)
            .select(*columns)
        )
    return ranked.withColumns(
        {
            "sentiment": F.col("predicted_sentiment"),
            "label_source": F.lit(source),
            "review_required": F.lit(True),
        }
    )


def baseline_as_scored(
    baseline: DataFrame, labels: Sequence[str], probs: Sequence[str], label: str = "sentiment"
) -> DataFrame:
    """Labelled rows in the form of scored ones: certain, one-hot, without uncertainty."""
    return baseline.withColumns(
        {
            "predicted_sentiment": F.col(label),
            "model_confidence": F.lit(1.0),
            "uncertainty_margin": F.lit(None).cast("double"),
            "uncertainty_entropy": F.lit(None).cast("double"),
            **{
                p: F.when(F.col(label) == x, 1.0).otherwise(0.0)
                for x, p in zip(labels, probs, strict=True)
            },
        }
    )


def assemble(
    baseline: DataFrame, candidates: DataFrame, unused: Sequence[str] = ()
) -> DataFrame:
    """Both parts on their shared columns, without the unused ones, in the baseline's order."""
    left, right = align(drop_present(baseline, unused), drop_present(candidates, unused))
    return union_all([left, right])


def head_cut(
    df: DataFrame, priority: Column, order: Sequence[str | Column], target: int
) -> DataFrame:
    """The first ``target`` rows by priority, then ``order``; the rows come in any order."""
    return top_n(df, [priority.asc(), *order], target, in_order=False)


def summary(df: DataFrame, label: str, baseline: Column, review: str) -> DataFrame:
    """One row: labelled, selected and all rows, rows per label as JSON, rows to review."""
    n = F.count(F.lit(1))
    per_label = df.groupBy(label).agg(
        n.alias("rows"),
        F.count_if(baseline).alias("baseline_rows"),
        F.count_if(F.col(review)).alias("review_rows"),
    )
    entries = F.sort_array(F.collect_list(F.struct(F.col(label), F.col("rows"))))
    known = F.filter(entries, lambda e: e[label].isNotNull())
    return per_label.agg(
        F.coalesce(F.sum("baseline_rows"), F.lit(0)).alias("baseline_rows"),
        F.coalesce(F.sum(F.col("rows") - F.col("baseline_rows")), F.lit(0)).alias("selected_rows"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows"),
        F.to_json(F.map_from_entries(known)).alias("label_distribution"),
        F.coalesce(F.sum("review_rows"), F.lit(0)).alias("review_required_rows"),
    )

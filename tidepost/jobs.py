"""The stages as jobs: paths and parameters in, stage tables out, row counts returned.

``spark-submit tidepost/jobs.py JOB PARAMETERS`` runs one of ``JOBS``. PARAMETERS is a JSON file
with the function's arguments, in any file system that Spark reads. Each job reads what another
has written, so that any of them can be run again; its intermediate tables are removed at its end.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost.operators import classify, evaluate, shape, terms
from tidepost.operators.sampling import split_by_hash
from tidepost.plans import active, export, ingest, labelling, merge
from tidepost.session import build_session, scratch_scope
from tidepost.sources.files import (
    load_lookup,
    read_labelled_csv,
    read_posts_csv,
    read_stage,
    write_stage,
)


def _lookup(spark: SparkSession, dictionary: str | None) -> dict[str, str] | None:
    return None if dictionary is None else load_lookup(spark, dictionary)


def _scored(
    spark: SparkSession,
    posts: DataFrame,
    model: str,
    text: str,
    probs: Sequence[str],
    slots: int | None,
) -> DataFrame:
    """Probabilities by a fitted pipeline, or by a table of term weights with so many slots."""
    if slots is None:
        return classify.score(posts, classify.load_model(model), text, probs)
    return terms.score_terms(posts, read_stage(spark, model), text, probs, slots)


def clean(
    spark: SparkSession,
    sources: Sequence[str],
    target: str,
    keywords: Sequence[str],
    dictionary: str | None = None,
    optional: Sequence[str] = (),
    flags: Mapping[str, str] | None = None,
    order: Sequence[str] | None = None,
) -> dict[str, int]:
    """Scraped CSV files to cleaned posts; of copies the first in ``order`` stays, nulls last."""
    raw = read_posts_csv(spark, sources, optional=optional)
    ranked = [F.asc_nulls_last(c) for c in order or raw.columns]
    posts = ingest.clean_posts(raw, keywords, _lookup(spark, dictionary), flags, order=ranked)
    return {"posts": write_stage(posts, target)}


def separate(
    spark: SparkSession,
    posts: str,
    labelled: Sequence[str],
    baseline: str,
    pool: str,
    labels: Sequence[str],
    dictionary: str | None = None,
    order: Sequence[str] = ("id",),
) -> dict[str, int]:
    """Labelled CSV files to a baseline, and the posts that are not in it to a pool."""
    marked = read_labelled_csv(spark, labelled)
    known = labelling.labelled_baseline(marked, labels, order, lookup=_lookup(spark, dictionary))
    counts = {"baseline": write_stage(known, baseline)}
    with scratch_scope(spark):
        rest = labelling.unlabelled_pool(
            read_stage(spark, posts), read_stage(spark, baseline), order
        )
        return counts | {"pool": write_stage(rest, pool)}


def choose(
    spark: SparkSession,
    baseline: str,
    model: str,
    report: str,
    labels: Sequence[str],
    settings: Sequence[Mapping],
    text: str = "text_clean",
    label: str = "sentiment",
    key: str = "id",
) -> dict[str, int]:
    """The best of several term models on held-out rows, and the accuracy of each."""
    with scratch_scope(spark):
        known = read_stage(spark, baseline)
        best, table = terms.choose_model(known, text, label, labels, settings, key)
        return {"weights": write_stage(best, model), "settings": write_stage(table, report)}


def train(
    spark: SparkSession,
    baseline: str,
    model: str,
    report: str,
    labels: Sequence[str],
    probs: Sequence[str],
    text: str = "text_clean",
    label: str = "sentiment",
    key: str = "id",
    features: int = 1 << 16,
) -> dict[str, int]:
    """A classifier from the training part of the baseline, and its report on the other part."""
    with scratch_scope(spark):
        training, evaluation = split_by_hash(read_stage(spark, baseline), key)
        fitted = classify.train_text_classifier(training, text, label, labels, features)
        classify.save_model(fitted, model)
        scored = classify.with_uncertainty(
            classify.score(evaluation, fitted, text, probs), probs, labels
        )
        rows = evaluate.classification_report(scored, label, "predicted_sentiment", labels)
        return {"report": write_stage(rows, report)}


def select(
    spark: SparkSession,
    baseline: str,
    pool: str,
    model: str,
    target: str,
    rows: int,
    labels: Sequence[str],
    probs: Sequence[str],
    text: str = "text_clean",
    key: str = "id",
    slots: int | None = None,
) -> dict[str, int]:
    """The baseline, filled up to ``rows`` with the least certain posts of the pool.

    ``slots`` is given for a model that ``choose`` has written.
    """
    known, posts = read_stage(spark, baseline), read_stage(spark, pool)
    with scratch_scope(spark):
        scored = classify.with_uncertainty(
            _scored(spark, posts, model, text, probs, slots), probs, labels
        )
        chosen = active.select_candidates(
            scored, known.count(), rows, [key], posts=posts, key=key
        )
        whole = active.assemble(active.baseline_as_scored(known, labels, probs), chosen)
        return {"selected": write_stage(whole, target)}


def predict_irony(
    spark: SparkSession,
    posts: str,
    model: str,
    target: str,
    probs: Sequence[str] = ("p_plain", "p_ironic"),
    text: str = "text_clean",
    key: str = "id",
    slots: int | None = None,
) -> dict[str, int]:
    """Class and confidence of a two-class model for each post (``slots``: see ``select``)."""
    scored = _scored(spark, read_stage(spark, posts), model, text, probs, slots)
    return {"predictions": write_stage(classify.irony_predictions(scored, key, probs), target)}


def resolve(
    spark: SparkSession,
    posts: str,
    irony: str,
    target: str,
    flips: Sequence[str],
    to: str,
    key: str = "id",
) -> dict[str, int]:
    """Final sentiment from both predictions."""
    final = merge.merge_predictions(
        read_stage(spark, posts), read_stage(spark, irony), flips, to, key
    )
    return {"posts": write_stage(final, target)}


def load(
    spark: SparkSession,
    posts: str,
    target: str,
    fmt: str | None = None,
    copy: str | None = None,
    by_month: str | None = None,
) -> dict[str, int]:
    """The result table in a catalog or, with ``fmt``, at a path, and a CSV copy of it.

    With ``by_month``, the name of a time, it is stored by month at the path. Values that could not be
    cast are counted, by column.
    """
    final = read_stage(spark, posts)
    rows = export.export_results(final, target, fmt, copy, by_month=by_month)
    losses = export.export_losses(shape.project_map(final, export.EXPORT_COLUMNS)).filter("lost > 0")
    return {"results": rows} | {f"lost {r['column']}": r["lost"] for r in losses.collect()}


JOBS = {
    f.__name__: f
    for f in (clean, separate, choose, train, select, predict_irony, resolve, load)
}


def main(arguments: Sequence[str]) -> None:
    if len(arguments) != 2 or arguments[0] not in JOBS:
        raise SystemExit(f"usage: jobs.py {{{'|'.join(JOBS)}}} PARAMETERS")
    job, parameters = arguments
    spark = build_session(f"tidepost-{job}")
    text = spark.read.text(parameters, wholetext=True).first()
    print(json.dumps(JOBS[job](spark, **json.loads(text[0]))))


if __name__ == "__main__":
    main(sys.argv[1:])

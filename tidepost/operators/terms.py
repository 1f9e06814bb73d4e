"""Linear text models as tables: a weight for each hashed term and class, applied by expressions.

A model is a table ``slot, weights``: a row for each slot of terms, the slot -1 for what a text gets
without any term. Its size is bounded by the number of slots, so it is read as one value by a
scalar subquery and texts are scored where they are, without a join and without leaving
the JVM. Models are counted (naive Bayes) or fitted (logistic regression).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.functions.columns import encode_label
from tidepost.functions.scores import best_label, softmax
from tidepost.operators.evaluate import classification_report
from tidepost.operators.sampling import split_by_hash
from tidepost.operators.shape import compute_once
from tidepost.session import materialize

#: Slot of the weights that every text gets.
BASE = -1
MODEL = "slot int, weights array<double>"


def terms(text: Column | str) -> Column:
    """Lower-case words between blanks; a null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), " "), lambda t: t != "")


def slot_of(term: Column, slots: int) -> Column:
    """Slot of a term: the first 32 bits of its digest, modulo the number of slots."""
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint") % slots).cast("int")


def _slots(df: DataFrame, text: str, slots: int) -> Column:
    """Slots of a text's terms; a column of integers holds them already."""
    if dict(df.dtypes)[text] == "array<int>":
        return F.col(text)
    return F.transform(terms(text), lambda t: slot_of(t, slots))


def with_slots(df: DataFrame, text: str, slots: int = 1 << 16, name: str = "slots") -> DataFrame:
    """Add the slots of each text's terms, which models are learned from and texts are scored by.

    Where the same texts are for both, write them with their slots and name that column as the text:
    each term is hashed once then.
    """
    return compute_once(df, **{name: _slots(df, text, slots)})


def _labelled(df: DataFrame, text: str, label: str, labels: Sequence[str], slots: int) -> DataFrame:
    rows = df.select(
        encode_label(label, labels).alias("class"), _slots(df, text, slots).alias("slots")
    )
    return rows.filter(F.col("class") >= 0)


def count_model(
    df: DataFrame,
    text: str,
    label: str,
    labels: Sequence[str],
    slots: int = 1 << 16,
    smoothing: float = 1.0,
) -> DataFrame:
    """Naive Bayes: logarithms of smoothed shares of each class's terms, and of the classes' rows.

    Rows with other labels are left out. All figures are counts, added up where the texts are.
    """
    rows = materialize(_labelled(df, text, label, labels, slots), "term-slots")
    classes = range(len(labels))
    seen = rows.select("class", F.explode("slots").alias("slot"))
    counts = seen.groupBy("slot").agg(*[F.count_if(F.col("class") == k).alias(f"n{k}") for k in classes])
    # a slot that no text has gets its smoothed share too
    every = df.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    filled = every.join(counts, "slot", "left").fillna(0)
    totals = materialize(
        counts.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"t{k}") for k in classes]), "term-totals"
    ).first()
    share = [
        F.log((F.col(f"n{k}") + smoothing) / F.lit(totals[f"t{k}"] + smoothing * slots))
        for k in classes
    ]
    sizes = [F.count_if(F.col("class") == k) for k in classes]
    rows_of_all = sum((F.col(f"n{k}") for k in classes), F.lit(0))
    base = rows.agg(*[s.alias(f"n{k}") for k, s in enumerate(sizes)]).select(
        F.lit(BASE).alias("slot"),
        F.array(
            *[
                F.log((F.col(f"n{k}") + smoothing) / (rows_of_all + smoothing * len(labels)))
                for k in classes
            ]
        ).alias("weights"),
    )
    return filled.select("slot", F.array(*share).alias("weights")).unionByName(base)


def fitted_model(
    df: DataFrame,
    text: str,
    label: str,
    labels: Sequence[str],
    slots: int = 1 << 16,
    regularization: float = 0.01,
    iterations: int = 30,
) -> DataFrame:
    """Multinomial logistic regression on term counts weighted by how few texts have the term."""
    rows = _labelled(df, text, label, labels, slots).select(
        F.col("class").cast("double").alias("class"), F.col("slots").cast("array<string>").alias("slots")
    )
    counter = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(slots)], inputCol="slots", outputCol="counts"
    )
    counted = materialize(counter.transform(rows).select("class", "counts"), "term-counts")
    weighting = IDF(inputCol="counts", outputCol="features").fit(counted)
    fit = LogisticRegression(
        labelCol="class", family="multinomial", maxIter=iterations, tol=1e-4, regParam=regularization
    ).fit(weighting.transform(counted))
    weights = fit.coefficientMatrix.toArray() * weighting.idf.toArray()
    table = [(BASE, [float(v) for v in fit.interceptVector])]
    table += [(i, w) for i, w in enumerate(weights.T.tolist()) if any(w)]
    return df.sparkSession.createDataFrame(table, MODEL)


def weights_by_slot(model: DataFrame, slots: int) -> Column:
    """A model as one value, an array of weights: those of ``BASE``, then those of each slot or null."""
    every = model.sparkSession.range(-1, slots).select(F.col("id").cast("int").alias("slot"))
    rows = F.collect_list(F.struct("slot", "weights"))
    ordered = F.array_sort(rows, lambda a, b: a.slot - b.slot)
    return every.join(model, "slot", "left").agg(F.transform(ordered, lambda r: r.weights)).scalar()


def score_terms(
    df: DataFrame, model: DataFrame, text: str, names: Sequence[str], slots: int = 1 << 16
) -> DataFrame:
    """Add a probability column for each class, in class order; a null text is scored as ''."""
    classes = range(len(names))
    nothing = F.array(*[F.lit(0.0) for _ in classes])

    def added(sums: Column, place: Column) -> Column:
        weights = F.coalesce(F.get(F.col("_weights"), place), nothing)
        return F.zip_with(sums, weights, lambda a, b: a + b)

    # the first place of the weights is what every text gets
    totals = F.aggregate("_slots", added(nothing, F.lit(0)), lambda s, i: added(s, i + 1))
    placed = compute_once(df, _slots=_slots(df, text, slots)).withColumn(
        "_weights", weights_by_slot(model, slots)
    )
    scored = placed.select(*df.columns, totals.alias("_logits"))
    probs = softmax([F.col("_logits")[k] for k in classes])
    return scored.select(*df.columns, *[p.alias(n) for p, n in zip(probs, names, strict=True)])


def accuracy(scored: DataFrame, label: str, predicted: str, labels: Sequence[str]) -> float:
    """Share of right predictions, from the classification report."""
    report = classification_report(scored, label, predicted, labels)
    row = report.filter(F.col("label") == "accuracy").select("precision").first()
    return row[0] if row and row[0] is not None else 0.0


def choose_model(
    df: DataFrame,
    text: str,
    label: str,
    labels: Sequence[str],
    settings: Sequence[Mapping],
    key: str = "id",
    fraction: float = 0.8,
    parallel: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """The model with the best accuracy on held-out rows, and a table of all settings.

    A setting names a ``kind`` (``count`` or ``fit``) and the arguments of ``count_model`` or
    ``fitted_model``. Every setting is learned from the same ``fraction`` of the rows, chosen by the
    hash of ``key``, and judged on the others; several at a time, as the jobs of one don't fill a
    cluster. Of equally good ones the first counts. The table has ``setting`` (its place), ``parameters``,
    ``accuracy`` and ``chosen``.
    """
    known = df.filter(F.col(label).isin(list(labels)))
    training, rest = split_by_hash(known, key, fraction)
    training = materialize(training.select(text, label), "training")
    rest = materialize(rest.select(text, label), "held-out")
    names = [f"_p{k}" for k in range(len(labels))]

    def learn(setting: Mapping) -> tuple[DataFrame, float]:
        options = {k: v for k, v in setting.items() if k != "kind"}
        build = {"count": count_model, "fit": fitted_model}[setting["kind"]]
        model = materialize(build(training, text, label, labels, **options), "term-model")
        slots = {"slots": options["slots"]} if "slots" in options else {}
        scored = score_terms(rest, model, text, names, **slots)
        scored = scored.withColumn("_predicted", best_label(names, labels))
        return model, accuracy(scored, label, "_predicted", labels)

    # each thread works in a copy of this context, so that its tables belong to the same scratch scope
    contexts = [copy_context() for _ in settings]
    with ThreadPoolExecutor(parallel) as pool:
        learned = list(pool.map(lambda context, s: context.run(learn, s), contexts, settings))
    best = max(range(len(learned)), key=lambda i: (learned[i][1], -i))
    rows = [
        (i, ", ".join(f"{k}={v}" for k, v in s.items()), a, i == best)
        for i, (s, (_, a)) in enumerate(zip(settings, learned, strict=True))
    ]
    schema = "setting int, parameters string, accuracy double, chosen boolean"
    return learned[best][0], df.sparkSession.createDataFrame(rows, schema)

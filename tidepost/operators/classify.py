"""Training and scoring of text classifiers on the executors.

Training fits a Spark ML pipeline (hashed term weights, multinomial logistic regression); only
the coefficients reach the driver, and their number is set by ``features``. Any Python model can
score instead: it is loaded once per task and sees one Arrow batch of whole texts at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.functions.columns import encode_label
from tidepost.functions.scores import (
    best_label,
    confidence,
    entropy,
    margin,
    softmax,
)
from tidepost.session import materialize

_TEXT, _LABEL = "_text", "_label"


def train_text_classifier(
    df: DataFrame,
    text: str,
    label: str,
    labels: Sequence[str],
    features: int = 1 << 16,
    iterations: int = 30,
    regularization: float = 0.01,
) -> PipelineModel:
    """Fit a classifier whose class i is ``labels[i]``; rows with other labels are left out.

    The term counts are written once, because fitting reads them again and again.
    """
    rows = df.select(
        F.coalesce(text, F.lit("")).alias(_TEXT),
        encode_label(label, labels).cast("double").alias(_LABEL),
    ).filter(F.col(_LABEL) >= 0)
    tokenizer = RegexTokenizer(inputCol=_TEXT, outputCol="_tokens", pattern=r"\s+")
    hashing = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features)
    counted = hashing.transform(tokenizer.transform(rows)).select(_LABEL, "_tf")
    counted = materialize(counted, "term-counts")
    weights = IDF(inputCol="_tf", outputCol="_weights").fit(counted)
    classes = LogisticRegression(
        featuresCol="_weights",
        labelCol=_LABEL,
        predictionCol="_class",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        family="multinomial",
        maxIter=iterations,
        tol=1e-4,
        regParam=regularization,
    ).fit(weights.transform(counted))
    return PipelineModel(stages=[tokenizer, hashing, weights, classes])


def save_model(model: PipelineModel, path: str) -> str:
    """Write the model, replacing an earlier one at the path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel, text: str, names: Sequence[str]) -> DataFrame:
    """Add one probability column per class, in class order; null text is scored as ''."""
    scored = model.transform(df.withColumn(_TEXT, F.coalesce(text, F.lit(""))))
    probs = vector_to_array("_probability")
    return scored.select(*df.columns, *[probs[i].alias(n) for i, n in enumerate(names)])


def score_with_python(
    df: DataFrame,
    load: Callable[[], Callable[[Sequence[str]], np.ndarray]],
    text: str,
    names: Sequence[str],
    batch: int = 32,
) -> DataFrame:
    """Add probability columns from a Python model.

    ``load()`` runs once per task and returns a function from a list of texts to logits with one
    column per class. Only the text column crosses to Python; the softmax stays in the JVM.
    """

    @F.pandas_udf("array<double>")
    def logits(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for texts in parts:
            rows: list[np.ndarray] = []
            values = texts.tolist()
            for start in range(0, len(values), batch):
                rows.extend(np.asarray(predict(values[start : start + batch]), dtype=float))
            yield pd.Series(rows, index=texts.index, dtype=object)

    scored = df.withColumn("_logits", logits(F.coalesce(text, F.lit(""))))
    probs = softmax([F.col("_logits")[i] for i in range(len(names))])
    return scored.select(*df.columns, *[p.alias(n) for p, n in zip(probs, names, strict=True)])


def with_uncertainty(df: DataFrame, probs: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Add prediction, confidence, margin and entropy from the probability columns."""
    return df.withColumns(
        {
            "predicted_sentiment": best_label(probs, labels),
            "model_confidence": confidence(probs),
            "uncertainty_margin": margin(probs),
            "uncertainty_entropy": entropy(probs),
        }
    )


def irony_predictions(df: DataFrame, key: str, probs: Sequence[str]) -> DataFrame:
    """Key, class (position of the largest probability) and its probability."""
    return df.select(
        F.col(key).cast("string").alias(key),
        best_label(probs, list(range(len(probs)))).cast("int").alias("sarcasm_label"),
        confidence(probs).alias("sarcasm_confidence"),
    )

"""Classification quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.operators.shape import rows_of


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def classification_report(
    df: DataFrame, truth: str, predicted: str, labels: Sequence[str]
) -> DataFrame:
    """Precision, recall, F1 and support per label, accuracy, macro and weighted means.

    One aggregation to one row of counts; a division by zero gives 0.
    """
    y, p = F.col(truth), F.col(predicted)
    counts = [F.count_if(y == p).alias("_right"), F.count(F.lit(1)).alias("_rows")]
    for i, x in enumerate(labels):
        counts += [
            F.count_if((y == x) & (p == x)).alias(f"_hit{i}"),
            F.count_if(p == x).alias(f"_said{i}"),
            F.count_if(y == x).alias(f"_is{i}"),
        ]
    scores = {}
    for i in range(len(labels)):
        hit, said, is_ = F.col(f"_hit{i}"), F.col(f"_said{i}"), F.col(f"_is{i}")
        scores[f"_p{i}"] = _ratio(hit, said)
        scores[f"_r{i}"] = _ratio(hit, is_)
        scores[f"_f{i}"] = _ratio(hit * 2, said + is_)
    one = df.agg(*counts).withColumns(scores)

    def total(columns: list[Column]) -> Column:
        return sum(columns[1:], columns[0])

    n = len(labels)
    support = total([F.col(f"_is{i}") for i in range(n)])

    def macro(kind: str) -> Column:
        return total([F.col(f"_{kind}{i}") for i in range(n)]) / n

    def weighted(kind: str) -> Column:
        return _ratio(total([F.col(f"_{kind}{i}") * F.col(f"_is{i}") for i in range(n)]), support)

    def row(name: str, p: Column, r: Column, f: Column, s: Column) -> dict[str, Column]:
        return {"label": F.lit(name), "precision": p, "recall": r, "f1": f, "support": s}

    accuracy = _ratio(F.col("_right"), F.col("_rows"))
    rows = [
        row(x, F.col(f"_p{i}"), F.col(f"_r{i}"), F.col(f"_f{i}"), F.col(f"_is{i}"))
        for i, x in enumerate(labels)
    ]
    rows.append(row("accuracy", accuracy, accuracy, accuracy, F.col("_rows")))
    rows.append(row("macro avg", macro("p"), macro("r"), macro("f"), support))
    rows.append(row("weighted avg", weighted("p"), weighted("r"), weighted("f"), support))
    return rows_of(one, rows)

"""Class probabilities and what active learning derives from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepost import fixed


def _cols(columns: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def softmax(logits: Sequence[Column | str]) -> list[Column]:
    """Probabilities from logits; the largest logit is taken off before ``exp``."""
    cols = [c.cast("double") for c in _cols(logits)]
    top = F.greatest(*cols)
    powers = [F.exp(c - top) for c in cols]
    total = sum(powers[1:], powers[0])
    return [p / total for p in powers]


def best_label(probs: Sequence[Column | str], labels: Sequence) -> Column:
    """Label of the largest probability; the earlier label wins a tie."""
    cols = _cols(probs)
    top = F.greatest(*cols)
    chain = F.when(cols[0] == top, F.lit(labels[0]))
    for c, label in zip(cols[1:], labels[1:], strict=True):
        chain = chain.when(c == top, F.lit(label))
    return chain


def confidence(probs: Sequence[Column | str]) -> Column:
    return F.greatest(*_cols(probs))


def margin(probs: Sequence[Column | str]) -> Column:
    """Distance between the two largest probabilities."""
    ranked = F.sort_array(F.array(*_cols(probs)), asc=False)
    return ranked[0] - ranked[1]


def entropy(probs: Sequence[Column | str]) -> Column:
    """Entropy with the natural logarithm, safe at zero."""
    terms = [c * F.log(c + F.lit(fixed.ENTROPY_EPSILON)) for c in _cols(probs)]
    return -sum(terms[1:], terms[0])

"""Term models as tables: counts, fits, scores and the choice among settings."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from tidepost.operators import terms
from tidepost.operators.sampling import split_by_hash
from tidepost.session import materialize, scratch_scope

LABELS = ["no", "maybe", "yes"]
GOOD, BAD = "great lovely happy sunny win", "awful broken sad angry fail"


@pytest.fixture(scope="module")
def known(spark):
    rows = [(i, f"{GOOD if i % 2 else BAD} Word{i % 7}  x{i}", "yes" if i % 2 else "no") for i in range(200)]
    rows += [(300, "", "maybe"), (301, None, "yes"), (302, "what", "other"), (303, "it may be", "maybe")]
    return spark.createDataFrame(rows, "id int, text string, label string")


def slots_of(text, slots):
    return [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % slots for w in (text or "").lower().split(" ") if w]


@pytest.mark.parametrize("smoothing", [1.0, 0.1])
def test_counted_model_and_scores(known, smoothing):
    slots = 64
    rows = [r for r in known.collect() if r["label"] in LABELS]
    seen = {x: Counter(s for r in rows if r["label"] == x for s in slots_of(r["text"], slots)) for x in LABELS}
    texts = Counter(r["label"] for r in rows)

    def logit(text, x):
        total = sum(seen[x].values()) + smoothing * slots
        base = math.log((texts[x] + smoothing) / (len(rows) + 3 * smoothing))
        return base + sum(math.log((seen[x][s] + smoothing) / total) for s in slots_of(text, slots))

    model = terms.count_model(known, "text", "label", LABELS, slots, smoothing)
    assert model.count() == slots + 1
    scored = terms.score_terms(known, model, "text", ["a", "b", "c"], slots)
    assert scored.columns == [*known.columns, "a", "b", "c"]
    for r in scored.collect():
        logits = np.array([logit(r["text"], x) for x in LABELS])
        wanted = np.exp(logits - logits.max())
        assert np.allclose([r["a"], r["b"], r["c"]], wanted / wanted.sum(), atol=1e-9)


def test_fitted_model_is_scored_as_it_was_fitted(known):
    """The table gives the probabilities of the regression whose weights it holds."""
    slots = 256
    model = terms.fitted_model(known, "text", "label", ["no", "yes"], slots)
    weights = {r["slot"]: r["weights"] for r in model.collect()}
    scored = terms.score_terms(known, model, "text", ["a", "b"], slots)
    right = 0
    for r in scored.collect():
        logits = np.array(weights[terms.BASE])
        for s in slots_of(r["text"], slots):
            logits = logits + np.array(weights.get(s, [0.0, 0.0]))
        wanted = np.exp(logits - logits.max())
        assert np.allclose([r["a"], r["b"]], wanted / wanted.sum(), atol=1e-9)
        right += r["label"] == ("no" if r["a"] > r["b"] else "yes")
    assert right >= 198


def test_scoring_needs_no_shuffle_and_no_python(spark, known):
    model = terms.count_model(known, "text", "label", LABELS, 64)
    posts = spark.range(100).select(F.concat(F.lit("happy "), "id").alias("text"))
    plan = terms.score_terms(posts, model, "text", ["a", "b", "c"], 64)._jdf.queryExecution()
    outer = plan.executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in outer and "Python" not in outer and "UDF" not in outer


def test_choice_of_a_model(known):
    settings = [
        {"kind": "count", "slots": 2},
        {"kind": "count", "slots": 512, "smoothing": 0.5},
        {"kind": "fit", "slots": 512, "regularization": 0.01},
    ]
    best, table = terms.choose_model(known, "text", "label", LABELS, settings)
    rows = table.orderBy("setting").collect()
    assert [r["parameters"] for r in rows][1] == "kind=count, slots=512, smoothing=0.5"
    assert sum(r["chosen"] for r in rows) == 1
    (chosen,) = [r for r in rows if r["chosen"]]
    assert chosen["accuracy"] == max(r["accuracy"] for r in rows) > 0.9
    assert chosen["setting"] == min(r["setting"] for r in rows if r["accuracy"] == chosen["accuracy"])
    held_out = split_by_hash(known.filter(F.col("label").isin(LABELS)), "id")[1]
    scored = terms.score_terms(held_out, best, "text", ["no", "maybe", "yes"], 512).collect()
    right = sum(max(LABELS, key=lambda x: r[x]) == r["label"] for r in scored)
    assert right / len(scored) == pytest.approx(chosen["accuracy"])


def test_model_of_no_rows(known):
    model = terms.count_model(known.filter("id < 0"), "text", "label", LABELS, 16)
    scored = terms.score_terms(known, model, "text", ["a", "b", "c"], 16).first()
    assert [scored[c] for c in "abc"] == pytest.approx([1 / 3] * 3)


def test_slots_stand_for_texts(spark, known):
    """Learning from written slots and scoring by them is the same as by the texts."""
    slots = 64
    marked = materialize(terms.with_slots(known, "text", slots, "places").drop("text"), "slots")
    for build in (terms.count_model, terms.fitted_model):
        model = materialize(build(known, "text", "label", LABELS, slots=slots), "model")
        again = build(marked, "places", "label", LABELS, slots=slots)
        weights = lambda m: {r["slot"]: r["weights"] for r in m.collect()}
        first, second = weights(model), weights(again)
        assert first.keys() == second.keys()
        assert all(second[k] == pytest.approx(first[k], abs=1e-9) for k in first)
        by_text = terms.score_terms(known, model, "text", ["a", "b", "c"], slots).drop("text")
        by_slots = terms.score_terms(marked, model, "places", ["a", "b", "c"], slots).drop("places")
        assert sorted(map(tuple, by_text.collect())) == sorted(map(tuple, by_slots.collect()))


def test_irony_model_hashes_terms_once(spark, monkeypatch):
    hashed = []
    monkeypatch.setattr(terms, "slot_of", lambda t, n, f=terms.slot_of: hashed.append(n) or f(t, n))
    with scratch_scope(spark):
        assert QUERIES["l7_irony_model"](spark, "/root/testdata/sf0.001").first()["learned"]
    assert len(hashed) == 1

"""Classifiers trained and applied on the executors."""

import numpy as np
from pyspark.sql import functions as F

from checks import sql as q
from checks.queries.jobs import baseline_of
from checks.registry import query
from checks.views import LABELS, PROBS
from tidepost.functions.text import clean_text
from tidepost.operators.classify import (
    irony_predictions,
    load_model,
    save_model,
    score,
    score_with_python,
    train_text_classifier,
    with_uncertainty,
)
from tidepost.operators.evaluate import classification_report
from tidepost.operators.sampling import split_by_hash
from tidepost.operators.terms import (
    choose_model,
    count_model,
    fitted_model,
    score_terms,
    with_slots,
)
from tidepost.plans.labelling import valid_labels
from tidepost.session import materialize, scratch_path

_SCORED_SQL = """SELECT count(*) AS rows, count(*) AS sums_to_one, count(*) AS labelled
    FROM posts"""


def _checked(scored, probs):
    total = sum((F.col(p) for p in probs[1:]), F.col(probs[0]))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        F.count("predicted_sentiment").alias("labelled"),
    )


_THE, _DE = " the ", " de "
_BY_TEXT_SQL = f"""CASE WHEN contains(lower(text), '{_THE}') THEN 'positive'
    WHEN contains(lower(text), '{_DE}') THEN 'negative' ELSE 'neutral' END"""


def _marked(v):
    """Posts with a sentiment that is a function of the text, so that it can be learned."""
    low = F.lower("text")
    label = (
        F.when(F.contains(low, F.lit(_THE)), "positive")
        .when(F.contains(low, F.lit(_DE)), "negative")
        .otherwise("neutral")
    )
    return v.posts.select("id", "text", label.alias("sentiment"))


def _learned(report):
    """Whether the accuracy on held-out rows is above the share of the largest class."""
    largest = F.max(F.when(F.col("label").isin(LABELS), F.col("support")))
    whole = F.col("label") == "accuracy"
    accuracy, rows = (F.max(F.when(whole, F.col(c))) for c in ("precision", "support"))
    return report.agg(accuracy > largest / rows).scalar()


@query(
    "l3_train_report",
    f"SELECT {_BY_TEXT_SQL} AS sentiment, count(*) AS rows, true AS learned FROM posts GROUP BY 1",
    "posts",
)
def l3(v):
    marked = _marked(v)
    train, evaluation = split_by_hash(marked, "id")
    model = train_text_classifier(train, "text", "sentiment", LABELS)
    scored = with_uncertainty(score(evaluation, model, "text", PROBS), PROBS, LABELS)
    report = classification_report(scored, "sentiment", "predicted_sentiment", LABELS)
    counts = marked.groupBy("sentiment").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("learned", _learned(report))


@query("l4_score", _SCORED_SQL, "posts")
def l4(v):
    model = train_text_classifier(baseline_of(v), "text_clean", "sentiment", LABELS)
    model = load_model(save_model(model, scratch_path(v.spark, "model")))
    posts = v.posts.withColumn("text_clean", clean_text("text"))
    return _checked(with_uncertainty(score(posts, model, "text_clean", PROBS), PROBS, LABELS), PROBS)


_EXPS = ["exp(x)", "exp(1 - x)", "exp(0.5::DOUBLE)"]


@query(
    "l4_score_with_python",
    f"""SELECT id, {', '.join(
        f"{q.r(f'{e} / ({" + ".join(_EXPS)})')} AS {p}" for e, p in zip(_EXPS, PROBS, strict=True)
    )} FROM (SELECT id, coalesce(length(text), 0) % 1000 / 1000::DOUBLE AS x FROM posts)""",
    "posts",
)
def l4_python(v):
    def load():
        """Stand-in for a Python model: logits from the length of the text."""

        def predict(texts):
            x = np.array([len(t) % 1000 for t in texts], dtype=float) / 1000
            return np.stack([x, 1 - x, np.full(len(texts), 0.5)], axis=1)

        return predict

    return score_with_python(v.posts, load, "text", PROBS).select("id", *PROBS)


def _bayes_sql(slots: int, smoothing: float, known: str, asked: str) -> str:
    """Statements for the logits of naive Bayes: ``id, label, place, logit`` of the rows of ``asked``."""
    terms = "list_filter(string_split(lower(coalesce(text, '')), ' '), lambda t: t <> '')"
    slot = f"('0x' || substr(md5(t), 1, 8))::BIGINT % {slots}"
    labels = ", ".join(f"({i}, '{x}')" for i, x in enumerate(LABELS))
    return f"""classes(place, label) AS (VALUES {labels}),
      seen AS (SELECT sentiment, {slot} AS slot FROM (SELECT sentiment, unnest({terms}) AS t FROM {known})),
      counted AS (SELECT slot, sentiment, count(*) AS n FROM seen GROUP BY ALL),
      sizes AS (SELECT place, label, (SELECT count(*) FROM seen WHERE sentiment = label) AS terms,
          (SELECT count(*) FROM {known} k WHERE k.sentiment = label) AS texts FROM classes),
      used AS (SELECT id, slot, count(*) AS times
        FROM (SELECT id, {slot} AS slot FROM (SELECT id, unnest({terms}) AS t FROM {asked})) GROUP BY ALL),
      logits AS (
        SELECT a.id, s.label, s.place,
          any_value(ln((s.texts + {smoothing}) / ((SELECT count(*) FROM {known}) + 3 * {smoothing})))
          + coalesce(sum(u.times * ln((coalesce(c.n, 0) + {smoothing}) / (s.terms + {smoothing * slots}))), 0)
            AS logit
        FROM {asked} a CROSS JOIN sizes s LEFT JOIN used u ON u.id = a.id
          LEFT JOIN counted c ON c.slot = u.slot AND c.sentiment = s.label
        GROUP BY a.id, s.label, s.place)"""


_POWER = "exp(max(logit) FILTER (label = '{}') - max(logit))"
_POWERS = [_POWER.format(x) for x in LABELS]


@query(
    "l4_term_scores",
    f"""WITH {_bayes_sql(4096, 1.0, 'valid', 'posts')}
        SELECT id, {', '.join(
            f"{q.r(f'{e} / ({" + ".join(_POWERS)})')} AS {p}" for e, p in zip(_POWERS, PROBS, strict=True)
        )} FROM logits GROUP BY id""",
    "valid",
)
def l4_terms(v):
    """Every probability of a model that is a table of weights."""
    known = valid_labels(v.labelled_raw, "sentiment", "text", LABELS)
    model = materialize(count_model(known, "text", "sentiment", LABELS, slots=4096), "weights")
    posts = v.posts.select("id", "text")
    return score_terms(posts, model, "text", PROBS, slots=4096).select("id", *PROBS)


_SMOOTHING = [0.01, 1.0, 100.0]


def _accuracy_sql(smoothing: float) -> str:
    part = f"{q.unit('id')} < 0.8"
    best = "row_number() OVER (PARTITION BY id ORDER BY logit DESC, place)"
    return f"""(WITH known AS (SELECT * FROM valid WHERE {part}),
        asked AS (SELECT * FROM valid WHERE NOT ({part})),
        {_bayes_sql(1024, smoothing, 'known', 'asked')}
      SELECT coalesce(avg((l.label = a.sentiment)::INT), 0)
      FROM (SELECT * FROM logits QUALIFY {best} = 1) l JOIN asked a ON a.id = l.id)"""


@query(
    "l3_model_choice",
    f"""WITH found AS ({' UNION ALL '.join(
        f"SELECT {i} AS setting, 'slots=1024, smoothing={x}' AS parameters, {_accuracy_sql(x)} AS accuracy"
        for i, x in enumerate(_SMOOTHING)
    )})
    SELECT setting, parameters, {q.r('accuracy')} AS accuracy,
      row_number() OVER (ORDER BY accuracy DESC, setting) = 1 AS chosen FROM found""",
    "valid",
)
def l3_choice(v):
    known = valid_labels(v.labelled_raw, "sentiment", "text", LABELS)
    settings = [{"kind": "count", "slots": 1024, "smoothing": x} for x in _SMOOTHING]
    _, table = choose_model(known, "text", "sentiment", LABELS, settings)
    kind = F.regexp_replace("parameters", "^kind=count, ", "")
    return table.withColumn("parameters", kind)


@query(
    "l7_irony_model",
    f"""SELECT count(*) AS rows, count(DISTINCT id) AS ids,
          count(*) FILTER (contains(lower(text), '{_THE}')) AS ironic, true AS sure, true AS learned
        FROM posts""",
    "posts",
)
def l7_model(v):
    classes, probs, slots = ["plain", "ironic"], ["p0", "p1"], 1 << 12
    ironic = F.contains(F.lower("text"), F.lit(_THE))
    posts = v.posts.select("id", "text", ironic.cast("int").alias("truth"))
    # read once; learned from and scored by the same slots
    marked = materialize(with_slots(posts, "text", slots).drop("text"), "term-slots")
    marked = marked.withColumn("irony", F.when(F.col("truth") == 1, "ironic").otherwise("plain"))
    train, _ = split_by_hash(marked, "id")
    model = materialize(fitted_model(train, "slots", "irony", classes, slots=slots), "weights")
    scored = score_terms(marked, model, "slots", probs, slots)
    predicted = irony_predictions(scored, "id", probs)
    truth = marked.select(F.col("id").cast("string").alias("id"), "truth")
    checked = materialize(predicted.join(truth, "id"), "irony")
    rows, positive = F.count(F.lit(1)), F.sum("truth")
    held_out = split_by_hash(checked, "id")[1].agg(
        (F.count_if(F.col("truth") == F.col("sarcasm_label")) > F.greatest(positive, rows - positive))
    )
    return checked.agg(
        rows.alias("rows"),
        F.count_distinct("id").alias("ids"),
        positive.alias("ironic"),
        F.every(F.col("sarcasm_confidence").between(0.5, 1)).alias("sure"),
    ).withColumn("learned", F.lit(held_out.first()[0]))

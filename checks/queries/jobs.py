"""Composed jobs: baseline, pool, active-learning set, final merge, export."""

from pyspark.sql import functions as F

from checks import sql as q
from checks.queries.sets import POOL
from checks.registry import query
from checks.views import FLIP_TO, FLIPS, LABELS, PROBS
from tidepost.functions.scores import softmax
from tidepost.functions.text import clean_text
from tidepost.operators.classify import irony_predictions, with_uncertainty
from tidepost.operators.ranking import row_hash
from tidepost.plans.active import assemble, baseline_as_scored, select_candidates
from tidepost.plans.export import ExportTypes, export_results
from tidepost.plans.labelling import labelled_baseline, unlabelled_pool
from tidepost.plans.merge import merge_predictions
from tidepost.session import materialize, scratch_path
from tidepost.sources.files import read_posts_csv

_BASELINE = f"""SELECT id, url, text, sentiment, CASE sentiment WHEN 'negative' THEN 0
      WHEN 'neutral' THEN 1 ELSE 2 END AS label_id, {q.clean('text')} AS text_clean,
      'baseline_manual' AS label_source, false AS review_required
    FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY id) AS rn FROM valid)
    WHERE rn = 1"""


def baseline_of(v):
    return labelled_baseline(v.labelled_raw, LABELS, ["id"])


@query(
    "l1_labelled_baseline",
    f"""SELECT id, sentiment, label_id, text_clean, label_source, review_required
        FROM ({_BASELINE})""",
    "valid",
)
def l1(v):
    return baseline_of(v).select(
        "id", "sentiment", "label_id", "text_clean", "label_source", "review_required"
    )


@query(
    "l2_unlabelled_pool",
    f"SELECT id, 'unlabeled' AS label_source, true AS review_required FROM ({POOL})",
    "valid",
)
def l2(v):
    posts = v.posts.withColumn("text_clean", clean_text("text"))
    pool = unlabelled_pool(posts, baseline_of(v), ["id"])
    return pool.select("id", "label_source", "review_required")


@query(
    "l5_uncertainty",
    f"""SELECT id, predicted_sentiment, {q.r('model_confidence')} AS model_confidence,
          {q.r('uncertainty_margin')} AS uncertainty_margin,
          {q.r('uncertainty_entropy')} AS uncertainty_entropy FROM uncertain""",
    "uncertain",
)
def l5(v):
    return with_uncertainty(v.scored_posts, PROBS, LABELS).select(
        "id",
        "predicted_sentiment",
        "model_confidence",
        "uncertainty_margin",
        "uncertainty_entropy",
    )


@query(
    "l6_softmax",
    f"""SELECT vec_id, {', '.join(f"{q.r(p)} AS {p}" for p in PROBS)} FROM scored""",
    "scored",
)
def l6(v):
    logits = [F.col("embedding")[i] * F.lit(10.0) for i in range(3)]
    names = [p.alias(n) for p, n in zip(softmax(logits), PROBS, strict=True)]
    return v.table("embeddings").select("vec_id", *names)


@query(
    "l7_irony_predictions",
    f"""SELECT id::VARCHAR AS id, sarcasm_label, {q.r('sarcasm_confidence')} AS sarcasm_confidence
        FROM irony""",
    "irony",
)
def l7(v):
    logits = [F.lit(0.0), F.col("embedding")[3].cast("double") * 10]
    plain, ironic = softmax(logits)
    rows = v.table("embeddings").select(
        F.col("vec_id").alias("id"), plain.alias("p0"), ironic.alias("p1")
    )
    return irony_predictions(rows, "id", ["p0", "p1"])


_POOL_IDS = POOL.replace("SELECT id, url, text_clean FROM", "SELECT id FROM", 1)
_CANDIDATES = f"""SELECT u.* FROM uncertain u JOIN ({_POOL_IDS}) p ON p.id = u.id
    ORDER BY u.uncertainty_margin, u.uncertainty_entropy DESC, u.id LIMIT 100"""


def candidates_of(v, baseline):
    """Candidates beside a written baseline; the pool is ranked by scores and hashes of its rows."""
    row = row_hash(v.posts).alias("_row")
    cleaned = clean_text("text").alias("text_clean")
    pool = unlabelled_pool(v.scored_posts.select("*", row, cleaned), baseline, ["id"])
    scored = with_uncertainty(pool, PROBS, LABELS)
    rows = baseline.count()
    posts = v.posts.select("*", row, cleaned)
    return select_candidates(
        scored, rows, rows + 100, ["id"], "al_prediction", posts=posts, row="_row"
    ).drop("_row")


@query(
    "l8_select_candidates",
    f"""SELECT id, predicted_sentiment AS sentiment, 'al_prediction' AS label_source,
          true AS review_required FROM ({_CANDIDATES})""",
    "valid uncertain",
)
def l8(v):
    baseline = materialize(baseline_of(v), "baseline")
    chosen = candidates_of(v, baseline)
    return chosen.select("id", "sentiment", "label_source", "review_required")


@query(
    "l9_baseline_as_scored",
    f"""SELECT id, sentiment AS predicted_sentiment, 1.0::DOUBLE AS model_confidence,
          NULL::DOUBLE AS uncertainty_margin, (sentiment = 'negative')::INTEGER::DOUBLE AS p_negative,
          (sentiment = 'neutral')::INTEGER::DOUBLE AS p_neutral,
          (sentiment = 'positive')::INTEGER::DOUBLE AS p_positive FROM ({_BASELINE})""",
    "valid",
)
def l9(v):
    rows = baseline_as_scored(baseline_of(v), LABELS, PROBS)
    return rows.select("id", "predicted_sentiment", "model_confidence", "uncertainty_margin", *PROBS)


@query(
    "l10_assemble",
    f"""SELECT id, url, text, sentiment, text_clean, label_source, review_required,
          sentiment AS predicted_sentiment, 1.0::DOUBLE AS model_confidence,
          NULL::DOUBLE AS uncertainty_margin, NULL::DOUBLE AS uncertainty_entropy
        FROM ({_BASELINE})
        UNION ALL
        SELECT id, url, text, predicted_sentiment, {q.clean('text')}, 'al_prediction', true,
          predicted_sentiment, {q.r('model_confidence')}, {q.r('uncertainty_margin')},
          {q.r('uncertainty_entropy')} FROM ({_CANDIDATES})""",
    "valid uncertain",
)
def l10(v):
    baseline = materialize(baseline_of(v), "baseline")
    return assemble(
        baseline_as_scored(baseline, LABELS, PROBS),
        candidates_of(v, baseline),
        unused=["lang", "source", *PROBS],
    )


@query(
    "l11_merge_predictions",
    f"""SELECT id::VARCHAR AS id, sentiment AS sentiment_label, sarcasm_label,
          {q.r('sarcasm_confidence')} AS sarcasm_confidence, irony_matched,
          CASE sarcasm_label WHEN 1 THEN 'sarcasm' ELSE 'non_sarcasm' END AS sarcasm_text,
          final_sentiment FROM final""",
    "final",
)
def l11(v):
    merged = merge_predictions(v.al_set, v.irony, FLIPS, FLIP_TO)
    return merged.select(
        "id",
        "sentiment_label",
        "sarcasm_label",
        "sarcasm_confidence",
        "irony_matched",
        "sarcasm_text",
        "final_sentiment",
    )


_EXPORT = {
    "id": "tweet_id",
    "url": "url",
    "created_at": "created_at",
    "text": "text",
    "like_count": "like_count",
    "review_required": "review_required",
    "sarcasm_label": "sarcasm_label",
    "final_sentiment": "final_sentiment",
    "ingestion_ts": "ingestion_ts",
}


@query(
    "l12_export_results",
    """SELECT id::VARCHAR AS tweet_id, url, text, like_count::VARCHAR AS like_count,
         review_required::VARCHAR AS review_required, sarcasm_label::VARCHAR AS sarcasm_label,
         final_sentiment, (SELECT count(*) FROM final) AS exported FROM final""",
    "final",
)
def l12(v):
    csv = scratch_path(v.spark, "export-csv")
    target = scratch_path(v.spark, "export")
    rows = export_results(v.final, target, "parquet", csv, _EXPORT, ExportTypes())
    copied = read_posts_csv(v.spark, [csv]).drop("source_file", "created_at")
    return copied.withColumn("exported", F.lit(rows).cast("bigint"))



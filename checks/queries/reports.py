"""Report aggregates."""

from pyspark.sql import functions as F

from checks import sql as q
from checks.queries.columns import BUCKET
from checks.registry import query
from checks.views import LABELS, PROBS
from tidepost.functions.scores import best_label
from tidepost.operators import counts, evaluate, reports

_STATUS = ["F", "O", "P"]
METRICS = ["repost_count", "like_count", "view_count"]


@query(
    "a1_stage_counts",
    """SELECT 0 AS position, 'raw' AS stage, count(*) AS rows FROM posts_raw
       UNION ALL SELECT 1, 'posts', count(*) FROM posts
       UNION ALL SELECT 2, 'labelled', count(*) FROM labelled_raw""",
    "posts_raw labelled_raw",
)
def a1(v):
    return counts.stage_counts({"raw": v.posts_raw, "posts": v.posts, "labelled": v.labelled_raw})


@query(
    "a2_distribution_lang",
    f"""SELECT lang, count(*) AS count,
          {q.r('count(*)::DOUBLE / (SELECT count(*) FROM documents) * 100')} AS percent
        FROM documents GROUP BY 1""",
)
def a2(v):
    return counts.distribution(v.table("documents"), ["lang"], share=True)


@query(
    "a2_distribution_top",
    """SELECT event_type, user_id, count(*) AS count FROM events GROUP BY ALL
       ORDER BY count(*) DESC, event_type, user_id LIMIT 10""",
)
def a2_top(v):
    return counts.distribution(v.table("events"), ["event_type", "user_id"], 10)


@query(
    "a3_sentiment_summary",
    """WITH everything AS (SELECT count(*)::DOUBLE AS posts FROM final),
       cells AS (
         SELECT final_sentiment, sarcasm_label, count(*) AS count,
           coalesce(sum(review_required::INT), 0)::BIGINT AS pending_review
         FROM final GROUP BY final_sentiment, sarcasm_label)
       SELECT cells.*, round(count / posts * 100, 2) AS percentage FROM cells, everything""",
    "final",
)
def a3(v):
    return reports.sentiment_summary(v.final, "final_sentiment", "sarcasm_label", "review_required")


_N = {x: f"count(*) FILTER (final_sentiment = '{x}')" for x in LABELS}


@query(
    "a4_kpi_row",
    "SELECT count(*) AS total, "
    + ", ".join(f"{n} AS n_{x}, {q.r(q.pct(n, 'count(*)'))} AS pct_{x}" for x, n in _N.items())
    + f", {q.r('avg(model_confidence) * 100')} AS avg_confidence, "
    "sum(sarcasm_label)::BIGINT AS n_irony, "
    f"{q.r(q.pct('sum(sarcasm_label)', 'count(*)'))} AS pct_irony FROM final",
    "final",
)
def a4(v):
    return reports.kpi_row(
        v.final, "final_sentiment", LABELS, "model_confidence", "sarcasm_label"
    )


@query(
    "a5_monthly_counts",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) AS count
       FROM orders GROUP BY ALL""",
)
def a5(v):
    return reports.monthly_counts(v.table("orders"), "o_orderdate", "o_orderstatus")


@query(
    "a6_monthly_share",
    f"""SELECT month, F, O, P, F + O + P AS total, {q.r('F::DOUBLE / (F + O + P) * 100')} AS pct,
          F::DOUBLE / (F + O + P) * 100 >= 30 AS alert FROM (
          SELECT strftime(o_orderdate, '%Y-%m') AS month,
            count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
            count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1)""",
)
def a6(v):
    return reports.monthly_share(
        v.table("orders"), "o_orderdate", "o_orderstatus", _STATUS, "F"
    )


_EDGES = """(VALUES (0, '<50%'), (1, '50-70%'), (2, '70-85%'), (3, '85-95%'), (4, '>95%'))
    e(position, bucket)"""
_P = BUCKET.replace("x ", "p_negative ")


@query(
    "a7_bucket_distribution",
    f"""SELECT e.position, e.bucket, count(s.b) AS count FROM {_EDGES}
        LEFT JOIN (SELECT {_P} AS b FROM scored) s ON s.b = e.bucket GROUP BY ALL""",
    "scored",
)
def a7(v):
    return reports.bucket_distribution(v.scored, "p_negative")


@query(
    "a8_label_by_bucket",
    f"""WITH f AS (SELECT final_sentiment, {BUCKET.replace('x ', 'model_confidence ')} AS b
           FROM final)
        SELECT l.final_sentiment, e.position, e.bucket, count(f.b) AS count
        FROM (SELECT DISTINCT final_sentiment FROM f) l, {_EDGES}
        LEFT JOIN f ON f.b = e.bucket AND f.final_sentiment = l.final_sentiment GROUP BY ALL""",
    "final",
)
def a8(v):
    return reports.label_by_bucket(v.final, "final_sentiment", "model_confidence")


_LONG = """(SELECT final_sentiment, 'repost_count' AS metric, repost_count AS x FROM final
    UNION ALL SELECT final_sentiment, 'like_count', like_count FROM final
    UNION ALL SELECT final_sentiment, 'view_count', view_count FROM final)"""


@query(
    "a9_mean_by",
    f"SELECT final_sentiment, metric, {q.r('avg(x)')} AS mean FROM {_LONG} GROUP BY ALL",
    "final",
)
def a9(v):
    return counts.mean_by(v.final, "final_sentiment", METRICS)


@query(
    "a10_median_by",
    f"SELECT final_sentiment, metric, {q.r('median(x)')} AS median FROM {_LONG} GROUP BY ALL",
    "final",
)
def a10(v):
    return counts.median_by(v.final, "final_sentiment", METRICS)


@query(
    "a10_median_by_lineitem",
    f"""SELECT l_returnflag, 'l_quantity' AS metric, {q.r('median(l_quantity)')} AS median
          FROM lineitem GROUP BY ALL
        UNION ALL SELECT l_returnflag, 'l_extendedprice', {q.r('median(l_extendedprice)')}
          FROM lineitem GROUP BY ALL""",
)
def a10_lineitem(v):
    return counts.median_by(
        v.table("lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"]
    )


_PRICED = ["l_quantity", "l_extendedprice"]


@query(
    "a10_median_approx",
    " UNION ALL ".join(
        f"""SELECT l_returnflag, '{m}' AS metric, count({m}) AS rows, true AS near
            FROM lineitem GROUP BY ALL"""
        for m in _PRICED
    ),
)
def a10_approx(v):
    """Whether the sketched median's rank is off by no more than a 10,000th of the rows."""
    rows = v.table("lineitem")
    medians = counts.median_by(rows, "l_returnflag", _PRICED, approx=True)
    n, value, median = F.count("value"), F.col("value"), F.col("median")
    near = (F.count_if(value < median) <= n * 0.5001 + 1) & (
        F.count_if(value <= median) >= n * 0.4999 - 1
    )
    return (
        counts.unpivoted(rows, "l_returnflag", _PRICED)
        .join(F.broadcast(medians), ["l_returnflag", "metric"])  # a row for each flag and metric
        .groupBy("l_returnflag", "metric")
        .agg(n.alias("rows"), near.alias("near"))
    )


@query(
    "a11_irony_by_label",
    """SELECT CASE sarcasm_label WHEN 0 THEN 'Plain' ELSE 'Ironic' END AS irony, final_sentiment,
         count(*) AS count FROM final GROUP BY ALL""",
    "final",
)
def a11(v):
    names = {0: "Plain", 1: "Ironic"}
    return reports.irony_by_label(v.final, "sarcasm_label", "final_sentiment", names)


@query(
    "a12_high_uncertainty",
    f"""SELECT final_sentiment, count(*) AS count, sum(count(*)) OVER ()::BIGINT AS high_total,
          {q.r('sum(count(*)) OVER () / (SELECT count(*) FROM final) * 100')} AS high_pct
        FROM final WHERE uncertainty_entropy > 0.8 GROUP BY 1""",
    "final",
)
def a12(v):
    return reports.high_uncertainty(v.final, "final_sentiment", "uncertainty_entropy")


@query(
    "a12_label_source",
    f"""SELECT label_source, count(*) AS count,
          {q.r('count(*)::DOUBLE / (SELECT count(*) FROM final) * 100')} AS percent
        FROM final GROUP BY 1""",
    "final",
)
def a12_source(v):
    return reports.label_source_share(v.final, "label_source")


@query(
    "a13_irony_changes",
    """SELECT count(*) AS total, count(*) FILTER (sentiment <> final_sentiment) AS changed,
         count(*) FILTER (NOT irony_matched) AS unmatched FROM final""",
    "final",
)
def a13(v):
    return reports.irony_changes(v.final, "sentiment", "final_sentiment", "irony_matched")


@query(
    "a13_changed_examples",
    """SELECT id, sentiment, final_sentiment FROM final WHERE sentiment <> final_sentiment
       ORDER BY id LIMIT 10""",
    "final",
)
def a13_examples(v):
    columns = ["id", "sentiment", "final_sentiment"]
    return reports.changed_examples(v.final, "sentiment", "final_sentiment", columns, ["id"])


_SAID = """SELECT (p.vec_id % 3)::INTEGER AS y, CASE WHEN p_negative >= p_neutral
    AND p_negative >= p_positive THEN 0 WHEN p_neutral >= p_positive THEN 1 ELSE 2 END AS p
    FROM scored p"""


def _report_sql() -> str:
    rows = []
    for i, name in enumerate(LABELS):
        rows.append(
            f"""SELECT '{name}' AS label, count(*) FILTER (y = {i} AND p = {i}) AS hit,
              count(*) FILTER (p = {i}) AS said, count(*) FILTER (y = {i}) AS support FROM e"""
        )
    return f"""
      WITH e AS ({_SAID}), c AS ({' UNION ALL '.join(rows)}),
      m AS (SELECT label, support, CASE WHEN said > 0 THEN hit::DOUBLE / said ELSE 0 END AS p,
          CASE WHEN support > 0 THEN hit::DOUBLE / support ELSE 0 END AS r,
          CASE WHEN said + support > 0 THEN 2.0 * hit::DOUBLE / (said + support) ELSE 0 END AS f
        FROM c),
      a AS (SELECT count(*) FILTER (y = p)::DOUBLE / count(*) AS acc, count(*) AS n FROM e)
      SELECT label, {q.r('p')} AS precision, {q.r('r')} AS recall, {q.r('f')} AS f1, support FROM m
      UNION ALL SELECT 'accuracy', {q.r('acc')}, {q.r('acc')}, {q.r('acc')}, n FROM a
      UNION ALL SELECT 'macro avg', {q.r('avg(p)')}, {q.r('avg(r)')}, {q.r('avg(f)')},
        sum(support)::BIGINT FROM m
      UNION ALL SELECT 'weighted avg', {q.r('sum(p * support) / sum(support)')},
        {q.r('sum(r * support) / sum(support)')}, {q.r('sum(f * support) / sum(support)')},
        sum(support)::BIGINT FROM m"""


@query("a33_classification_report", _report_sql(), "scored")
def a33(v):
    truth = F.element_at(F.array(*[F.lit(x) for x in LABELS]), (F.col("vec_id") % 3 + 1).cast("int"))
    rows = v.scored.select(truth.alias("y"), best_label(PROBS, LABELS).alias("p"))
    return evaluate.classification_report(rows, "y", "p", LABELS)

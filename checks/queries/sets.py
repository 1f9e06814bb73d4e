"""Duplicates, unions, joins, ranking, samples and splits."""

from pyspark.sql import functions as F

from checks import sql as q
from checks.registry import query
from checks.views import LABELS, PROBS, STOPWORDS
from tidepost.functions.text import clean_text
from tidepost.operators import explore, ranking, sampling
from tidepost.operators.classify import with_uncertainty
from tidepost.operators.dedup import dedup, keep_best, removed_count
from tidepost.operators.lookup import attach_predictions, exclude_matches
from tidepost.operators.shape import union_all
from tidepost.plans.active import head_cut
from tidepost.plans.labelling import unlabelled_pool, valid_labels


@query(
    "d1_dedup",
    """SELECT id, src, view_count FROM (SELECT *,
         row_number() OVER (PARTITION BY id ORDER BY src) AS rn FROM posts_raw) WHERE rn = 1""",
    "posts_raw",
)
def d1(v):
    return dedup(v.posts_raw, ["id"], ["src"]).select("id", "src", "view_count")


@query(
    "d1_removed_count",
    """SELECT count(*) AS rows_before, count(DISTINCT id) AS rows_after,
         count(*) - count(DISTINCT id) AS rows_removed FROM posts_raw""",
    "posts_raw",
)
def d1_removed(v):
    return removed_count(v.posts_raw, dedup(v.posts_raw, ["id"], ["src"]))


@query(
    "d2_keep_best",
    """SELECT id, src, view_count FROM (SELECT *, row_number() OVER
         (PARTITION BY id ORDER BY view_count DESC, src) AS rn FROM posts_raw) WHERE rn = 1""",
    "posts_raw",
)
def d2(v):
    return keep_best(v.posts_raw, "id", "view_count", ["src"]).select("id", "src", "view_count")


@query(
    "d3_dedup_clean_text",
    f"""SELECT doc_id, lang FROM (SELECT *, row_number() OVER
          (PARTITION BY {q.clean('text')} ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def d3(v):
    docs = v.table("documents").withColumn("text_clean", clean_text("text"))
    return dedup(docs, ["text_clean"], ["doc_id"]).select("doc_id", "lang")


@query(
    "d4_union_all",
    """SELECT doc_id AS id, text, lang, NULL AS role FROM documents
       UNION ALL SELECT conv_id, text, NULL, role FROM conversations""",
)
def d4(v):
    docs = v.table("documents").select(F.col("doc_id").alias("id"), "text", "lang")
    turns = v.table("conversations").select("role", "text", F.col("conv_id").alias("id"))
    return union_all([docs, turns])


@query(
    "d5_head_cut",
    """SELECT id, label_source FROM al_set
       ORDER BY CASE label_source WHEN 'manual' THEN 0 ELSE 1 END, id LIMIT 500""",
    "al_set",
)
def d5(v):
    first = F.when(F.col("label_source") == "manual", 0).otherwise(1)
    return head_cut(v.al_set.select("id", "label_source"), first, ["id"], 500)


@query(
    "j1_exclude_by_url",
    """SELECT id, url FROM posts p
       WHERE NOT EXISTS (SELECT 1 FROM valid l WHERE l.url = p.url)""",
    "valid",
)
def j1(v):
    known = valid_labels(v.labelled_raw, "sentiment", "text", LABELS)
    return exclude_matches(v.posts, known, "url").select("id", "url")


@query(
    "j2_exclude_by_text",
    """SELECT id, lang FROM posts p
       WHERE NOT EXISTS (SELECT 1 FROM valid l WHERE l.text = p.text)""",
    "valid",
)
def j2(v):
    known = valid_labels(v.labelled_raw, "sentiment", "text", LABELS)
    return exclude_matches(v.posts, known, "text", salts=4).select("id", "lang")


POOL = f"""SELECT id, url, text_clean FROM (SELECT *, row_number() OVER
      (PARTITION BY text_clean ORDER BY id) AS rn FROM (
        SELECT *, {q.clean('text')} AS text_clean FROM posts p
        WHERE NOT EXISTS (SELECT 1 FROM valid l WHERE l.url = p.url)
          AND NOT EXISTS (SELECT 1 FROM valid l WHERE l.text = p.text))) WHERE rn = 1"""


@query("j3_unlabelled_pool", POOL, "valid")
def j3(v):
    known = valid_labels(v.labelled_raw, "sentiment", "text", LABELS)
    posts = v.posts.withColumn("text_clean", clean_text("text"))
    return unlabelled_pool(posts, known, ["id"]).select("id", "url", "text_clean")


@query(
    "j4_attach_predictions",
    f"""SELECT p.id, i.sarcasm_label, {q.r('i.sarcasm_confidence')} AS sarcasm_confidence
        FROM posts p LEFT JOIN irony i ON i.id = p.id""",
    "posts irony",
)
def j4(v):
    weaker = v.irony.withColumn("sarcasm_confidence", F.col("sarcasm_confidence") / 2)
    joined = attach_predictions(
        v.posts.select("id"), v.irony.union(weaker), "id", ["sarcasm_confidence", "sarcasm_label"]
    )
    return joined.select("id", "sarcasm_label", "sarcasm_confidence")


@query(
    "j5_term_baseline",
    f"""WITH t AS (SELECT lang, unnest({q.tokens('text', STOPWORDS)}) AS term FROM documents),
          f AS (SELECT term, count(*) AS n FROM t WHERE lang = 'fr' GROUP BY 1),
          e AS (SELECT term, count(*) AS n FROM t WHERE lang = 'en' GROUP BY 1)
        SELECT f.term, f.n, coalesce(e.n, 0) AS base_n FROM f LEFT JOIN e ON f.term = e.term""",
)
def j5(v):
    docs = v.table("documents")
    counts = explore.term_counts(docs.filter("lang = 'fr'"), "text", STOPWORDS)
    return explore.term_baseline(counts, docs.filter("lang = 'en'"), "text", STOPWORDS)


def _uncertain(v):
    return with_uncertainty(v.scored_posts, PROBS, LABELS)


@query(
    "w1_most_uncertain",
    f"""SELECT id, {q.r('uncertainty_margin')} AS uncertainty_margin FROM uncertain
        ORDER BY uncertain.uncertainty_margin, uncertainty_entropy DESC, id LIMIT 150""",
    "uncertain",
)
def w1(v):
    rows = _uncertain(v).select("id", "uncertainty_margin", "uncertainty_entropy")
    top = ranking.most_uncertain(rows, 150, "uncertainty_margin", "uncertainty_entropy", ["id"])
    return top.select("id", "uncertainty_margin")


@query(
    "w1_top_n_by_number",
    "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber LIMIT 20000",
)
def w1_large(v):
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    rows = v.table("lineitem").select(*keys, "l_extendedprice")
    return ranking.top_n(rows, [F.desc("l_extendedprice"), *keys], 20_000).select(*keys)


@query(
    "w2_review_queue",
    f"""SELECT id, url, sentiment, final_sentiment, {q.r('model_confidence')} AS model_confidence,
          label_source FROM final WHERE review_required
        ORDER BY final.model_confidence NULLS LAST, id LIMIT 100""",
    "final",
)
def w2(v):
    rows = ranking.review_queue(v.final, "review_required", "model_confidence", ["id"])
    return rows.select(
        "id", "url", "sentiment", "final_sentiment", "model_confidence", "label_source"
    )


@query(
    "w3_top_days",
    f"""SELECT {q.day('ts')} AS date, count(*) AS n FROM events GROUP BY 1
        ORDER BY n DESC, 1 LIMIT 5""",
)
def w3(v):
    return explore.top_days(v.table("events"), "ts", 5)


@query(
    "w4_top_posts",
    """SELECT id, view_count, substr(text, 1, 300) AS text FROM posts
       WHERE CAST(created_at AS DATE) = DATE '2024-01-10'
       ORDER BY view_count DESC, id LIMIT 5""",
    "posts",
)
def w4(v):
    return explore.top_posts(
        v.posts,
        "view_count",
        5,
        ["id", "view_count", "text"],
        ["id"],
        where=F.to_date("created_at") == F.lit("2024-01-10").cast("date"),
        text="text",
        preview=300,
    )


@query(
    "w5_top_users",
    """SELECT user_id, count(*) AS count FROM events GROUP BY 1
       ORDER BY 2 DESC, 1 LIMIT 20""",
)
def w5(v):
    return explore.top_users(v.table("events"), "user_id", 20)


@query(
    "w5_top_users_of_day",
    """SELECT user_id, count(*) AS count FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def w5_day(v):
    return explore.top_users(v.table("events"), "user_id", 10, "ts", "2024-01-10")


_FLAG = "regexp_matches(lower(coalesce(text, '')), 'license|e?mail|the')"
_PATTERNS = ["license", "e?mail", "the"]
_DAILY = f"""SELECT CAST(created_at AS DATE) AS d, count(id) AS total,
    count(*) FILTER ({_FLAG}) AS flagged FROM posts GROUP BY 1"""


@query(
    "w6_top_mention_days",
    f"""SELECT {q.day('d')} AS date, total, flagged, {q.r(q.pct('flagged', 'total'))} AS pct
        FROM ({_DAILY}) ORDER BY flagged DESC, d LIMIT 5""",
    "posts",
)
def w6(v):
    return explore.top_mention_days(v.posts, "created_at", "id", "text", _PATTERNS, 5)


@query(
    "w6_posts_of_top_day",
    f"""SELECT id, view_count FROM posts WHERE {_FLAG} AND CAST(created_at AS DATE) =
          (SELECT d FROM ({_DAILY}) ORDER BY flagged DESC, d LIMIT 1)
        ORDER BY view_count DESC, id LIMIT 5""",
    "posts",
)
def w6_posts(v):
    return explore.posts_of_top_mention_day(
        v.posts, "created_at", "id", "text", _PATTERNS, "view_count", 5, ["id", "view_count"]
    )


@query(
    "w7_top_repeated_texts",
    f"""SELECT substr(t, 1, 250) AS norm_text, copies, authors, authors >= 5 AS coordinated
        FROM (SELECT * FROM (SELECT {q.norm('text')} AS t, count(*) AS copies,
                count(DISTINCT url) AS authors FROM posts GROUP BY 1)
              WHERE copies > 1 AND {q.words('t')} >= 10 ORDER BY copies DESC, t LIMIT 10)""",
    "posts",
)
def w7(v):
    return explore.top_repeated_texts(v.posts, "text", "url", 10, 250)


@query("w8_order_by_time", f"SELECT event_id, {q.stamp('ts')} AS ts FROM events")
def w8(v):
    return ranking.by_time(v.table("events"), "ts", ["event_id"]).select("event_id", "ts")


@query("w9_preview", "SELECT least(10, count(*)) AS rows FROM events")
def w9(v):
    return ranking.preview(v.table("events"), 10).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "r1_split_by_hash",
    f"""SELECT id, CASE WHEN {q.unit('id')} < 0.8 THEN 'train' ELSE 'eval' END AS part
        FROM valid""",
    "valid",
)
def r1(v):
    rows = valid_labels(v.labelled_raw, "sentiment", "text", LABELS).select("id")
    train, evaluation = sampling.split_by_hash(rows, "id")
    return train.withColumn("part", F.lit("train")).union(
        evaluation.withColumn("part", F.lit("eval"))
    )


@query(
    "r2_stratified_split",
    """WITH c AS (SELECT sentiment, count(*) AS n FROM valid GROUP BY 1),
         t AS (SELECT *, sum(n) OVER () AS total,
             (sum(n) OVER () - ceil(sum(n) OVER () * 0.2)) * n / sum(n) OVER () AS quota FROM c),
         s AS (SELECT *, floor(quota) AS base, row_number() OVER
             (ORDER BY quota - floor(quota) DESC, sentiment) AS turn FROM t),
         g AS (SELECT sentiment, base + CASE WHEN turn <=
               (SELECT max(total) - ceil(max(total) * 0.2) - sum(base) FROM s)
               THEN 1 ELSE 0 END AS train FROM s)
       SELECT id, sentiment, CASE WHEN rn <= train THEN 'train' ELSE 'eval' END AS split
       FROM (SELECT id, v.sentiment, row_number() OVER
               (PARTITION BY v.sentiment ORDER BY md5(id || '|42'), id) AS rn, g.train
             FROM valid v JOIN g ON g.sentiment = v.sentiment)""",
    "valid",
)
def r2(v):
    rows = valid_labels(v.labelled_raw, "sentiment", "text", LABELS).select("id", "sentiment")
    return sampling.stratified_split(rows, "sentiment", "id", LABELS)


@query(
    "r3_fixed_sample",
    "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || '|42'), doc_id LIMIT 300",
)
def r3(v):
    return sampling.fixed_sample(v.table("documents").select("doc_id", "lang"), 300, "doc_id")

"""Typed and derived columns, column sets, row numbers."""

from pyspark.sql import functions as F

from checks import sql as q
from checks.registry import query
from checks.views import FLIP_TO, FLIPS, LABELS
from tidepost.functions import columns as c
from tidepost.functions.times import is_lost, parse_time
from tidepost.operators import shape
from tidepost.operators.explore import with_interactions, with_time_parts
from tidepost.operators.ranking import number_rows
from tidepost.operators.reports import report_filter, report_rows
from tidepost.plans.export import ExportTypes, coerce_export, export_losses
from tidepost.plans.ingest import with_flags, with_ingestion_time
from tidepost.plans.labelling import valid_labels
from tidepost.plans.merge import fill_irony


def reply():
    return c.to_bool("is_reply_raw")


def quote():
    return F.col("event_type") == "view"


_REPLY, _QUOTE = "(is_reply_raw = 'true')", "(event_type = 'view')"


@query(
    "p1_row_id",
    "SELECT count(*) AS rows, count(*) AS ids, true AS not_negative FROM events",
)
def p1(v):
    return shape.with_row_id(v.table("events")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("row_id").alias("ids"),
        (F.min("row_id") >= 0).alias("not_negative"),
    )


@query(
    "p2_number_rows",
    """SELECT event_id, row_number() OVER (ORDER BY event_type, value DESC, event_id) + 1
         AS source_row FROM events""",
)
def p2(v):
    rows = v.table("events").select("event_id", "event_type", "value")
    order = ["event_type", F.desc("value"), "event_id"]
    return number_rows(rows, order, "source_row", start=2).select("event_id", "source_row")


#: Forms of a time, and the text after which it has no seconds or no time of day.
_FORMS = [
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "second", 0),
    ("yyyy-MM-dd HH:mm:ss'+07:00'", "second", 7),
    ("MMM dd HH:mm:ss '+0000' yyyy", "second", 0),
    ("dd MMM yyyy HH:mm:ss 'GMT'", "second", 0),
    ("EEEE dd MMMM yyyy HH:mm:ss", "second", 0),
    ("EEE, dd MMM yyyy HH:mm 'EST'", "minute", -5),
    ("MMM d, yyyy", "day", 0),
    ("dd MMM yyyy", "day", 0),
    ("yyyyMMdd", "day", 0),
    ("yyyyMMddHHmmss", "second", 0),
    ("yyyy/MM/dd HH:mm", "minute", 0),
    ("MM/dd/yyyy hh:mm a", "minute", 0),
    ("MMMM d, yyyy 'at' h:mm:ss a 'WIB'", "second", 7),
    ("yyyy.MM.dd HH:mm:ss 'UTC-03:30'", "second", -3.5),
    ("d-MMM-yyyy", "day", 0),
    ("'soon' yyyy", None, 0),
    ("yyyy-MM-dd 25:61", None, 0),
    ("d MMMM", None, 0),
]
_FORMS_SQL = " ".join(
    f"WHEN {i} THEN " + ("NULL" if unit is None else q.stamp(f"date_trunc('{unit}', ts) - INTERVAL '{int(hours * 60)} minutes'"))
    for i, (_, unit, hours) in enumerate(_FORMS)
)


@query(
    "p31_time_forms",
    f"""SELECT event_id, CASE event_id % {len(_FORMS)} {_FORMS_SQL} END AS time,
          event_id % {len(_FORMS)} IN ({', '.join(str(i) for i, f in enumerate(_FORMS) if f[1] is None)}) AS lost
        FROM events""",
)
def p31_forms(v):
    number = F.col("event_id") % len(_FORMS)
    text = F.coalesce(
        *[F.when(number == i, F.date_format("ts", form)) for i, (form, _, _) in enumerate(_FORMS)]
    )
    rows = v.table("events").select("event_id", text.alias("text"))
    rows = rows.withColumn("time", parse_time("text"))
    return rows.select("event_id", "time", is_lost("text", "time").alias("lost"))


@query(
    "p30_export_losses",
    """SELECT 'is_reply' AS "column", count(*) FILTER (is_reply_raw <> '') AS filled,
         0::BIGINT AS lost FROM posts
       UNION ALL SELECT 'like_count', count(*), count(*) FILTER (id % 3 = 0) FROM posts
       UNION ALL SELECT 'created_at', count(*) FILTER (id % 4 <> 1), count(*) FILTER (id % 4 = 2)
         FROM posts""",
    "posts",
)
def p30_losses(v):
    number = F.when(F.col("id") % 3 == 0, "many").otherwise(F.col("like_count").cast("string"))
    time = (
        F.when(F.col("id") % 4 == 1, " ")
        .when(F.col("id") % 4 == 2, "yesterday")
        .otherwise(F.date_format("created_at", "EEE, d MMM yyyy HH:mm:ss 'GMT'"))
    )
    rows = v.posts.select(
        F.col("is_reply_raw").alias("is_reply"), number.alias("like_count"), time.alias("created_at")
    )
    return export_losses(rows)


@query(
    "p18_to_bool",
    """SELECT id, lower(trim(is_reply_raw)) IN ('true', '1', 'yes') AS is_reply,
         false AS is_retweet FROM posts""",
    "posts",
)
def p18(v):
    flagged = with_flags(v.posts, {"is_reply_raw": "is_reply", "isRetweet": "is_retweet"})
    return flagged.select("id", "is_reply", "is_retweet")


@query(
    "p19_to_bool_strict",
    """SELECT id, CASE is_reply_raw WHEN 'true' THEN true WHEN 'false' THEN false END AS is_reply
       FROM posts""",
    "posts",
)
def p19(v):
    return v.posts.select("id", c.to_bool_strict("is_reply_raw").alias("is_reply"))


@query("p20_ingestion_time", "SELECT doc_id, true AS has_time FROM documents")
def p20(v):
    rows = with_ingestion_time(v.table("documents"))
    return rows.select("doc_id", F.col("ingestion_ts").isNotNull().alias("has_time"))


@query("p21_valid_labels", "SELECT id, sentiment FROM valid", "valid")
def p21(v):
    return valid_labels(v.labelled_raw, "sentiment", "text", LABELS).select("id", "sentiment")


@query(
    "p22_encode_label",
    """SELECT id, label, label_id, CASE label_id WHEN -1 THEN NULL ELSE label END AS decoded FROM (
         SELECT id, trim(lower(sentiment)) AS label, CASE trim(lower(sentiment))
           WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 ELSE -1 END
           AS label_id FROM labelled_raw)""",
    "labelled_raw",
)
def p22(v):
    rows = v.labelled_raw.select("id", c.clean_label("sentiment").alias("label"))
    rows = rows.withColumn("label_id", c.encode_label("label", LABELS))
    return rows.withColumn("decoded", c.decode_label("label_id", LABELS))


@query(
    "p23_constants",
    "SELECT doc_id, 'unlabeled' AS label_source, true AS review_required FROM documents",
)
def p23(v):
    rows = v.table("documents").select("doc_id")
    return shape.with_constants(rows, label_source="unlabeled", review_required=True)


@query(
    "p27_align",
    """SELECT id, lang, 'posts' AS part FROM posts
       UNION ALL SELECT id, lang, 'labels' FROM labelled_raw""",
    "labelled_raw",
)
def p27(v):
    left = v.posts.select("id", "lang", "view_count")
    right = v.labelled_raw.select("sentiment", "lang", "id")
    left, right = shape.align(left, right)
    return left.withColumn("part", F.lit("posts")).union(right.withColumn("part", F.lit("labels")))


@query(
    "p28_add_missing",
    "SELECT doc_id, NULL::DOUBLE AS prob, lang FROM documents",
)
def p28(v):
    rows = v.table("documents").select("doc_id", "lang")
    return shape.add_missing(rows, {"prob": "double", "lang": "string"})


@query(
    "p29_project_map",
    f"""SELECT id AS tweet_id, {q.stamp('created_at')} AS created_at, view_count AS views
        FROM posts""",
    "posts",
)
def p29(v):
    names = {
        "id": "tweet_id",
        "created_at": "created_at",
        "absent": "absent",
        "view_count": "views",
    }
    return shape.project_map(v.posts, names)


@query(
    "p30_coerce_export",
    f"""SELECT event_id::VARCHAR AS tweet_id, substr(repeat('x', 505) || props, 1, 512) AS url,
          CASE event_type WHEN 'click' THEN NULL ELSE floor(value)::BIGINT END AS like_count,
          CASE event_type WHEN 'click' THEN NULL ELSE {q.r('value')} END AS model_confidence,
          CASE event_type WHEN 'error' THEN NULL
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000000' END AS created_at,
          CASE event_type WHEN 'view' THEN true WHEN 'error' THEN false END AS is_reply
        FROM events""",
)
def p30(v):
    kind = F.col("event_type")
    number = F.when(kind == "click", "n/a").otherwise(F.col("value").cast("string"))
    flag = F.when(kind == "view", " TRUE").when(kind == "error", "0").otherwise("yes")
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = v.table("events").select(
        F.col("event_id").alias("tweet_id"),
        F.concat(F.repeat(F.lit("x"), 505), "props").alias("url"),
        number.alias("like_count"),
        number.alias("model_confidence"),
        F.when(kind == "error", "not a time").otherwise(when).alias("created_at"),
        flag.alias("is_reply"),
    )
    return coerce_export(raw, ExportTypes())


@query(
    "p31_time_parts",
    f"""SELECT event_id, {q.day('ts')} AS date, hour(ts)::INTEGER AS hour,
          dayname(ts) AS weekday, strftime(ts, '%Y-%m') AS month, year(ts)::INTEGER AS year
        FROM events""",
)
def p31(v):
    rows = with_time_parts(v.table("events"), "ts")
    return rows.select("event_id", "date", "hour", "weekday", "month", "year")


@query(
    "p32_engagement",
    """SELECT id, CASE WHEN event_type = 'view' THEN 0 ELSE like_count END + repost_count
         + reply_count AS engagement FROM posts""",
    "posts",
)
def p32(v):
    likes = F.when(F.col("event_type") != "view", F.col("like_count"))
    total = c.engagement(likes, "repost_count", "reply_count")
    return v.posts.select("id", total.alias("engagement"))


@query(
    "p33_author",
    """SELECT id, CASE WHEN event_type = 'view' THEN NULL
         ELSE split_part(split_part(url, 'x.com/', 2), '/', 1) END AS author FROM posts""",
    "posts",
)
def p33(v):
    url = F.when(F.col("event_type") == "view", "https://x.com/home").otherwise(F.col("url"))
    return v.posts.select("id", c.author_of(url).alias("author"))


@query(
    "p34_between_dates",
    """SELECT event_id FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
)
def p34(v):
    rows = v.table("events").filter(c.in_dates("ts", "2024-01-05", "2024-01-20"))
    return rows.select("event_id")


@query(
    "p35_report_filter",
    """SELECT id, final_sentiment FROM final WHERE final_sentiment IN ('negative', 'positive')
       AND CAST(created_at AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-25'
       AND sarcasm_label = 1""",
    "final",
)
def p35(v):
    rows = report_filter(
        v.final,
        "final_sentiment",
        ["negative", "positive"],
        "created_at",
        "2024-01-03",
        "2024-01-25",
        "sarcasm_label",
    )
    return rows.select("id", "final_sentiment")


@query(
    "p36_report_rows",
    f"""SELECT id, final_sentiment, CASE WHEN label_source = 'manual' THEN 0.0
          ELSE {q.r('uncertainty_entropy')} END AS uncertainty_entropy,
          {q.r('sarcasm_label')} AS sarcasm_label, strftime(created_at, '%Y-%m') AS month,
          year(created_at)::INTEGER AS year FROM final""",
    "final",
)
def p36(v):
    loose = v.final.withColumns(
        {
            "final_sentiment": F.initcap("final_sentiment"),
            "uncertainty_entropy": F.when(
                F.col("label_source") != "manual", F.col("uncertainty_entropy")
            ),
        }
    )
    rows = report_rows(
        loose, "created_at", "final_sentiment", ["uncertainty_entropy", "sarcasm_label"]
    )
    return rows.select(
        "id", "final_sentiment", "uncertainty_entropy", "sarcasm_label", "month", "year"
    )


@query(
    "p37_not_null",
    "SELECT d.doc_id, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def p37(v):
    rows = v.table("documents").join(v.table("labels"), "doc_id", "left")
    return rows.dropna(subset=["text", "quality"]).select("doc_id", "quality")


@query(
    "p39_interactions",
    f"""SELECT id, {_REPLY} AS has_reply, {_QUOTE} AS has_quote, {_REPLY} OR {_QUOTE} AS has_any,
          NOT ({_REPLY} OR {_QUOTE}) AS standalone,
          {_REPLY}::INTEGER + {_QUOTE}::INTEGER AS interactions FROM posts""",
    "posts",
)
def p39(v):
    rows = with_interactions(v.posts, reply(), quote())
    kinds = ["has_reply", "has_quote", "has_any", "standalone", "interactions"]
    return rows.select("id", *kinds)


BUCKET = """CASE WHEN x >= 0 AND x <= 0.5 THEN '<50%' WHEN x > 0.5 AND x <= 0.7 THEN '50-70%'
    WHEN x > 0.7 AND x <= 0.85 THEN '70-85%' WHEN x > 0.85 AND x <= 0.95 THEN '85-95%'
    WHEN x > 0.95 AND x <= 1 THEN '>95%' END"""


@query(
    "p40_bucketize",
    f"SELECT vec_id, {BUCKET.replace('x ', 'p_negative * 1.2 ')} AS bucket FROM scored",
    "scored",
)
def p40(v):
    return v.scored.select("vec_id", c.bucketize(F.col("p_negative") * 1.2).alias("bucket"))


@query(
    "p41_display_label",
    """SELECT id, CASE sarcasm_label WHEN 0 THEN 'Plain' WHEN 1 THEN 'Ironic' ELSE 'Unknown' END
         AS irony FROM (SELECT a.id, i.sarcasm_label FROM posts a LEFT JOIN irony i ON a.id = i.id)
    """,
    "posts irony",
)
def p41(v):
    rows = v.posts.select("id").join(v.irony, "id", "left")
    names = {0: "Plain", 1: "Ironic"}
    return rows.select("id", c.display_label("sarcasm_label", names).alias("irony"))


@query(
    "p42_fill_irony",
    f"""SELECT a.id, coalesce(i.sarcasm_label, 0) AS sarcasm_label,
          {q.r('coalesce(i.sarcasm_confidence, 0)')} AS sarcasm_confidence
        FROM posts a LEFT JOIN irony i ON a.id = i.id""",
    "posts irony",
)
def p42(v):
    return fill_irony(v.posts.select("id").join(v.irony, "id", "left"))


@query("p43_resolve", "SELECT id, final_sentiment FROM final", "final")
def p43(v):
    resolved = c.resolve_sentiment("sentiment", "sarcasm_label", FLIPS, FLIP_TO)
    return v.final.drop("final_sentiment").select("id", resolved.alias("final_sentiment"))

"""Exploration statistics."""

from pyspark.sql import functions as F

from checks import sql as q
from checks.queries.columns import quote, reply
from checks.registry import query
from checks.views import CATEGORIES, STOPWORDS
from tidepost.functions.columns import author_of, in_dates
from tidepost.operators import counts, explore

_TYPES = {"id": "bigint", "lang": "string", "source_file": "string", "is_reply_raw": "string"}
_PATTERNS = ["license", "e?mail", "the"]
_FLAG = f"regexp_matches(lower(coalesce(text, '')), '{'|'.join(_PATTERNS)}')"


def _profile_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
              count(*) - count({c}) AS null_count,
              round((count(*) - count({c}))::DOUBLE / count(*) * 100, 2) + 0.0 AS null_pct,
              count(DISTINCT {c}) AS "unique" FROM gaps"""
        for c, t in _TYPES.items()
    )


@query(
    "a14_profile",
    "WITH gaps AS (SELECT id, lang, source_file, nullif(is_reply_raw, '') AS is_reply_raw "
    f"FROM posts) {_profile_sql()}",
    "posts",
)
def a14(v):
    rows = v.posts.withColumn("is_reply_raw", F.nullif("is_reply_raw", F.lit("")))
    return counts.profile(rows.select(*_TYPES))


_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@query(
    "a14_profile_approx",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(*) - count({c}) AS null_count,
              count(DISTINCT {c}) AS exact, true AS near FROM documents"""
        for c in _COLUMNS
    ),
)
def a14_approx(v):
    """Whether sketched distinct counts are within three standard errors (of 5 % each)."""
    docs = v.table("documents").select(*_COLUMNS)
    exact = counts.profile(docs).select("column", F.col("unique").alias("exact"))
    near = F.abs(F.col("unique") - F.col("exact")) <= F.col("exact") * 0.15
    sketched = counts.profile(docs, approx=True).join(exact, "column")
    return sketched.select("column", "non_null", "null_count", "exact", near.alias("near"))


@query(
    "a15_range_summary",
    f"""SELECT {q.stamp('min(ts)')} AS first_ts, {q.stamp('max(ts)')} AS last_ts,
          date_sub('day', min(ts), max(ts)) AS days, count(ts) AS valid_rows, count(*) AS rows,
          {q.r('sum(value)')} AS total_amount, {q.r('avg(value)')} AS mean_amount FROM events""",
)
def a15(v):
    return explore.range_summary(v.table("events"), "ts", "value")


_KEPT = "ts >= TIMESTAMP '2024-01-08'"


@query(
    "a15_filter_effect",
    f"""SELECT count(*) AS rows_before, count(*) FILTER ({_KEPT}) AS rows_after,
          count(*) FILTER (NOT {_KEPT}) AS removed,
          {q.r(f'count(*) FILTER (NOT {_KEPT})::DOUBLE / count(*) * 100')} AS removed_pct
        FROM events""",
)
def a15_effect(v):
    return explore.filter_effect(v.table("events"), in_dates("ts", "2024-01-08"))


@query(
    "a16_user_activity",
    f"""SELECT sum(n)::BIGINT AS posts, count(*) AS users, max(n) AS max_posts,
          count(*) FILTER (n > 50) AS users_over_50, count(*) FILTER (n > 100) AS users_over_100,
          {q.r('sum(n) / count(*)')} AS mean_posts, {q.r('median(n)')} AS median_posts
        FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)""",
)
def a16(v):
    return explore.user_activity(v.table("events"), "user_id")


def _top_share_sql(table: str, user: str) -> str:
    return f"""
      WITH u AS (SELECT {user}, count(*) AS n FROM {table} GROUP BY 1),
      k AS (SELECT count(*) AS users, greatest(1, floor(count(*) * 0.01))::BIGINT AS top FROM u),
      t AS (SELECT n, row_number() OVER (ORDER BY n DESC, {user}) AS rn FROM u)
      SELECT users, top AS top_users, (SELECT sum(n) FROM t WHERE rn <= top)::BIGINT AS top_posts,
        (SELECT sum(n) FROM u)::BIGINT AS posts,
        {q.r('(SELECT sum(n) FROM t WHERE rn <= top) / (SELECT sum(n) FROM u) * 100')} AS top_pct
      FROM k"""


@query("a17_top_share", _top_share_sql("orders", "o_custkey"))
def a17(v):
    return explore.top_share(v.table("orders"), "o_custkey")


@query("a17_top_share_lineitem", _top_share_sql("lineitem", "l_partkey"))
def a17_lineitem(v):
    return explore.top_share(v.table("lineitem"), "l_partkey")


def _histogram_sql(table: str, column: str) -> str:
    return f"""
      WITH e AS (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {table}),
      c AS (SELECT least(floor(({column} - lo) / (hi - lo) * 50), 49)::BIGINT AS bin, count(*) AS n
            FROM {table}, e GROUP BY 1)
      SELECT b.bin, {q.r('lo + b.bin * ((hi - lo) / 50)')} AS bin_start,
        {q.r('lo + (b.bin + 1) * ((hi - lo) / 50)')} AS bin_end, coalesce(c.n, 0) AS n
      FROM (SELECT unnest(generate_series(0::BIGINT, 49)) AS bin) b, e
      LEFT JOIN c ON c.bin = b.bin"""


@query("a18_histogram", _histogram_sql("documents", "n_chars"))
def a18(v):
    return counts.histogram(v.table("documents"), "n_chars")


@query("a18_histogram_lineitem", _histogram_sql("lineitem", "l_extendedprice"))
def a18_lineitem(v):
    return counts.histogram(v.table("lineitem"), "l_extendedprice")


@query("a19_daily_counts", f"SELECT {q.day('ts')} AS date, count(*) AS n FROM events GROUP BY 1")
def a19(v):
    return explore.daily_counts(v.table("events"), "ts")


@query("a20_hourly_counts", "SELECT hour(ts)::INTEGER AS hour, count(*) AS n FROM events GROUP BY 1")
def a20(v):
    return explore.hourly_counts(v.table("events"), "ts")


@query(
    "a20_weekday_counts",
    """SELECT (isodow(ts) - 1)::INTEGER AS position, dayname(ts) AS weekday, count(*) AS n
       FROM events GROUP BY ALL""",
)
def a20_weekday(v):
    return explore.weekday_counts(v.table("events"), "ts")


@query(
    "a21_day_totals",
    """SELECT count(*) AS rows, sum(view_count)::BIGINT AS total_view_count,
         sum(like_count)::BIGINT AS total_like_count FROM posts
       WHERE CAST(created_at AS DATE) = DATE '2024-01-10'""",
    "posts",
)
def a21(v):
    return explore.day_totals(v.posts, "created_at", "2024-01-10", ["view_count", "like_count"])


def _category_sql() -> str:
    parts = []
    for name, patterns in CATEGORIES.items():
        hit = f"count(*) FILTER (regexp_matches(lower(text), '{'|'.join(patterns)}'))"
        share = q.r(f"{hit}::DOUBLE / count(*) * 100")
        parts.append(f"SELECT '{name}' AS category, {hit} AS n, {share} AS pct FROM documents")
    return " UNION ALL ".join(parts)


@query("a22_category_counts", _category_sql())
def a22(v):
    return explore.category_counts(v.table("documents"), "text", CATEGORIES)


_IS_REPLY, _IS_QUOTE = "(is_reply_raw = 'true')", "(event_type = 'view')"
_KIND_TESTS = {
    "reply": _IS_REPLY,
    "quote": _IS_QUOTE,
    "any": f"({_IS_REPLY} OR {_IS_QUOTE})",
    "standalone": f"(NOT ({_IS_REPLY} OR {_IS_QUOTE}))",
}


def _structure_sql(where: str, gap: bool) -> str:
    parts = []
    for kind, test in _KIND_TESTS.items():
        share = f"count(*) FILTER ({test})::DOUBLE / count(*) * 100"
        whole = f"(SELECT {share} FROM posts)"
        extra = (
            f", {q.r(whole)} AS reference_pct, {q.r(f'{share} - {whole}')} AS gap" if gap else ""
        )
        parts.append(
            f"SELECT '{kind}' AS kind, count(*) FILTER ({test}) AS n, {q.r(share)} AS pct{extra} "
            f"FROM posts {where}"
        )
    return " UNION ALL ".join(parts)


@query("a23_interaction_structure", _structure_sql("", False), "posts")
def a23(v):
    return explore.interaction_structure(explore.with_interactions(v.posts, reply(), quote()))


@query(
    "a23_interaction_gap",
    _structure_sql("WHERE CAST(created_at AS DATE) = DATE '2024-01-10'", True),
    "posts",
)
def a23_gap(v):
    kinds = explore.with_interactions(v.posts, reply(), quote())
    day = kinds.filter(in_dates("created_at", "2024-01-10", "2024-01-10"))
    return explore.interaction_structure(day, kinds)


@query(
    "a24_interaction_distribution",
    f"""SELECT {_IS_REPLY}::INTEGER + {_IS_QUOTE}::INTEGER AS interactions, count(*) AS n,
          {q.r('count(*)::DOUBLE / (SELECT count(*) FROM posts) * 100')} AS pct
        FROM posts GROUP BY 1""",
    "posts",
)
def a24(v):
    return explore.interaction_distribution(explore.with_interactions(v.posts, reply(), quote()))


def _mention_sql(period: str, name: str, where: str = "") -> str:
    return f"""SELECT {period} AS {name}, count(id) AS total, count(*) FILTER ({_FLAG}) AS flagged,
      {q.r(q.pct(f'count(*) FILTER ({_FLAG})', 'count(id)'))} AS pct FROM posts {where} GROUP BY 1"""


@query("a25_mention_trend", _mention_sql("strftime(created_at, '%Y-%m')", "month"), "posts")
def a25(v):
    return explore.mention_trend(v.posts, "created_at", "id", "text", _PATTERNS)


@query(
    "a26_mention_days",
    _mention_sql(
        q.day("created_at"),
        "date",
        "WHERE created_at >= TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-20'",
    ),
    "posts",
)
def a26(v):
    return explore.mention_days(
        v.posts, "created_at", "id", "text", _PATTERNS, "2024-01-05", "2024-01-19"
    )


@query(
    "a26_mention_listed_days",
    _mention_sql(
        q.day("created_at"),
        "date",
        "WHERE CAST(created_at AS DATE) IN (DATE '2024-01-03', DATE '2024-01-09')",
    ),
    "posts",
)
def a26_listed(v):
    days = ["2024-01-03", "2024-01-09"]
    return explore.mention_days(v.posts, "created_at", "id", "text", _PATTERNS, days=days)


@query(
    "a27_month_coverage",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, {q.day('min(o_orderdate)')} AS first_date,
          {q.day('max(o_orderdate)')} AS last_date FROM orders GROUP BY 1""",
)
def a27(v):
    return explore.month_coverage(v.table("orders"), "o_orderdate")


_AUTHOR = "split_part(split_part(url, 'x.com/', 2), '/', 1)"


@query(
    "a28_repeated_texts",
    f"""SELECT norm_text, copies, authors, authors >= 5 AS coordinated FROM (
          SELECT {q.norm('text')} AS norm_text, count(*) AS copies,
            count(DISTINCT {_AUTHOR}) AS authors FROM posts GROUP BY 1)
        WHERE copies > 1 AND {q.words('norm_text')} >= 10""",
    "posts",
)
def a28(v):
    posts = v.posts.withColumn("author", author_of("url"))
    return explore.repeated_texts(posts, "text", "author")


_REPEATED = f"""SELECT (SELECT count(*) FROM posts) AS posts, sum(copies)::BIGINT AS long_posts,
    count(*) FILTER (copies > 1) AS repeated_texts,
    coalesce(sum(copies) FILTER (copies > 1), 0)::BIGINT AS repeated_posts FROM (
      SELECT {q.norm('text')} AS t, count(*) AS copies FROM posts GROUP BY 1)
    WHERE {q.words('t')} >= 10"""


@query(
    "a28_repeated_totals",
    f"SELECT *, {q.r('repeated_posts::DOUBLE / posts * 100')} AS repeated_pct FROM ({_REPEATED})",
    "posts",
)
def a28_totals(v):
    return explore.repeated_totals(v.posts, "text", "url")


@query(
    "a29_text_statistics",
    f"""SELECT count(*) AS texts, {q.r('avg(length(text))')} AS mean_length,
          count(*) FILTER ({q.words('text')} < 5) AS short_texts,
          {q.r(f"median({q.words('text')})")} AS median_words FROM documents""",
)
def a29(v):
    return explore.text_statistics(v.table("documents"), "text")


@query(
    "a30_term_counts",
    f"""SELECT term, count(*) AS n FROM (
          SELECT unnest({q.tokens('text', STOPWORDS)}) AS term FROM documents) GROUP BY 1""",
)
def a30(v):
    return explore.term_counts(v.table("documents"), "text", STOPWORDS)


@query(
    "a31_term_lift",
    f"""WITH t AS (SELECT lang, unnest({q.tokens('text', STOPWORDS)}) AS term FROM documents),
          f AS (SELECT term, count(*) AS n FROM t WHERE lang = 'fr' GROUP BY 1
                ORDER BY n DESC, term LIMIT 100),
          b AS (SELECT term, count(*) AS n FROM t WHERE lang <> 'fr' GROUP BY 1),
          s AS (SELECT f.term, f.n, coalesce(b.n, 0) AS base_n,
              f.n / (SELECT count(*) FROM t WHERE lang = 'fr') * 1000 AS rate,
              coalesce(b.n, 0) / (SELECT count(*) FROM t WHERE lang <> 'fr') * 1000 AS base_rate
            FROM f LEFT JOIN b ON f.term = b.term WHERE f.n >= 5)
        SELECT term, n, base_n, {q.r('rate')} AS rate, {q.r('base_rate')} AS base_rate,
          base_rate = 0 AS is_new,
          CASE WHEN base_rate > 0 THEN {q.r('rate / base_rate')} END AS lift FROM s""",
)
def a31(v):
    docs = v.table("documents")
    lift = explore.term_lift(
        docs.filter("lang = 'fr'"), docs.filter("lang <> 'fr'"), "text", STOPWORDS
    )
    return lift.withColumn("lift", F.when(~F.col("is_new"), F.col("lift")))


@query(
    "a32_spike_context",
    f"""WITH d AS (SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1),
          w AS (SELECT * FROM d WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'),
          s AS (SELECT (SELECT avg(n) FROM d) AS mean_all,
              avg(n) FILTER (date < DATE '2024-01-15') AS mean_before,
              (sum(n) FILTER (date = DATE '2024-01-15'))::BIGINT AS on_day,
              avg(n) FILTER (date > DATE '2024-01-15') AS mean_after FROM w)
        SELECT {q.r('mean_all')} AS mean_all, {q.r('mean_before')} AS mean_before, on_day,
          {q.r('mean_after')} AS mean_after, {q.r('(on_day / mean_before - 1) * 100')}
          AS elevation_pct, mean_after > mean_before * 1.3 AS has_tail FROM s""",
)
def a32(v):
    return explore.spike_context(
        v.table("events"), "ts", "2024-01-15", "2024-01-05", "2024-01-25"
    )


@query(
    "a34_findings",
    f"""WITH u AS (SELECT {_AUTHOR} AS author, count(*) AS n FROM posts GROUP BY 1),
          rep AS ({_REPEATED}),
          top AS (SELECT sum(n) AS n FROM (SELECT n FROM u ORDER BY n DESC LIMIT
            (SELECT greatest(1, floor(count(*) * 0.01))::BIGINT FROM u))),
          lang AS (SELECT lang, count(*) AS n FROM posts GROUP BY 1 ORDER BY n DESC, lang LIMIT 1)
        SELECT count(*) AS posts, {q.day('min(created_at)')} AS first_date,
          {q.day('max(created_at)')} AS last_date,
          date_sub('day', min(created_at), max(created_at)) AS days,
          {', '.join(
              f"{q.r(f'count(*) FILTER ({t})::DOUBLE / count(*) * 100')} AS {k}_pct"
              for k, t in _KIND_TESTS.items()
          )},
          (SELECT count(*) FROM u) AS users,
          (SELECT count(*) FROM u WHERE n > 100) AS users_over_100,
          (SELECT greatest(1, floor(count(*) * 0.01))::BIGINT FROM u) AS top_users,
          {q.r('(SELECT n FROM top) / count(*) * 100')} AS top_pct,
          (SELECT repeated_texts FROM rep) AS repeated_texts,
          (SELECT repeated_posts FROM rep) AS repeated_posts,
          {q.r('(SELECT repeated_posts FROM rep)::DOUBLE / count(*) * 100')} AS repeated_pct,
          {q.r('avg(length(text))')} AS mean_length,
          {q.r(f"median({q.words('text')})")} AS median_words,
          count(*) FILTER ({q.words('text')} < 5) AS short_texts,
          (SELECT lang FROM lang) AS main_lang,
          {q.r('(SELECT n FROM lang)::DOUBLE / count(*) * 100')} AS main_lang_pct
        FROM posts""",
    "posts",
)
def a34(v):
    posts = v.posts.withColumn("author", author_of("url"))
    return explore.findings(posts, "created_at", "author", "text", "lang", reply(), quote())

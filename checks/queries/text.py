"""Text expressions and text filters."""

from pyspark.sql import functions as F

from checks import sql as q
from checks.registry import query
from checks.views import CATEGORIES, KEYWORDS, LOOKUP, STOPWORDS
from tidepost.functions import text as t
from tidepost.operators.dedup import dedup
from tidepost.operators.counts import distribution
from tidepost.operators.lookup import normalize_tokens_join, with_forms
from tidepost.operators.shape import compute_once
from tidepost.plans.ingest import clean_posts, keyword_filter, min_tokens, word_filter

_KEYWORD_TEST = " OR ".join(f"contains(lower(text), '{k}')" for k in KEYWORDS)
_PATTERNS = [p for group in CATEGORIES.values() for p in group]


@query("p3_keyword_filter", f"SELECT doc_id, lang FROM documents WHERE {_KEYWORD_TEST}")
def p3(v):
    return keyword_filter(v.table("documents"), "text", KEYWORDS).select("doc_id", "lang")


@query(
    "p4_word_filter",
    rf"""SELECT doc_id, lang FROM documents
         WHERE regexp_matches(lower(text), '(^|[^{q.W}])(the|une)([^{q.W}]|$)')
           OR contains(lower(text), 'license')""",
)
def p4(v):
    rows = word_filter(v.table("documents"), "text", ["the", "une"], ["license"])
    return rows.select("doc_id", "lang")


#: Two hundred keywords, of which the last ones occur.
_MANY = [f"zq{i}x" for i in range(190)] + ["lic", "license", "e-mail", "une ", "der", ".com", "[", "(c)"]


@query(
    "p3_many_keywords",
    "SELECT doc_id FROM documents WHERE "
    + " OR ".join(f"contains(lower(text), '{k}')" for k in _MANY if not k.startswith("zq")),
)
def p3_many(v):
    return keyword_filter(v.table("documents"), "text", _MANY).select("doc_id")


@query(
    "p4_many_words",
    rf"""SELECT doc_id FROM documents
         WHERE regexp_matches(lower(text), '(^|[^{q.W}])(the|une|license|e-mail)([^{q.W}]|$)')
           OR contains(lower(text), 'of the')""",
)
def p4_many(v):
    words = [f"zq{i}" for i in range(190)] + ["the", "une", "license", "e-mail"]
    return word_filter(v.table("documents"), "text", words, ["of the"]).select("doc_id")


@query(
    "p12_large_dictionary",
    f"SELECT doc_id, {q.forms(q.squeeze('lower(text)'))} AS text FROM documents",
)
def p12_large(v):
    """The usual entries among as many others as make the dictionary too large for a plan."""
    entries = {f"zq{i}x": f"form {i}" for i in range(40_000)} | LOOKUP
    docs = v.table("documents").select("doc_id", t.squeeze(F.lower("text")).alias("text"))
    return with_forms(docs, "text", entries)


@query(
    "j6_reduced_dictionary",
    f"SELECT doc_id, {q.forms(q.squeeze('lower(text)'))} AS text FROM documents",
)
def j6_reduced(v):
    """A dictionary table that is too large to be sent, but for the entries that occur."""
    docs = v.table("documents").select("doc_id", t.squeeze(F.lower("text")).alias("text"))
    others = v.spark.range(200_000).select(
        F.concat(F.lit("zq"), "id").alias("token"), F.lit("form").alias("form")
    )
    known = v.spark.createDataFrame(list(LOOKUP.items()), "token string, form string")
    return normalize_tokens_join(docs, "text", others.unionByName(known), broadcast_bytes=1 << 20)


@query(
    "p5_clean_text",
    f"SELECT doc_id, {q.forms(q.clean('text'))} AS text_clean FROM documents",
)
def p5(v):
    return v.table("documents").select("doc_id", t.clean_text("text", LOOKUP).alias("text_clean"))


@query(
    "p5_clean_pages",
    f"SELECT page_id, {q.forms(q.clean('html'))} AS text_clean FROM pages",
)
def p5_pages(v):
    return v.table("pages").select("page_id", t.clean_text("html", LOOKUP).alias("text_clean"))


@query("p6_replace_urls", f"SELECT page_id, {q.urls('html')} AS text FROM pages")
def p6(v):
    return v.table("pages").select("page_id", t.replace_urls("html").alias("text"))


@query("p7_replace_mentions", f"SELECT doc_id, {q.mention('text')} AS text FROM documents")
def p7(v):
    return v.table("documents").select("doc_id", t.replace_mentions("text").alias("text"))


@query("p8_unwrap_hashtags", f"SELECT page_id, {q.hashtag('html')} AS text FROM pages")
def p8(v):
    return v.table("pages").select("page_id", t.unwrap_hashtags("html").alias("text"))


@query("p9_replace_symbols", f"SELECT doc_id, {q.symbols('text')} AS text FROM documents")
def p9(v):
    return v.table("documents").select("doc_id", t.replace_symbols("text").alias("text"))


@query("p10_squeeze", f"SELECT doc_id, {q.squeeze('text')} AS text FROM documents")
def p10(v):
    return v.table("documents").select("doc_id", t.squeeze("text").alias("text"))


@query("p11_lower", "SELECT doc_id, lower(text) AS text FROM documents")
def p11(v):
    return v.table("documents").select("doc_id", F.lower("text").alias("text"))


@query(
    "p12_normalize_tokens",
    f"SELECT doc_id, {q.forms(q.squeeze('lower(text)'))} AS text FROM documents",
)
def p12(v):
    lowered = t.squeeze(F.lower("text"))
    return v.table("documents").select("doc_id", t.normalize_tokens(lowered, LOOKUP).alias("text"))


@query(
    "j6_normalize_tokens_join",
    f"SELECT doc_id, {q.forms(q.squeeze('lower(text)'))} AS text FROM documents",
)
def j6(v):
    docs = v.table("documents").select("doc_id", t.squeeze(F.lower("text")).alias("text"))
    lookup = v.spark.createDataFrame(list(LOOKUP.items()), "token string, form string")
    return normalize_tokens_join(docs, "text", lookup)


@query(
    "p13_clean_light",
    f"SELECT doc_id, {q.light('text')} AS text FROM documents "
    f"UNION ALL SELECT -1 - page_id, {q.light('html')} FROM pages",
)
def p13(v):
    docs = v.table("documents").select("doc_id", t.clean_light("text").alias("text"))
    pages = v.table("pages").select(-1 - F.col("page_id"), t.clean_light("html"))
    return docs.union(pages)


@query(
    "p14_normalize_for_dup",
    f"SELECT doc_id, {q.norm('text')} AS text FROM documents "
    f"UNION ALL SELECT -1 - page_id, {q.norm('html')} FROM pages",
)
def p14(v):
    docs = v.table("documents").select("doc_id", t.normalize_for_dup("text").alias("text"))
    pages = v.table("pages").select(-1 - F.col("page_id"), t.normalize_for_dup("html"))
    return docs.union(pages)


@query(
    "p15_tokenize",
    f"SELECT doc_id, array_to_string({q.tokens('text', STOPWORDS)}, ' ') AS terms FROM documents",
)
def p15(v):
    terms = F.array_join(t.tokenize("text", STOPWORDS), " ")
    return v.table("documents").select("doc_id", terms.alias("terms"))


@query(
    "p16_min_tokens",
    rf"""SELECT * FROM (SELECT doc_id,
           len(string_split_regex({q.clean('text')}, '\s+'))::INTEGER AS token_count
         FROM documents) WHERE token_count >= 5""",
)
def p16(v):
    docs = compute_once(v.table("documents"), text_clean=t.clean_text("text"))
    return min_tokens(docs, "text_clean").select("doc_id", "token_count")


@query(
    "p17_text_sizes",
    f"SELECT doc_id, length(text)::INTEGER AS chars, {q.words('text')} AS words FROM documents",
)
def p17(v):
    return v.table("documents").select(
        "doc_id", t.text_length("text").alias("chars"), t.word_count("text").alias("words")
    )


@query(
    "p38_flag_mentions",
    f"""SELECT doc_id, regexp_matches(lower(coalesce(text, '')), '{"|".join(_PATTERNS)}') AS flag
        FROM documents""",
)
def p38(v):
    return v.table("documents").select("doc_id", t.mentions("text", _PATTERNS).alias("flag"))


_CLEANED = rf"""
    SELECT *, len(string_split_regex(text_clean, '\s+'))::INTEGER AS token_count FROM (
      SELECT *, {q.forms(q.clean('text'))} AS text_clean FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY view_count DESC, src) AS rn
        FROM posts_raw WHERE {_KEYWORD_TEST}) WHERE rn = 1)
    WHERE len(string_split_regex(text_clean, '\s+')) >= 5"""


@query(
    "ingest_clean_posts",
    f"""SELECT id, src, text_clean, token_count, lower(trim(is_reply_raw)) IN ('true', '1', 'yes')
          AS is_reply, false AS is_quote, true AS has_time FROM ({_CLEANED})""",
    "posts_raw",
)
def ingest(v):
    cleaned = clean_posts(
        v.posts_raw,
        KEYWORDS,
        LOOKUP,
        {"is_reply_raw": "is_reply", "is_quote_raw": "is_quote"},
        order=[F.desc("view_count"), "src"],
    )
    return cleaned.select(
        "id",
        "src",
        "text_clean",
        "token_count",
        "is_reply",
        "is_quote",
        F.col("ingestion_ts").isNotNull().alias("has_time"),
    )


def flagship(posts):
    """Relevant posts, cleaned, one per cleaned text, counted by language and source."""
    relevant = keyword_filter(posts, "text", KEYWORDS)
    cleaned = compute_once(relevant, text_clean=t.clean_text("text", LOOKUP))
    kept = dedup(min_tokens(cleaned, "text_clean"), ["text_clean"], ["id"])
    return distribution(kept, ["lang", "source_file"], share=True, few_values=True)


@query(
    "flagship_clean_counts",
    rf"""WITH c AS (SELECT id, lang, source_file, {q.forms(q.clean('text'))} AS text_clean
           FROM posts WHERE {_KEYWORD_TEST}),
         d AS (SELECT *, row_number() OVER (PARTITION BY text_clean ORDER BY id) AS rn FROM c
           WHERE len(string_split_regex(text_clean, '\s+')) >= 5)
         SELECT lang, source_file, count(*) AS count,
           {q.r('count(*)::DOUBLE / (SELECT count(*) FROM d WHERE rn = 1) * 100')} AS percent
         FROM d WHERE rn = 1 GROUP BY ALL""",
    "posts",
)
def flagship_query(v):
    return flagship(v.posts)

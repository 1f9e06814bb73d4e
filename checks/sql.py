"""The same views as SQL, and SQL pieces used by several checks."""

from __future__ import annotations

from checks.views import LOOKUP

W = r"\p{L}\p{N}_"
SP = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}"

VIEWS = {
    "posts": """
        SELECT d.doc_id AS id, concat('https://x.com/u', e.user_id, '/status/', e.event_id) AS url,
          d.text, d.lang, d.source AS source_file, e.ts AS created_at, e.event_type,
          CASE WHEN e.event_type = 'click' THEN 'true' WHEN e.event_type = 'view' THEN ''
            ELSE 'false' END AS is_reply_raw,
          CAST(floor(e.value) AS BIGINT) AS view_count, CAST(d.doc_id % 7 AS BIGINT) AS like_count,
          CAST(d.doc_id % 3 AS BIGINT) AS repost_count, CAST(d.doc_id % 5 AS BIGINT) AS reply_count
        FROM documents d JOIN events e ON e.event_id = d.doc_id * 5""",
    "posts_raw": """
        SELECT *, 'a.csv' AS src FROM posts
        UNION ALL
        SELECT * REPLACE (view_count + 100 AS view_count), 'b.csv' FROM posts
        WHERE event_type = 'view'""",
    "labelled_raw": """
        SELECT p.id, p.url, p.text, p.lang,
          CASE WHEN l.toxic = 1 THEN ' Negative' WHEN l.quality = 0 THEN 'neutral '
            WHEN p.event_type = 'signup' THEN 'unknown' ELSE 'POSITIVE' END AS sentiment
        FROM posts p JOIN labels l ON p.id = l.doc_id""",
    "valid": """
        SELECT * REPLACE (trim(lower(sentiment)) AS sentiment) FROM labelled_raw
        WHERE trim(lower(sentiment)) IN ('negative', 'neutral', 'positive') AND trim(text) <> ''""",
    "scored": """
        SELECT vec_id,
          exp(a-m)/(exp(a-m)+exp(b-m)+exp(c-m)) AS p_negative,
          exp(b-m)/(exp(a-m)+exp(b-m)+exp(c-m)) AS p_neutral,
          exp(c-m)/(exp(a-m)+exp(b-m)+exp(c-m)) AS p_positive
        FROM (SELECT *, greatest(a, b, c) AS m FROM (
          SELECT vec_id, 10*CAST(embedding[1] AS DOUBLE) AS a, 10*CAST(embedding[2] AS DOUBLE) AS b,
            10*CAST(embedding[3] AS DOUBLE) AS c FROM embeddings) l) g""",
    "irony": """
        SELECT vec_id AS id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS sarcasm_label,
          greatest(p, 1-p) AS sarcasm_confidence
        FROM (SELECT vec_id, 1/(1+exp(-10*CAST(embedding[4] AS DOUBLE))) AS p FROM embeddings) t""",
    "scored_posts": """
        SELECT p.*, s.p_negative, s.p_neutral, s.p_positive
        FROM posts p JOIN scored s ON s.vec_id = p.id % (SELECT count(*) FROM embeddings)""",
    "uncertain": """
        SELECT *,
          CASE WHEN p_negative >= p_neutral AND p_negative >= p_positive THEN 'negative'
            WHEN p_neutral >= p_positive THEN 'neutral' ELSE 'positive' END AS predicted_sentiment,
          greatest(p_negative, p_neutral, p_positive) AS model_confidence,
          list_reverse_sort([p_negative, p_neutral, p_positive])[1]
            - list_reverse_sort([p_negative, p_neutral, p_positive])[2] AS uncertainty_margin,
          -(p_negative*ln(p_negative+1e-12) + p_neutral*ln(p_neutral+1e-12)
            + p_positive*ln(p_positive+1e-12)) AS uncertainty_entropy
        FROM scored_posts""",
    "al_set": """
        SELECT u.* EXCLUDE (p_negative, p_neutral, p_positive, predicted_sentiment,
            uncertainty_margin),
          u.predicted_sentiment AS sentiment,
          CASE WHEN l.doc_id IS NULL THEN 'model' ELSE 'manual' END AS label_source,
          l.doc_id IS NULL AS review_required
        FROM uncertain u LEFT JOIN labels l ON l.doc_id = u.id""",
    "final": """
        SELECT a.*, coalesce(i.sarcasm_label, 0) AS sarcasm_label,
          coalesce(i.sarcasm_confidence, 0.0) AS sarcasm_confidence,
          i.sarcasm_label IS NOT NULL AS irony_matched,
          CASE WHEN coalesce(i.sarcasm_label, 0) = 1 AND a.sentiment IN ('positive', 'neutral')
            THEN 'negative' ELSE a.sentiment END AS final_sentiment
        FROM al_set a LEFT JOIN irony i ON i.id = a.id""",
}

_NEEDS = {
    "posts_raw": ["posts"],
    "labelled_raw": ["posts"],
    "valid": ["labelled_raw"],
    "scored_posts": ["posts", "scored"],
    "uncertain": ["scored_posts"],
    "al_set": ["uncertain"],
    "final": ["al_set", "irony"],
}


def with_views(sql: str, *names: str) -> str:
    """Put the named views, and those they need, in front of a statement as a WITH clause."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    if not wanted:
        return sql
    clauses = ", ".join(f"{n} AS ({VIEWS[n]})" for n in wanted)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {clauses}, {body[5:]}"
    return f"WITH {clauses} {body}"


def urls(x: str, by: str = " URL ") -> str:
    return f"regexp_replace({x}, 'https?://[^{SP}]+', '{by}', 'g')"


def mention(x: str, by: str = " USER ") -> str:
    return f"regexp_replace({x}, '@[{W}]+', '{by}', 'g')"


def hashtag(x: str, by: str = r"\1") -> str:
    return f"regexp_replace({x}, '#([{W}]+)', '{by}', 'g')"


def symbols(x: str) -> str:
    return f"regexp_replace({x}, '[^{W}{SP}.,?!]', ' ', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{SP}]+', ' ', 'g'))"


def clean(x: str) -> str:
    return f"lower({squeeze(symbols(hashtag(mention(urls(f'coalesce({x}, {chr(39)*2})')))))})"


def forms(x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LOOKUP.items())
    return (
        f"trim(array_to_string(list_transform(string_split({x}, ' '), "
        f"lambda t: CASE t {cases} ELSE t END), ' '))"
    )


def light(x: str) -> str:
    return squeeze(f"replace({mention(urls(x))}, '#', ' ')")


def norm(x: str) -> str:
    return f"nullif({squeeze(hashtag(mention(urls(f'lower({x})', ''), ''), ''))}, '')"


def words(x: str) -> str:
    return f"len(regexp_extract_all(coalesce({x}, ''), '[^{SP}]+'))::INTEGER"


def tokens(x: str, stop: list[str]) -> str:
    text = hashtag(mention(urls(f"lower(coalesce({x}, ''))", ""), ""), "")
    listed = ", ".join(f"'{s}'" for s in stop)
    return (
        f"list_filter(string_split_regex({text}, '[^a-z]+'), "
        f"lambda t: length(t) > 3 AND t NOT IN ({listed}))"
    )


def r(x: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"round(CAST({x} AS DOUBLE), {digits}) + 0.0"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part}::DOUBLE / {whole} * 100 ELSE 0.0 END"


def unit(key: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5({key} || '|{seed}'), 1, 8))::BIGINT / 4294967296.0)"

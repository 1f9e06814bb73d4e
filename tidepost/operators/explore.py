"""Exploration statistics: time range, users, days, interactions, terms, repeated texts.

Totals that other rows need come from scalar subqueries or from windows over tables that are
small by nature, never from a window over posts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepost import fixed
from tidepost.functions.columns import in_dates, month_of, percent
from tidepost.functions.text import (
    mentions,
    normalize_for_dup,
    text_length,
    tokenize,
    word_count,
)
from tidepost.operators.counts import (
    count_histogram,
    distribution,
    median_of_counts,
    with_running_total,
)
from tidepost.operators.lookup import BROADCAST_BYTES, measured_bytes
from tidepost.operators.shape import compute_once, rows_of
from tidepost.session import materialize


def _rows() -> Column:
    return F.count(F.lit(1))


def with_time_parts(df: DataFrame, ts: str) -> DataFrame:
    """Date, hour, weekday name, month and year of a timestamp; null stays null."""
    return df.withColumns(
        {
            "date": F.to_date(ts),
            "hour": F.hour(ts),
            "weekday": F.date_format(ts, "EEEE"),
            "month": month_of(ts),
            "year": F.year(ts),
        }
    )


def range_summary(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """One row: first and last time, whole 24-hour days between, rows, sum and mean of an amount."""
    return df.agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.timestamp_diff("DAY", F.min(ts), F.max(ts)).alias("days"),
        F.count(ts).alias("valid_rows"),
        _rows().alias("rows"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("mean_amount"),
    )


def filter_effect(df: DataFrame, keep: Column) -> DataFrame:
    """One row: rows before and after a filter, removed rows and their percentage."""
    return (
        df.agg(_rows().alias("rows_before"), F.count_if(keep).alias("rows_after"))
        .withColumn("removed", F.col("rows_before") - F.col("rows_after"))
        .withColumn("removed_pct", percent(F.col("removed"), F.col("rows_before")))
    )


# Users


def _posts_per_user(df: DataFrame, user: str) -> DataFrame:
    """How many users have each number of posts; posts without a user are one flagged key."""
    per_user = df.groupBy(user).agg(_rows().alias("posts"))
    return count_histogram(
        per_user.select("posts", F.col(user).isNotNull().alias("known")), "posts", "known"
    )


def user_activity(df: DataFrame, user: str) -> DataFrame:
    """One row: posts, users, mean, median and maximum per user, users above 50 and 100 posts."""
    return _activity(_posts_per_user(df, user))


def _activity(hist: DataFrame) -> DataFrame:
    hist = hist.withColumn("_users", F.when(F.col("known"), F.col("keys")))
    return with_running_total(hist, "posts", "_users").agg(
        F.sum(F.col("posts") * F.col("keys")).alias("posts"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("keys"))), F.lit(0)).alias("users"),
        F.max(F.when(F.col("known"), F.col("posts"))).alias("max_posts"),
        *[
            F.coalesce(
                F.sum(F.when(F.col("known") & (F.col("posts") > n), F.col("keys"))), F.lit(0)
            ).alias(f"users_over_{n}")
            for n in (50, 100)
        ],
        median_of_counts("posts").alias("median_posts"),
    ).withColumn("mean_posts", F.when(F.col("users") > 0, F.col("posts") / F.col("users")))


def top_share(df: DataFrame, user: str, fraction: float = 0.01) -> DataFrame:
    """One row: the most active ``fraction`` of users (at least one) and their share of all posts.

    The users are never ranked: the table of counts is walked from the top, and of the count at
    the border only as many users are taken as are still missing.
    """
    return _top_share(_posts_per_user(df, user), fraction)


def _top_share(hist: DataFrame, fraction: float = 0.01) -> DataFrame:
    known = F.when(F.col("known"), F.col("keys")).otherwise(0)
    from_top = Window.orderBy(F.desc("posts"), F.desc("known"))
    before = F.coalesce(
        F.sum(known).over(from_top.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    users = F.sum(known).over(Window.partitionBy())
    top = F.greatest(F.lit(1), F.floor(users * fraction))
    taken = F.greatest(F.lit(0), F.least(F.col("_known"), F.col("_top") - F.col("_before")))
    return (
        hist.withColumns({"_known": known, "_before": before, "_users": users, "_top": top})
        .agg(
            F.max("_users").alias("users"),
            F.max("_top").alias("top_users"),
            F.sum(taken * F.col("posts")).alias("top_posts"),
            F.sum(F.col("posts") * F.col("keys")).alias("posts"),
        )
        .withColumn("top_pct", percent(F.col("top_posts"), F.col("posts")))
    )


def top_users(df: DataFrame, user: str, n: int = 20, ts: str | None = None, day: str | None = None):
    """Most active users, overall or within one day."""
    rows = df.filter(F.col(user).isNotNull())
    if day is not None:
        rows = rows.filter(in_dates(ts, day, day))
    return distribution(rows, [user], n)


# Days and hours


def daily_counts(df: DataFrame, ts: str) -> DataFrame:
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("date"))
        .agg(_rows().alias("n"))
        .orderBy("date")
    )


def hourly_counts(df: DataFrame, ts: str) -> DataFrame:
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.hour(ts).alias("hour"))
        .agg(_rows().alias("n"))
        .orderBy("hour")
    )


def weekday_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows per weekday, Monday first, days without rows included."""
    day = F.weekday(ts)
    one = df.agg(*[F.count_if(day == i).alias(f"_d{i}") for i in range(7)])
    rows = [
        {"position": F.lit(i), "weekday": F.lit(name), "n": F.col(f"_d{i}")}
        for i, name in enumerate(fixed.WEEKDAYS)
    ]
    return rows_of(one, rows)


def top_days(df: DataFrame, ts: str, n: int = 5) -> DataFrame:
    return daily_counts(df, ts).orderBy(F.desc("n"), "date").limit(n)


def day_totals(df: DataFrame, ts: str, day: str, metrics: Sequence[str]) -> DataFrame:
    """Rows and sums of the metrics on one day."""
    rows = df.filter(in_dates(ts, day, day))
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(f"total_{m}") for m in metrics]
    return rows.agg(_rows().alias("rows"), *sums)


def top_posts(
    df: DataFrame,
    metric: str,
    n: int,
    columns: Sequence[str],
    ties: Sequence[str],
    where: Column | None = None,
    text: str | None = None,
    preview: int | None = None,
) -> DataFrame:
    """Posts with the largest metric, optionally under a condition and with a cut text listing."""
    rows = df if where is None else df.filter(where)
    rows = rows.orderBy(F.col(metric).desc_nulls_last(), *ties).limit(n).select(*columns)
    if text is not None and preview is not None:
        rows = rows.withColumn(text, F.substring(text, 1, preview))
    return rows


def month_coverage(df: DataFrame, ts: str) -> DataFrame:
    """First and last date with rows, per month."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(month_of(ts).alias("month"))
        .agg(F.to_date(F.min(ts)).alias("first_date"), F.to_date(F.max(ts)).alias("last_date"))
        .orderBy("month")
    )


def spike_context(
    df: DataFrame, ts: str, day: str, start: str, end: str, tail: float = fixed.TAIL_FACTOR
) -> DataFrame:
    """One row: rows on a day against the mean of the days with rows before and after it.

    ``tail`` says how far the days after must stay above those before to count as a tail. The
    mean of all days is the reference line.
    """
    date, n = F.col("date"), F.col("n")
    spike = F.lit(day).cast("date")
    inside = date.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    one = daily_counts(df, ts).agg(
        F.avg("n").alias("mean_all"),
        F.avg(F.when(inside & (date < spike), n)).alias("mean_before"),
        F.sum(F.when(inside & (date == spike), n)).alias("on_day"),
        F.avg(F.when(inside & (date > spike), n)).alias("mean_after"),
    )
    return one.withColumns(
        {
            "elevation_pct": F.when(
                F.col("mean_before") > 0, (F.col("on_day") / F.col("mean_before") - 1) * 100
            ),
            "has_tail": F.coalesce(
                F.col("mean_after") > F.col("mean_before") * tail, F.lit(False)
            ),
        }
    )


# Keywords


def category_counts(df: DataFrame, text: str, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Texts per keyword category and their percentage, in one pass; a text may count in several."""
    hits = [
        F.count_if(mentions(text, patterns)).alias(f"_c{i}")
        for i, patterns in enumerate(categories.values())
    ]
    one = df.agg(_rows().alias("_rows"), *hits)
    rows = [
        {
            "category": F.lit(name),
            "n": F.col(f"_c{i}"),
            "pct": percent(F.col(f"_c{i}"), F.col("_rows")),
        }
        for i, name in enumerate(categories)
    ]
    return rows_of(one, rows)


def _mention_counts(df: DataFrame, period: Column, key: str, flag: Column, name: str) -> DataFrame:
    return (
        df.groupBy(period.alias(name))
        .agg(F.count(key).alias("total"), F.count_if(flag).alias("flagged"))
        .withColumn("pct", percent(F.col("flagged"), F.col("total")))
        .orderBy(name)
    )


def mention_trend(
    df: DataFrame, ts: str, key: str, text: str, patterns: Sequence[str]
) -> DataFrame:
    """Per month: posts, posts that match one of the patterns, percentage."""
    return _mention_counts(df, month_of(ts), key, mentions(text, patterns), "month")


def mention_days(
    df: DataFrame,
    ts: str,
    key: str,
    text: str,
    patterns: Sequence[str],
    start: str | None = None,
    end: str | None = None,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """The same per day, within a range of dates or on listed dates."""
    rows = df.filter(in_dates(ts, start, end))
    if days is not None:
        rows = rows.filter(F.to_date(ts).isin([F.lit(d).cast("date") for d in days]))
    return _mention_counts(rows, F.to_date(ts), key, mentions(text, patterns), "date")


def top_mention_days(
    df: DataFrame, ts: str, key: str, text: str, patterns: Sequence[str], n: int = 5, **dates
) -> DataFrame:
    daily = mention_days(df, ts, key, text, patterns, **dates)
    return daily.orderBy(F.desc("flagged"), "date").limit(n)


def posts_of_top_mention_day(
    df: DataFrame,
    ts: str,
    key: str,
    text: str,
    patterns: Sequence[str],
    metric: str,
    n: int,
    columns: Sequence[str],
    preview: int | None = None,
    **dates,
) -> DataFrame:
    """Matching posts of the day with most matches, by metric; the day is a scalar subquery."""
    best = top_mention_days(df, ts, key, text, patterns, 1, **dates).select("date").scalar()
    where = (F.to_date(ts) == best) & mentions(text, patterns)
    return top_posts(df, metric, n, columns, [key], where, text, preview)


# Interactions


def with_interactions(df: DataFrame, reply: Column, quote: Column) -> DataFrame:
    """Flags reply, quote, any and standalone, and the number of interaction kinds."""
    reply, quote = F.coalesce(reply, F.lit(False)), F.coalesce(quote, F.lit(False))
    return df.withColumns(
        {
            "has_reply": reply,
            "has_quote": quote,
            "has_any": reply | quote,
            "standalone": ~(reply | quote),
            "interactions": reply.cast("int") + quote.cast("int"),
        }
    )


_KINDS = {
    "reply": "has_reply",
    "quote": "has_quote",
    "any": "has_any",
    "standalone": "standalone",
}


def interaction_structure(df: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Number and percentage of each kind of post; with a reference also its percentage and the
    gap to it in percentage points. Frames come from ``with_interactions``."""

    def shares(rows: DataFrame) -> DataFrame:
        counted = rows.agg(
            _rows().alias("rows"), *[F.count_if(F.col(c)).alias(k) for k, c in _KINDS.items()]
        )
        return counted.select(
            F.struct(
                *[F.col(k).alias(f"n_{k}") for k in _KINDS],
                *[percent(F.col(k), F.col("rows")).alias(f"pct_{k}") for k in _KINDS],
            ).alias("s")
        )

    one = shares(df)
    if reference is not None:
        one = one.withColumn("r", shares(reference).scalar())
    rows = []
    for kind in _KINDS:
        row = {"kind": F.lit(kind), "n": F.col(f"s.n_{kind}"), "pct": F.col(f"s.pct_{kind}")}
        if reference is not None:
            row["reference_pct"] = F.col(f"r.pct_{kind}")
            row["gap"] = row["pct"] - row["reference_pct"]
        rows.append(row)
    return rows_of(one, rows)


def interaction_distribution(df: DataFrame) -> DataFrame:
    """Posts per number of interaction kinds and their percentage."""
    counts = df.groupBy("interactions").agg(_rows().alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # three rows at most
    return counts.withColumn("pct", percent(F.col("n"), total)).orderBy("interactions")


# Repeated texts


def _digest(text: Column | str) -> Column:
    return F.sha2(text, 256)


def _long_texts(df: DataFrame, text: str, author: str, min_words: int) -> DataFrame:
    rows = df.select(F.col(text).alias("text"), F.col(author).alias("author"))
    norm = compute_once(rows, norm_text=normalize_for_dup("text")).drop("text")
    return norm.filter(word_count("norm_text") >= min_words)


def repeated_texts(
    df: DataFrame,
    text: str,
    author: str,
    min_words: int = fixed.MIN_REPEATED_WORDS,
    authors: int = fixed.COORDINATED_AUTHORS,
) -> DataFrame:
    """Groups of equal normalised texts: size, different authors, coordinated flag.

    Texts are grouped by their digest. Distinct authors are merged per digest and author first,
    so a text that went viral is spread over its authors and its group reaches one task as counts
    only. The groups are written once, while the frame is built; a second pass fetches the texts of
    those that have more than one copy.
    """
    long = _long_texts(df, text, author, min_words).withColumn("_digest", _digest("norm_text"))
    groups = materialize(
        long.groupBy("_digest")
        .agg(_rows().alias("copies"), F.count_distinct("author").alias("authors"))
        .filter(F.col("copies") > 1),
        "repeated",
    )
    known = groups.select("_digest")
    if measured_bytes(known) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    texts = (
        long.join(known, "_digest", "left_semi")
        .groupBy("_digest")
        .agg(F.first("norm_text").alias("norm_text"))
    )
    return groups.join(texts, "_digest").select(
        "norm_text", "copies", "authors", (F.col("authors") >= authors).alias("coordinated")
    )


def top_repeated_texts(
    df: DataFrame, text: str, author: str, n: int = 10, preview: int | None = None, **options
) -> DataFrame:
    groups = repeated_texts(df, text, author, **options)
    rows = groups.orderBy(F.desc("copies"), "norm_text").limit(n)
    return rows if preview is None else rows.withColumn(
        "norm_text", F.substring("norm_text", 1, preview)
    )


def repeated_totals(
    df: DataFrame, text: str, author: str, min_words: int = fixed.MIN_REPEATED_WORDS
) -> DataFrame:
    """One row: all posts, long posts, repeated texts, posts in them and their percentage of all."""
    norm = compute_once(df.select(F.col(text).alias("text")), norm_text=normalize_for_dup("text"))
    norm_text = F.col("norm_text")
    sizes = (
        norm.select(F.when(word_count(norm_text) >= min_words, _digest(norm_text)).alias("digest"))
        .groupBy("digest")
        .agg(_rows().alias("copies"))
    )
    return _repeated(sizes)


def _repeated(sizes: DataFrame) -> DataFrame:
    """The totals from ``digest`` (null for short texts) and ``copies``."""
    long = F.col("digest").isNotNull()
    repeated = long & (F.col("copies") > 1)
    return sizes.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("posts"),
        F.coalesce(F.sum(F.when(long, F.col("copies"))), F.lit(0)).alias("long_posts"),
        F.count_if(repeated).alias("repeated_texts"),
        F.coalesce(F.sum(F.when(repeated, F.col("copies"))), F.lit(0)).alias("repeated_posts"),
    ).withColumn("repeated_pct", percent(F.col("repeated_posts"), F.col("posts")))


# Texts and terms


def text_statistics(df: DataFrame, text: str, short: int = fixed.MIN_TOKENS) -> DataFrame:
    """One row: mean length, median words, texts with fewer than ``short`` words."""
    sizes = df.groupBy(word_count(text).alias("words")).agg(
        _rows().alias("texts"), F.sum(text_length(text).cast("bigint")).alias("chars")
    )
    return _text_statistics(sizes, short)


def _text_statistics(sizes: DataFrame, short: int = fixed.MIN_TOKENS) -> DataFrame:
    return with_running_total(sizes, "words", "texts").agg(
        F.sum("texts").alias("texts"),
        (F.sum("chars") / F.sum("texts")).alias("mean_length"),
        F.coalesce(F.sum(F.when(F.col("words") < short, F.col("texts"))), F.lit(0)).alias(
            "short_texts"
        ),
        median_of_counts("words").alias("median_words"),
    )


def _terms(df: DataFrame, text: str, stopwords: Sequence[str]) -> DataFrame:
    """One row per term. The outer form keeps Spark from tokenising twice to skip empty texts."""
    terms = df.select(F.explode_outer(tokenize(text, stopwords)).alias("term"))
    return terms.filter(F.col("term").isNotNull())


def term_counts(df: DataFrame, text: str, stopwords: Sequence[str] = ()) -> DataFrame:
    """How often each term occurs."""
    return _terms(df, text, stopwords).groupBy("term").agg(_rows().alias("n"))


def term_baseline(
    counts: DataFrame, baseline: DataFrame, text: str, stopwords: Sequence[str] = ()
) -> DataFrame:
    """Attach to each term how often it occurs in a baseline, 0 where it does not."""
    base = term_counts(baseline, text, stopwords).withColumnRenamed("n", "base_n")
    return counts.join(base, "term", "left").withColumn("base_n", F.coalesce("base_n", F.lit(0)))


def term_lift(
    target: DataFrame,
    baseline: DataFrame,
    text: str,
    stopwords: Sequence[str] = (),
    top: int = 100,
    min_count: int = 5,
) -> DataFrame:
    """Most frequent terms of the target with their rate per 1,000 terms against the baseline.

    A term that the baseline lacks is new and has infinite lift. Each text is tokenised once: the
    baseline is counted by top term, all its other terms together, against a broadcast of at most
    ``top`` rows, and its total is the sum of those counts.
    """
    counts = term_counts(target, text, stopwords)
    best = counts.orderBy(F.desc("n"), "term").limit(top).filter(F.col("n") >= min_count)
    listed = best.select("term", F.col("term").alias("_listed"))
    base = (
        _terms(baseline, text, stopwords)
        .join(F.broadcast(listed), "term", "left")
        .groupBy("_listed")
        .agg(_rows().alias("base_n"))
        .withColumn("_base_total", F.sum("base_n").over(Window.partitionBy()))
    )
    whole = base.agg(F.max("_base_total")).scalar()
    total = counts.agg(F.sum("n")).scalar()
    rate, base_rate = F.col("rate"), F.col("base_rate")
    base_n = F.coalesce("base_n", F.lit(0))
    return (
        best.join(F.broadcast(base), F.col("term") == F.col("_listed"), "left")
        .withColumn("_whole", F.coalesce("_base_total", whole, F.lit(0)))
        .select(
            "term",
            "n",
            base_n.alias("base_n"),
            (F.col("n") / total * 1000).alias("rate"),
            F.when(F.col("_whole") > 0, base_n / F.col("_whole") * 1000)
            .otherwise(0.0)
            .alias("base_rate"),
        )
        .withColumn("is_new", base_rate == 0)
        .withColumn("lift", F.when(base_rate > 0, rate / base_rate).otherwise(float("inf")))
        .orderBy(F.desc("lift"), F.desc("n"), "term")
    )


# Findings


def findings(
    df: DataFrame,
    ts: str,
    user: str,
    text: str,
    lang: str,
    reply: Column,
    quote: Column,
) -> DataFrame:
    """The main figures of the exploration as one row, put together from scalar subqueries.

    Posts are read twice: once for a narrow table of counts by text digest, language and number of
    words, and once for how many users have each number of posts. Both are written while the frame
    is built.
    """

    def struct_of(one_row: DataFrame) -> Column:
        return one_row.select(F.struct(*one_row.columns)).scalar()

    rows = with_interactions(df, reply, quote).select(
        F.col(ts).alias("ts"),
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        *[F.col(c).alias(f"_{k}") for k, c in _KINDS.items()],
    )
    norm = compute_once(rows, norm_text=normalize_for_dup("text"))
    long = word_count("norm_text") >= fixed.MIN_REPEATED_WORDS
    facts = (
        norm.withColumn("digest", F.when(long, _digest("norm_text")))
        .groupBy("digest", "lang", word_count("text").alias("words"))
        .agg(
            _rows().alias("n"),
            F.sum(text_length("text").cast("bigint")).alias("chars"),
            F.min("ts").alias("first"),
            F.max("ts").alias("last"),
            *[F.count_if(F.col(f"_{k}")).alias(f"_{k}") for k in _KINDS],
        )
    )
    facts = materialize(facts, "findings")
    posts = F.sum("n")
    base = facts.agg(
        F.coalesce(posts, F.lit(0)).alias("posts"),
        F.to_date(F.min("first")).alias("first_date"),
        F.to_date(F.max("last")).alias("last_date"),
        F.timestamp_diff("DAY", F.min("first"), F.max("last")).alias("days"),
        *[F.coalesce(F.sum(f"_{k}"), F.lit(0)).alias(f"_{k}") for k in _KINDS],
    )
    by_digest = facts.groupBy("digest").agg(posts.alias("copies"))
    by_words = facts.groupBy("words").agg(posts.alias("texts"), F.sum("chars").alias("chars"))
    by_lang = facts.filter(F.col("lang").isNotNull()).groupBy("lang").agg(posts.alias("n"))
    all_known = F.sum("n").over(Window.partitionBy())  # a row for each language
    languages = by_lang.withColumn("percent", F.col("n") / all_known * 100)
    per_user = materialize(_posts_per_user(df, user), "posts-per-user")
    return base.withColumns(
        {
            "_users": struct_of(_activity(per_user).select("users", "users_over_100")),
            "_top": struct_of(_top_share(per_user).select("top_users", "top_pct")),
            "_repeated": struct_of(
                _repeated(by_digest).select("repeated_texts", "repeated_posts", "repeated_pct")
            ),
            "_text": struct_of(_text_statistics(by_words)),
            "_lang": struct_of(
                languages.orderBy(F.desc("n"), "lang").limit(1).select("lang", "percent")
            ),
        }
    ).select(
        "posts",
        "first_date",
        "last_date",
        "days",
        *[percent(F.col(f"_{k}"), F.col("posts")).alias(f"{k}_pct") for k in _KINDS],
        F.col("_users.users").alias("users"),
        F.col("_users.users_over_100").alias("users_over_100"),
        F.col("_top.top_users").alias("top_users"),
        F.col("_top.top_pct").alias("top_pct"),
        F.col("_repeated.repeated_texts").alias("repeated_texts"),
        F.col("_repeated.repeated_posts").alias("repeated_posts"),
        F.col("_repeated.repeated_pct").alias("repeated_pct"),
        F.col("_text.mean_length").alias("mean_length"),
        F.col("_text.median_words").alias("median_words"),
        F.col("_text.short_texts").alias("short_texts"),
        F.col("_lang.lang").alias("main_lang"),
        F.col("_lang.percent").alias("main_lang_pct"),
    )

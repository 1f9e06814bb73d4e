"""Aggregates against plain Python on small or skewed data."""

import random
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepost.operators import counts, evaluate, explore, reports


@pytest.fixture(scope="module")
def posts(spark):
    """Posts of few users, one of whom wrote a third of them; some have no user."""
    rng = random.Random(11)
    rows = []
    for i in range(4000):
        user = "hot" if i % 3 == 0 else None if i % 40 == 1 else f"u{int(rng.paretovariate(0.6)) % 300}"
        text = "copied text " * 6 if i % 3 == 0 else f"word{i % 500} " * rng.randrange(0, 15)
        rows.append((i, user, text, rng.choice(["en", "en", "fr", None])))
    return spark.createDataFrame(rows, "id int, user string, text string, lang string").cache()


def test_user_activity_and_top_share(posts):
    rows = posts.collect()
    per_user = Counter(r["user"] for r in rows if r["user"] is not None)
    got = explore.user_activity(posts, "user").first()
    assert got["posts"] == 4000 and got["users"] == len(per_user)
    assert got["max_posts"] == max(per_user.values())
    assert got["median_posts"] == statistics.median(per_user.values())
    assert got["users_over_50"] == sum(n > 50 for n in per_user.values())
    for fraction in (0.01, 0.1, 0.5, 1.0):
        top = max(1, int(len(per_user) * fraction))
        best = sum(sorted(per_user.values(), reverse=True)[:top])
        share = explore.top_share(posts, "user", fraction).first()
        assert (share["top_users"], share["top_posts"]) == (top, best)
        assert share["top_pct"] == pytest.approx(best / 4000 * 100)


def test_no_users_at_all(posts):
    empty = posts.filter("user is null")
    got = explore.user_activity(empty, "user").first()
    assert (got["users"], got["max_posts"], got["median_posts"]) == (0, None, None)
    assert explore.top_share(empty, "user").first()["top_posts"] == 0


def test_rows_without_a_label_are_counted_but_not_averaged(frame):
    df = frame([("a", 1, 2.0), ("a", 0, 4.0), (None, 1, 9.0)], "label string, irony int, x double")
    grouped = reports.irony_by_label(df, "irony", "label", {0: "no", 1: "yes"}).collect()
    assert sum(r["count"] for r in grouped) == 3 and None in {r["label"] for r in grouped}
    assert [(r["label"], r["mean"]) for r in counts.mean_by(df, "label", ["x"]).collect()] == [("a", 3.0)]
    assert [(r["label"], r["median"]) for r in counts.median_by(df, "label", ["x"]).collect()] == [("a", 3.0)]


@pytest.mark.parametrize("kind", ["ints", "heavy", "floats", "pair"])
def test_exact_median(spark, kind):
    rng = random.Random(3)
    draw = {
        "ints": lambda: float(rng.randrange(100)),
        "heavy": lambda: 5.0 if rng.random() < 0.4 else rng.paretovariate(0.3),
        "floats": lambda: rng.gauss(0, 1e6),
        "pair": lambda: rng.choice([1.0, 2.0]),
    }[kind]
    rows = [(rng.choice("abcd"), draw(), draw() if rng.random() < 0.9 else None)
            for _ in range(30_001)]
    rows += [("single", 3.0, None), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(7)
    wanted = defaultdict(list)
    for k, x, y in rows:
        for metric, value in (("x", x), ("y", y)):
            if k is not None and value is not None:
                wanted[k, metric].append(value)
    got = {(r["k"], r["metric"]): r["median"] for r in counts.median_by(df, "k", ["x", "y"]).collect()}
    assert got == {key: statistics.median(v) for key, v in wanted.items()}
    approx = counts.median_by(df, "k", ["x"], approx=True).collect()
    assert len(approx) == 5


@pytest.mark.parametrize("values", [[1, 2, 3, 4, 100], [5, 5, 5], [0.1 * i for i in range(997)]])
def test_histogram_matches_numpy(frame, values):
    df = frame([(float(v),) for v in values] + [(None,)], "x double")
    got = counts.histogram(df, "x", 10).collect()
    n, edges = np.histogram(values, bins=10)
    assert [r["n"] for r in got] == n.tolist()
    np.testing.assert_allclose([r["bin_start"] for r in got], edges[:-1])


def test_distribution_shares(posts):
    wanted = Counter(r["lang"] for r in posts.collect())
    for few in (False, True):
        rows = counts.distribution(posts, ["lang"], share=True, few_values=few).collect()
        assert {r["lang"]: r["count"] for r in rows} == wanted
        assert sum(r["percent"] for r in rows) == pytest.approx(100)


def test_profile(frame):
    df = frame([(1, "a"), (2, None), (2, None)], "n int, t string")
    got = {r["column"]: tuple(r)[1:] for r in counts.profile(df).collect()}
    assert got == {"n": ("int", 3, 0, 0.0, 2), "t": ("string", 1, 2, 66.67, 1)}


def test_bucket_tables_show_empty_cells(frame):
    df = frame([("a", 0.5), ("a", 1.2), ("b", 0.96), (None, 0.1), ("b", None)], "l string, c double")
    rows = reports.bucket_distribution(df, "c").orderBy("position").collect()
    assert [r["count"] for r in rows] == [2, 0, 0, 0, 1]
    cells = {(r["l"], r["bucket"]): r["count"] for r in reports.label_by_bucket(df, "l", "c").collect()}
    assert len(cells) == 10 and cells["a", "<50%"] == 1 and cells["b", ">95%"] == 1
    assert sum(cells.values()) == 2


def test_kpi_of_nothing_is_zero(frame):
    df = frame([], "l string, c double, i int")
    row = reports.kpi_row(df, "l", ["a"], "c", "i").first()
    assert (row["total"], row["pct_a"], row["n_irony"], row["pct_irony"]) == (0, 0.0, 0, 0.0)


def test_alert_at_the_threshold(frame):
    rows = [("2024-01-01", x) for x in "aaabbbbbbb"] + [("2024-02-01", x) for x in "abbb"]
    rows += [("2024-03-01", "z")]
    df = frame(rows, "d string, l string").withColumn("ts", F.to_timestamp("d"))
    got = reports.monthly_share(df, "ts", "l", ["a", "b"], "a").collect()
    assert [(r["month"], r["a"], r["total"], r["alert"]) for r in got] == [
        ("2024-01", 3, 10, True),
        ("2024-02", 1, 4, False),
        ("2024-03", 0, 0, False),
    ]


def test_classification_report_by_hand(frame):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 3 + [("b", "b")] * 2 + [("b", "a")] + [("c", "a")]
    df = frame(pairs, "y string, p string")
    got = {r["label"]: tuple(r)[1:] for r in
           evaluate.classification_report(df, "y", "p", ["a", "b", "c"]).collect()}
    assert got["a"] == pytest.approx((5 / 7, 5 / 8, 10 / 15, 8))
    assert got["b"] == pytest.approx((2 / 5, 2 / 3, 0.5, 3))
    assert got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"][0] == pytest.approx(7 / 12)
    assert got["macro avg"][2] == pytest.approx((10 / 15 + 0.5) / 3)
    assert got["weighted avg"][1] == pytest.approx(7 / 12)


def test_repeated_texts_with_a_viral_one(posts):
    groups = explore.repeated_texts(posts, "text", "user").collect()
    hot = max(groups, key=lambda r: r["copies"])
    assert hot["norm_text"].startswith("copied text") and hot["authors"] == 1
    assert hot["copies"] == sum(1 for r in posts.collect() if r["text"].startswith("copied"))
    totals = explore.repeated_totals(posts, "text", "user").first()
    assert totals["repeated_posts"] == sum(r["copies"] for r in groups)
    assert totals["repeated_texts"] == len(groups) and totals["posts"] == 4000


def test_coordinated_flag_needs_five_authors(frame):
    text = "one two three four five six seven eight nine ten"
    rows = [(f"u{i}", text + f" http://l.x/{i}") for i in range(5)] + [("u0", text.upper())]
    rows += [("u1", "short text"), ("u2", "short text"), (None, "x " + text), ("u3", "x " + text)]
    got = {r["copies"]: r for r in
           explore.repeated_texts(frame(rows, "user string, text string"), "text", "user").collect()}
    assert (got[6]["authors"], got[6]["coordinated"]) == (5, True)
    assert (got[2]["authors"], got[2]["coordinated"]) == (1, False)


def test_term_lift_marks_new_terms(frame):
    target = frame([("alpha alpha alpha alpha alpha beta beta beta beta beta rare",)], "text string")
    base = frame([("alpha gamma gamma gamma",), (None,)], "text string")
    got = {r["term"]: r for r in explore.term_lift(target, base, "text").collect()}
    assert set(got) == {"alpha", "beta"}
    assert got["alpha"]["lift"] == pytest.approx((5 / 11) / (1 / 4))
    assert got["beta"]["is_new"] and got["beta"]["lift"] == float("inf")
    nothing = explore.term_lift(target, base.filter("text = ''"), "text").collect()
    assert all(r["is_new"] and r["base_rate"] == 0.0 for r in nothing) and len(nothing) == 2


def test_spike_context(frame):
    days = {"2024-01-01": 10, "2024-01-03": 20, "2024-01-04": 60, "2024-01-05": 24, "2024-02-01": 6}
    rows = [(f"{d} 12:00:00",) for d, n in days.items() for _ in range(n)]
    df = frame(rows, "d string").withColumn("ts", F.to_timestamp("d"))
    got = explore.spike_context(df, "ts", "2024-01-04", "2024-01-01", "2024-01-10").first()
    assert (got["mean_before"], got["on_day"], got["mean_after"]) == (15.0, 60, 24.0)
    assert got["elevation_pct"] == pytest.approx(300) and got["has_tail"]
    assert got["mean_all"] == 24.0
    none = explore.spike_context(df, "ts", "2024-01-02", "2024-01-02", "2024-01-02").first()
    assert none["on_day"] is None and none["has_tail"] is False


def test_weekdays_without_posts_are_listed(frame):
    df = frame([("2024-01-01 10:00:00",), ("2024-01-07 10:00:00",)], "d string")
    got = explore.weekday_counts(df.withColumn("ts", F.to_timestamp("d")), "ts").collect()
    assert [(r["weekday"], r["n"]) for r in got][::6] == [("Monday", 1), ("Sunday", 1)]
    assert len(got) == 7


def test_days_are_whole_24_hours(frame):
    df = frame([("2024-01-01 23:00:00", 1), ("2024-01-03 22:00:00", None)], "d string, v int")
    got = explore.range_summary(df.withColumn("ts", F.to_timestamp("d")), "ts", "v").first()
    assert (got["days"], got["rows"], got["total_amount"]) == (1, 2, 1)


def test_stage_counts_and_observation(spark, posts):
    rows = counts.stage_counts({"all": posts, "en": posts.filter("lang = 'en'")}).collect()
    assert [(r["position"], r["stage"]) for r in rows] == [(0, "all"), (1, "en")]
    watched, watch = counts.observed(posts, "posts")
    watched.write.format("noop").mode("overwrite").save()
    assert watch.get["rows"] == 4000


def test_histogram_leaves_out_what_is_no_number(frame):
    values = [0.0, 1.0, 2.0, float("nan"), float("inf"), float("-inf"), None]
    df = frame([(v,) for v in values], "x double")
    rows = counts.histogram(df, "x", 2).collect()
    assert [(r.bin, r.n) for r in rows] == [(0, 1), (1, 2)]

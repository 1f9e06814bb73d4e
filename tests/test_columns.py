"""Typed columns, labels, buckets and scores on hand-made values."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepost.functions import columns as c
from tidepost.functions import scores as s
from tidepost.functions.times import parse_time
from tidepost.operators import shape
from tidepost.operators.reports import report_filter
from tidepost.plans.export import coerce_export, export_frame
from tidepost.plans.ingest import with_flags


def test_booleans(column):
    texts = [" TRUE ", "1", "yes", "", None, "x", "0", "False"]
    assert column(texts, c.to_bool("x")) == [True] * 3 + [False] * 5
    strict = [True, True, None, None, None, None, False, False]
    assert column(texts, c.to_bool_strict("x")) == strict


def test_missing_flag_is_false(frame):
    df = with_flags(frame([("true",)], "isReply string"), {"isReply": "r", "isQuote": "q"})
    assert df.select("r", "q").first() == (True, False)


def test_numbers(column):
    texts = ["12", "12.5", "abc", "", None, " 7 ", "NaN", "9007199254740993", "-3.9"]
    assert column(texts, c.to_long("x")) == [
        12, 12, None, None, None, 7, None, 9007199254740993, -3,
    ]
    assert column(texts, c.number_or_zero("x"))[:5] == [12.0, 12.5, 0.0, 0.0, 0.0]


def test_times(column):
    texts = ["2024-01-31 23:59:59", "2024-01-31T10:00:00Z", "31/01/2024", "bad", None]
    moment = dt.datetime(2024, 1, 31, 23, 59, 59)
    got = column(texts, F.date_format(parse_time("x", ["dd/MM/yyyy"]), "yyyy-MM-dd HH"))
    assert got == [moment.strftime("%Y-%m-%d %H"), "2024-01-31 10", "2024-01-31 00", None, None]


def test_date_range_has_both_ends(column):
    texts = ["2024-01-01 00:00:00", "2024-01-03 23:59:59.9", "2024-01-04", "2023-12-31", None]
    ts = F.col("x").cast("timestamp")
    kept = column(texts, F.coalesce(c.in_dates(ts, "2024-01-01", "2024-01-03"), F.lit(False)))
    assert kept == [True, True, False, False, False]


def test_labels(column):
    labels = ["negative", "neutral", "positive"]
    texts = ["negative", "positive", "other", None]
    assert column(texts, c.encode_label("x", labels)) == [0, 2, -1, -1]
    assert column(texts, c.decode_label(c.encode_label("x", labels), labels)) == [
        "negative", "positive", None, None,
    ]
    assert column(["a", "b", None], c.display_label("x", {"a": "A"})) == ["A", "Unknown", "Unknown"]


def test_buckets_are_closed_on_the_right(column):
    texts = ["0", "0.5", "0.51", "0.7", "0.85", "0.95", "1", "1.01", "-0.1", None]
    x = F.col("x").cast("double")
    assert column(texts, c.bucketize(x)) == [
        "<50%", "<50%", "50-70%", "50-70%", "70-85%", "85-95%", ">95%", None, None, None,
    ]


def test_author_and_engagement(frame, column):
    urls = ["https://x.com/ann/status/1", "https://x.com/ann", None, "https://x.com/a.b/status"]
    assert column(urls, c.author_of("x")) == ["ann", None, None, "a.b"]
    df = frame([(1, None, 3), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(c.engagement("a", "b", "c")).collect()] == [4, 0]


def test_resolution(frame):
    rows = [("positive", 1), ("neutral", 1), ("negative", 1), ("positive", 0), (None, 1)]
    df = frame(rows, "s string, i int")
    got = df.select(c.resolve_sentiment("s", "i", ["positive", "neutral"], "negative")).collect()
    assert [r[0] for r in got] == ["negative"] * 3 + ["positive", None]


def test_scores_match_numpy(frame):
    rng = np.random.default_rng(1)
    logits = np.vstack([rng.normal(0, 20, (200, 3)), [[800, 800, 0], [0, 0, 0], [-900, 0, 900]]])
    df = frame([tuple(map(float, r)) for r in logits], "a double, b double, c double")
    probs = df.select(*[p.alias(n) for p, n in zip(s.softmax(["a", "b", "c"]), "abc", strict=True)])
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    p = e / e.sum(axis=1, keepdims=True)
    np.testing.assert_allclose(np.array(probs.collect()), p, rtol=1e-12)
    got = probs.select(
        s.best_label("abc", ["x", "y", "z"]), s.confidence("abc"), s.margin("abc"), s.entropy("abc")
    ).collect()
    ranked = np.sort(p, axis=1)[:, ::-1]
    assert [r[0] for r in got] == [["x", "y", "z"][i] for i in p.argmax(axis=1)]
    np.testing.assert_allclose([r[1] for r in got], p.max(axis=1))
    np.testing.assert_allclose([r[2] for r in got], ranked[:, 0] - ranked[:, 1], atol=1e-15)
    np.testing.assert_allclose(
        [r[3] for r in got], -(p * np.log(p + 1e-12)).sum(axis=1), atol=1e-12
    )


def test_tie_takes_the_first_label(frame):
    df = frame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4)], "a double, b double, c double")
    assert [r[0] for r in df.select(s.best_label("abc", ["x", "y", "z"])).collect()] == ["x", "y"]


def test_shapes(frame):
    a = frame([(1, "x", 2.0)], "id int, t string, p double")
    b = frame([("y", 2)], "t string, id int")
    left, right = shape.align(a, b)
    assert left.columns == right.columns == ["id", "t"]
    assert shape.union_all([a, b]).filter("id = 2").first()["p"] is None
    assert shape.drop_present(a, ["p", "q"]).columns == ["id", "t"]
    assert shape.first_available(a, ["text_clean", "t"]) == "t"
    with pytest.raises(ValueError, match=r"\['q', 'r'\]"):
        shape.require(a, ["id", "q", "r"])
    with pytest.raises(ValueError):
        shape.project_map(a, {"absent": "x"})
    with pytest.raises(ValueError):
        shape.first_available(a, ["absent"])


def test_export_keeps_null_and_big_ids(frame):
    df = frame(
        [("18446744073709551616", None, "12", "TRUE", "n/a"), (None, "u" * 600, "x", "0", "0.5")],
        "id string, url string, likeCount string, is_reply string, model_confidence string",
    )
    first, second = export_frame(df).collect()
    assert first["tweet_id"] == "18446744073709551616" and first["url"] is None
    assert (first["like_count"], first["is_reply"], first["model_confidence"]) == (12, True, None)
    assert second["tweet_id"] is None and len(second["url"]) == 512
    assert (second["like_count"], second["is_reply"]) == (None, False)
    assert math.isclose(second["model_confidence"], 0.5)
    assert coerce_export(frame([(1,)], "other int")).columns == ["other"]


def test_report_filter_parts(frame):
    rows = [("a", "2024-01-01", 1), ("b", "2024-01-02", 0), ("a", "2024-01-03", 0)]
    df = frame(rows, "l string, d string, i int").withColumn("ts", F.col("d").cast("timestamp"))
    assert report_filter(df, "l", ["a"], "ts").count() == 2
    assert report_filter(df, "l", ["a", "b"], "ts", start="2024-01-02").count() == 2
    assert report_filter(df, "l", ["a", "b"], "ts", irony="i").count() == 1
    assert report_filter(df, "l", [], "ts").count() == 0


def test_times_as_scraped(column):
    texts = ["Fri Nov 24 17:49:36 +0000 2023", "24 Nov 2023 10:00:00", "2024/01/05 10:00",
             "Friday, 24 Nov 2023 10:00", "2023-11-24T10:00:00Z", "soon", "Frisbee", None,
             "Fri 24 Nov 2023 10:00:00 +0100"]
    got = column(texts, F.date_format(parse_time("x"), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2023-11-24 17:49:36", "2023-11-24 10:00:00", "2024-01-05 10:00:00",
                   "2023-11-24 10:00:00", "2023-11-24 10:00:00", None, None, None,
                   "2023-11-24 09:00:00"]
    own = column(texts[:1], parse_time("x", ["EEE MMM dd HH:mm:ss Z yyyy"]).cast("string"))
    assert own == ["2023-11-24 17:49:36"]

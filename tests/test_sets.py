"""Duplicates, joins, ranking, samples; hot keys, null keys and ties included."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepost.operators import ranking, sampling
from tidepost.operators.dedup import dedup, keep_best, removed_count
from tidepost.operators.lookup import attach_predictions, exclude_matches


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 rows; one key holds a third of them, and a sixth have no key."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 6 == 1 else f"k{rng.randrange(400)}"
        rows.append((i, key, rng.randrange(50), rng.random()))
    return spark.createDataFrame(rows, "id int, k string, m int, s double").repartition(6).cache()


def test_dedup_keeps_the_first_in_order(hot):
    rows = hot.collect()
    wanted = {}
    for r in sorted(rows, key=lambda r: (-r["m"], r["id"])):
        wanted.setdefault(r["k"], r["id"])
    got = {r["k"]: r["id"] for r in keep_best(hot, "k", "m", ["id"]).collect()}
    assert got == wanted and None in got
    counts = removed_count(hot, dedup(hot, ["k"], ["id"])).first()
    assert (counts["rows_before"], counts["rows_after"]) == (3000, len(wanted))


def test_missing_metric_counts_as_zero(frame):
    df = frame([(1, "a", None), (2, "a", -5), (3, "b", None)], "id int, k string, m int")
    assert {r["id"] for r in keep_best(df, "k", "m", ["id"]).collect()} == {1, 3}


@pytest.mark.parametrize("salts", [1, 8])
def test_anti_join_keeps_null_keys(hot, frame, salts):
    known = frame([("hot",), ("k1",), (None,), ("hot",)], "k string")
    wanted = {r["id"] for r in hot.collect() if r["k"] not in ("hot", "k1")}
    rest = exclude_matches(hot, known, "k", salts=salts)
    assert rest.columns == hot.columns
    assert sorted(r["id"] for r in rest.collect()) == sorted(wanted)


@pytest.mark.parametrize("salts", [1, 8])
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_predictions_do_not_multiply_rows(spark, hot, frame, salts, threshold):
    preds = frame(
        [("hot", 0.6, 1), ("hot", 0.9, 0), ("k1", 0.5, 1), ("k1", 0.5, 0), (None, 1.0, 1)],
        "k string, conf double, label int",
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = attach_predictions(hot, preds, "k", ["conf", "label"], salts).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(got) == 3000
    assert {(r["conf"], r["label"]) for r in got if r["k"] == "hot"} == {(0.9, 0)}
    assert {(r["conf"], r["label"]) for r in got if r["k"] == "k1"} == {(0.5, 1)}
    assert {r["conf"] for r in got if r["k"] is None} == {None}


def test_numbers_are_contiguous_in_order(hot):
    order = [F.col("k").asc_nulls_first(), F.desc("m"), "id"]
    got = ranking.number_rows(hot, order, "n").collect()
    wanted = sorted(hot.collect(), key=lambda r: (r["k"] is not None, r["k"] or "", -r["m"], r["id"]))
    assert [r["id"] for r in sorted(got, key=lambda r: r["n"])] == [r["id"] for r in wanted]
    assert sorted(r["n"] for r in got) == list(range(1, 3001))


def test_numbers_of_an_empty_frame(hot):
    assert ranking.number_rows(hot.filter("id < 0"), ["id"]).count() == 0


@pytest.mark.parametrize("n", [0, 1, 700, 2999, 5000])
def test_large_and_small_top_n_agree(hot, monkeypatch, n):
    order = [F.desc("m"), F.asc("id")]
    small = {r["id"] for r in ranking.top_n(hot, order, n).collect()}
    monkeypatch.setattr(ranking, "TOP_K_ROWS", -1)
    large = {r["id"] for r in ranking.top_n(hot, order, n).collect()}
    assert small == large and len(small) == min(n, 3000)


@pytest.mark.parametrize("n", [1, 50, 1500, 4000])
def test_most_uncertain_with_ties_and_nulls(frame, n):
    rng = random.Random(2)
    rows = []
    for i in range(2000):
        margin = 0.25 if i % 3 == 0 else None if i % 50 == 1 else round(rng.random(), 3)
        rows.append((i, margin, round(rng.random(), 1) if i % 7 else None))
    rows.append((5000, 1.0, 0.0))
    df = frame(rows, "id int, margin double, entropy double")
    big = float("inf")
    wanted = sorted(
        rows, key=lambda r: (big if r[1] is None else r[1], big if r[2] is None else -r[2], r[0])
    )[:n]
    got = ranking.most_uncertain(df, n, "margin", "entropy", ["id"]).collect()
    assert {r["id"] for r in got} == {r[0] for r in wanted}


def test_review_queue_puts_unknown_confidence_last(frame):
    df = frame([(1, None, True), (2, 0.9, True), (3, 0.1, True), (4, 0.0, False)],
               "id int, c double, f boolean")
    assert [r["id"] for r in ranking.review_queue(df, "f", "c", ["id"], 3).collect()] == [3, 2, 1]


def test_hash_split_is_disjoint_complete_and_stable(hot):
    train, evaluation = sampling.split_by_hash(hot, "id")
    a, b = ({r["id"] for r in part.collect()} for part in (train, evaluation))
    assert not a & b and len(a | b) == 3000
    assert 0.75 < len(a) / 3000 < 0.85
    again, _ = sampling.split_by_hash(hot.repartition(3, "m"), "id")
    assert {r["id"] for r in again.collect()} == a
    other, _ = sampling.split_by_hash(hot, "id", seed=7)
    assert {r["id"] for r in other.collect()} != a


def _split_counts(df, labels):
    rows = sampling.stratified_split(df, "l", "id", labels).collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return Counter((r["l"], r["split"]) for r in rows)


def test_stratified_split_shares_out_by_label(frame):
    rows = [(i, "a") for i in range(71)] + [(100 + i, "b") for i in range(23)]
    rows += [(200 + i, "c") for i in range(6)] + [(300, "other")]
    counts = _split_counts(frame(rows, "id int, l string"), ["a", "b", "c"])
    assert sum(n for (_, s), n in counts.items() if s == "eval") == math.ceil(0.2 * 100)
    for label, n in (("a", 71), ("b", 23), ("c", 6)):
        assert abs(counts[label, "train"] - 0.8 * n) < 1
        assert counts[label, "train"] + counts[label, "eval"] == n


@pytest.mark.parametrize("rows", [
    [(i, "a") for i in range(40)] + [(50, "b")] + [(60 + i, "c") for i in range(9)],
    [(i, "a") for i in range(40)] + [(60 + i, "c") for i in range(10)],
])
def test_split_ignores_labels_when_one_is_too_small(frame, rows):
    counts = _split_counts(frame(rows, "id int, l string"), ["a", "b", "c"])
    assert sum(n for (_, s), n in counts.items() if s == "eval") == 10


def test_fixed_sample_has_n_rows(hot):
    sample = {r["id"] for r in sampling.fixed_sample(hot, 100, "id").collect()}
    assert len(sample) == 100
    assert sample == {r["id"] for r in sampling.fixed_sample(hot.repartition(2), 100, "id").collect()}
    assert sampling.fixed_sample(hot, 10_000, "id").count() == 3000


def test_top_n_keeps_order_for_any_n(spark):
    df = spark.range(6000).repartition(7).withColumn("x", F.pmod(F.xxhash64("id"), F.lit(500)))
    rows = sorted((r.x, r.id) for r in df.collect())
    for n in (10, 1000, 1001, 2500):
        got = [(r.x, r.id) for r in ranking.top_n(df, ["x", "id"], n).collect()]
        assert got == rows[:n]


def test_nan_and_null_scores_come_last(frame):
    df = frame([(1, float("nan")), (2, 0.5), (3, 0.1), (4, None)], "id int, m double")
    for n, ids in ((1, [3]), (2, [3, 2]), (3, [3, 2, 1]), (4, [3, 2, 1, 4])):
        got = ranking.most_uncertain(df.withColumn("e", F.lit(0.0)), n, "m", "e", ["id"]).collect()
        assert [r.id for r in got] == ids


def test_null_keys_are_split_and_sampled(frame):
    rows = [(None if i % 10 == 0 else i, i, "ab"[i % 2]) for i in range(100)]
    df = frame(rows, "k int, i int, label string")
    split = sampling.stratified_split(df, "label", "k", ["a", "b"]).collect()
    assert len(split) == 100 and sum(r.split == "eval" for r in split) == 20
    train, test = sampling.split_by_hash(df, "k")
    assert train.count() + test.count() == 100
    assert len({r.i for r in sampling.fixed_sample(df, 95, "k").collect()}) == 95

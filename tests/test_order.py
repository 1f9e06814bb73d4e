"""Order statistics: what is written, what is sorted, and exact results in several rounds."""

import random
import statistics
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidepost.operators import counts, ranking, sampling
from tidepost.plans.active import head_cut
from tidepost.session import scratch_dir


@pytest.fixture
def written(spark):
    """Tables written below the scratch folder since the test began."""
    scratch = Path(scratch_dir(spark))
    before = set(scratch.iterdir())
    return lambda: [spark.read.parquet(str(p)) for p in set(scratch.iterdir()) - before]


@pytest.fixture
def posts(spark):
    rows = spark.range(30_000).withColumns(
        {
            "m": F.pmod(F.xxhash64("id"), F.lit(40)),
            "text": F.sha2(F.col("id").cast("string"), 512),
            "lang": F.when(F.col("id") % 3 > 0, "en"),
        }
    )
    return rows.repartition(6)


def test_numbering_writes_no_text(posts, written):
    got = ranking.number_rows(posts, [F.desc("m"), F.asc_nulls_last("lang"), "id"], "n")
    rows = posts.collect()
    wanted = sorted(rows, key=lambda r: (-r["m"], r["lang"] is None, r["id"]))
    assert [r["id"] for r in got.orderBy("n").collect()] == [r["id"] for r in wanted]
    assert written() and not [t for t in written() if "string" in dict(t.dtypes).values()]


def test_equal_rows_are_numbered(spark):
    df = spark.range(900).selectExpr("id % 7 as a", "cast(null as string) as b", "id % 2 as c")
    got = ranking.number_rows(df, ["a", "c"], "n", start=0).collect()
    assert sorted(r["n"] for r in got) == list(range(900))
    assert [(r["a"], r["c"]) for r in sorted(got, key=lambda r: r["n"])] == sorted(
        (i % 7, i % 2) for i in range(900)
    )


@pytest.mark.parametrize("n", [1_500, 12_000, 29_999, 40_000])
@pytest.mark.parametrize("small", [100, 100_000])
def test_cut_sorts_only_the_border(posts, written, monkeypatch, n, small):
    monkeypatch.setattr(ranking, "RANGE_ROWS", small)
    cut = head_cut(posts, F.col("m") % 2, ["m", "id"], n)
    wanted = sorted(posts.collect(), key=lambda r: (r["m"] % 2, r["m"], r["id"]))[:n]
    assert {r["id"] for r in cut.collect()} == {r["id"] for r in wanted}
    assert not [t for t in written() if "string" in dict(t.dtypes).values()]
    assert "rangepartitioning" not in plan_of(cut)


def test_cut_of_equal_rows(spark):
    df = spark.range(5000).selectExpr("id % 3 as a", "'x' as b")
    assert ranking.top_n(df, ["a"], 2500).groupBy("a").count().orderBy("a").collect() == [(0, 1667), (1, 833)]
    assert ranking.top_n(df, ["a"], 9000).count() == 5000


@pytest.mark.parametrize("kind", ["even", "skewed", "few", "large"])
def test_medians_in_rounds(spark, monkeypatch, written, kind):
    monkeypatch.setattr(counts, "RANKED_VALUES", 50)
    draw = random.Random(kind)
    make = {
        "even": lambda: draw.random(),
        "skewed": lambda: draw.choice([1.0, draw.lognormvariate(0, 6)]),
        "few": lambda: float(draw.randrange(40)),
        "large": lambda: draw.choice([-1, 1]) * 10.0 ** draw.randrange(-300, 300) * draw.random(),
    }[kind]
    rows = [("ab"[i % 5 == 0], make(), None if i % 4 else make()) for i in range(6001)] + [(None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {(r["k"], r["metric"]): r["median"] for r in counts.median_by(df, "k", ["x", "y"]).collect()}
    for k in "ab":
        for at, metric in ((1, "x"), (2, "y")):
            values = [r[at] for r in rows if r[0] == k and r[at] is not None]
            assert got[k, metric] == pytest.approx(statistics.median(values), rel=1e-12)
    last = [t for t in written() if "_below" in t.columns]
    sizes = [t.groupBy("k", "metric").count().agg(F.max("count")).first()[0] for t in last]
    assert min(sizes) <= 50


def test_no_task_orders_many_values(spark, written, monkeypatch):
    monkeypatch.setattr(counts, "RANKED_VALUES", 10_000)
    df = spark.range(1_000_000).selectExpr("'a' as k", "cast(hash(id) as double) as x")
    median = counts.median_by(df, "k", ["x"]).first()["median"]
    values = sorted(r[0] for r in df.select("x").collect())
    assert median == (values[499_999] + values[500_000]) / 2
    tables = [t for t in written() if "_below" in t.columns]
    assert min(t.count() for t in tables) <= 10_000 < max(t.count() for t in tables)


@pytest.mark.parametrize("ranked", [1, 20, 100_000])
def test_split_is_the_same_however_the_border_is_found(spark, monkeypatch, ranked):
    df = spark.range(4000).selectExpr("id", "if(id % 5 = 0, 'b', 'a') as label", "id % 9 as x")
    whole = {r["id"]: r["split"] for r in sampling.stratified_split(df, "label", "id", ["a", "b"]).collect()}
    monkeypatch.setattr(sampling, "_RANKED", ranked)
    again = {r["id"]: r["split"] for r in sampling.stratified_split(df, "label", "id", ["a", "b"]).collect()}
    assert again == whole and len(whole) == 4000
    assert sum(s == "eval" for s in whole.values()) == 800


def test_split_of_repeated_keys_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_RANKED", 10)
    df = spark.range(3000).selectExpr("cast(null as int) as k", "id % 11 as x", "if(id % 2 = 0, 'a', 'b') as label")
    rows = sampling.stratified_split(df, "label", "k", ["a", "b"]).collect()
    assert len(rows) == 3000 and sum(r["split"] == "eval" for r in rows) == 600


def test_rows_without_a_key(frame):
    from tidepost.operators.dedup import dedup

    df = frame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, i int")
    assert sorted(r["i"] for r in dedup(df, ["k"], ["i"]).collect()) == [1, 3]
    assert sorted(r["i"] for r in dedup(df, ["k"], ["i"], keep_null_keys=True).collect()) == [1, 2, 3]

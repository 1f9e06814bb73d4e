"""Many keywords in one pass, and dictionaries of any size."""

import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidepost.functions import text as t
from tidepost.operators import lookup
from tidepost.plans.ingest import clean_posts


def test_one_pattern_for_many_texts():
    draw = random.Random(1)
    for _ in range(300):
        letters = "ab" if draw.random() < 0.5 else "abc.[\\-é"
        words = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 5))) for _ in range(draw.randint(1, 20))]
        pattern = re.compile(t.any_of(words))
        for _ in range(20):
            text = "".join(draw.choice(letters + "x") for _ in range(draw.randint(0, 12)))
            assert bool(pattern.search(text)) == any(w in text for w in words), (words, text)


@pytest.mark.parametrize("count", [5, 200])
def test_keywords_are_the_same_in_one_pass(column, count):
    draw = random.Random(count)
    word = lambda n: "".join(draw.choice("abcd-é.") for _ in range(n))
    keywords = [word(draw.randint(1, 6)) for _ in range(count)]
    texts = [word(draw.randint(0, 30)).upper() for _ in range(300)] + [None, ""]
    lower = [None if x is None else x.lower() for x in texts]
    assert column(texts, t.contains_any("x", keywords)) == [
        None if x is None else any(k in x for k in keywords) for x in lower
    ]
    edge = r"[^\w]"
    tests = [re.compile(rf"(?:^|{edge}){re.escape(k)}(?:{edge}|$)") for k in keywords]
    got = column(texts, t.contains_word("x", keywords, ["a-b"]))
    assert got == [
        None if x is None else any(p.search(x) for p in tests) or "a-b" in x for x in lower
    ]


def test_many_keywords_cost_little_more_than_few(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    docs = docs.unionAll(docs).unionAll(docs).unionAll(docs).repartition(8).cache()
    docs.count()
    draw = random.Random(1)
    some = ["".join(draw.choice(string.ascii_lowercase) for _ in range(8)) for _ in range(1000)]

    def seconds(keywords):
        spent = []
        for _ in range(3):
            begin = time.perf_counter()
            docs.filter(t.contains_any("text", keywords)).count()
            spent.append(time.perf_counter() - begin)
        return min(spent)

    few, many = seconds(some[:10]), seconds(some)
    docs.unpersist()
    assert many < 3 * few + 1.0


def test_dictionary_beyond_a_plan(frame):
    entries = {f"word{i}": f"form {i}" for i in range(30_000)} | {"": "x", "gone": "", "éa": "ok"}
    assert t.dictionary_bytes(entries) > t.PLAN_BYTES
    with pytest.raises(ValueError, match="with_forms"):
        t.normalize_tokens("x", entries)
    rows = ["word7 and word29999", "gone", " éa  gone b", "word30000", "", None]
    df = lookup.with_forms(frame([(i, x) for i, x in enumerate(rows)], "i int, x string"), "x", entries)
    got = [r["x"] for r in df.orderBy("i").collect()]
    assert got == ["form 7 and form 29999", "", "ok   b", "word30000", "", None]
    assert df.columns == ["i", "x"] and len(df._jdf.queryExecution().toString()) < 20_000


def test_dictionary_of_a_million_entries(spark):
    entries = {f"w{i}": f"v{i}" for i in range(1_000_000)}
    docs = spark.range(20_000).select(
        F.concat_ws(" ", F.concat(F.lit("w"), F.col("id") * 50), F.lit("plain")).alias("x"), "id"
    )
    begin = time.perf_counter()
    df = lookup.with_forms(docs, "x", entries)
    assert df.filter(F.col("x") != F.concat(F.lit("v"), F.col("id") * 50, F.lit(" plain"))).count() == 0
    assert time.perf_counter() - begin < 90
    assert len(df._jdf.queryExecution().toString()) < 20_000


def test_posts_are_cleaned_with_a_large_dictionary(frame):
    entries = {f"word{i}": "x" for i in range(30_000)} | {"please": "do"}
    rows = frame([("1", "Please READ this long post about rain")], "id string, text string")
    got = clean_posts(rows, ["rain"], entries).first()
    assert (got["text_clean"], got["token_count"]) == ("do read this long post about rain", 7)


def test_filter_keeps_all_that_occur(spark):
    values = spark.range(3000).select(F.concat(F.lit("v"), "id").alias("v"))
    seen = values.filter("hash(v) % 3 = 0")
    bits = lookup.occurring(seen, "v", 1 << 18)
    kept = lookup.possible(values, "v", bits, 1 << 18)
    assert kept.columns == ["v"]
    assert kept.join(seen, "v", "left_semi").count() == seen.count()
    assert kept.count() < seen.count() + 100


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 100_000, 0])
def test_token_join_by_any_way(spark, limit):
    rows = [(i, " ".join(f"w{(i * k) % 900}" for k in range(1, 6))) for i in range(400)] + [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "i int, x string")
    words = spark.range(40_000).selectExpr("concat('w', id * 3) as token", "concat('v', id * 3) as form")
    got = lookup.normalize_tokens_join(docs, "x", words, broadcast_bytes=limit)
    form = lambda w: "v" + w[1:] if int(w[1:]) % 3 == 0 else w
    assert {r["i"]: r["x"] for r in got.collect()} == {
        i: x if not x else " ".join(form(w) for w in x.split(" ")) for i, x in rows
    }


def test_viral_text_is_split(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        viral = F.when(F.col("id") % 3 == 0, "the viral text").otherwise(F.concat(F.lit("text no "), "id"))
        docs = spark.range(60_000).select(viral.alias("x"), F.sha2(F.col("id").cast("string"), 512).alias("t")).repartition(8)
        words = spark.createDataFrame([("viral", "hot"), ("no", "number")], "token string, form string")
        got = lookup.normalize_tokens_join(docs, "x", words)
        assert got.filter("x = 'the hot text'").count() == 20_000
        got.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(got)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

"""Physical plans: what must not and what must be in them."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.views import LOOKUP, Views
from tests.conftest import plan_of
from tidepost.functions.columns import in_dates
from tidepost.functions.text import clean_text
from tidepost.operators.dedup import dedup
from tidepost.operators.lookup import attach_predictions, exclude_matches
from tidepost.operators.shape import compute_once
from tidepost.plans import labelling
from tidepost import session
from tidepost.session import scratch_scope
from tidepost.sources.files import load_results

FOLDER = "/root/testdata/sf0.001"
TEXT = ["p5_clean_text", "p12_normalize_tokens", "p15_tokenize", "ingest_clean_posts",
        "flagship_clean_counts", "a28_repeated_texts", "a31_term_lift", "j6_normalize_tokens_join"]


def before_running(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TEXT)
def test_text_work_stays_in_the_jvm(spark, name):
    plan = before_running(QUERIES[name](spark, FOLDER))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow", plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_products(spark, name):
    if name.startswith(("l3", "l4", "l7_irony_model", "l12", "s5", "s7", "s8")):
        pytest.skip("trains a model or writes tables")
    plan = before_running(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["p5_clean_text", "p4_word_filter", "p18_to_bool", "l6_softmax",
                                  "l7_irony_predictions", "p31_time_parts", "r1_split_by_hash"])
def test_row_wise_queries_do_not_sort_or_gather(spark, name):
    plan = before_running(QUERIES[name](spark, FOLDER))
    assert "SinglePartition" not in plan and "Sort [" not in plan.replace("SortMergeJoin", "")


def test_expensive_text_is_computed_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    once = compute_once(docs, text_clean=clean_text("text", LOOKUP))
    kept = dedup(once.filter(F.length("text_clean") > 5), ["text_clean"], ["doc_id"])
    assert before_running(kept.select("doc_id")).count("transform(") == 1


def test_dedup_prunes_before_the_shuffle(spark):
    plan = before_running(QUERIES["d1_dedup"](spark, FOLDER))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(id") < plan.index("Partial")


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in before_running(QUERIES["w3_top_days"](spark, FOLDER))


def test_date_filter_and_columns_reach_the_scan(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    rows = events.filter(in_dates("ts", "2024-01-05", "2024-01-06")).select("event_id")
    plan = plan_of(rows)
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
    results = load_results(events, ["event_id"], "ts")
    assert "PushedFilters: [IsNotNull(ts)]" in plan_of(results)


def test_posts_scan_reads_only_what_is_used(spark):
    posts = Views(spark, FOLDER).posts.select("id", "lang")
    plan = plan_of(posts)
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan
    assert "ReadSchema: struct<event_id:bigint>" in plan


@pytest.fixture
def merge_joins(spark):
    """No broadcasts, and a skew threshold that small test data can reach."""
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
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["anti", "left"])
def test_adaptive_execution_splits_a_hot_key(spark, merge_joins, kind):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    left = spark.range(60_000).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("t"))
    left = left.repartition(8)
    right = spark.range(100, 5000).select(F.col("id").alias("k"), F.rand(1).alias("c"))
    joined = (
        exclude_matches(left, right, "k") if kind == "anti"
        else attach_predictions(left, right, "k", ["c"])
    )
    rows = joined.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(joined)
    assert len(rows) == (60_000 if kind == "left" else 20_000 + 40_000 * 100 // 5000)


def test_rows_without_a_key_are_spread(spark, merge_joins):
    no_key = F.when(F.col("id") < 0, "k").alias("k")
    left = spark.range(20_000).select(no_key, "id").repartition(4)
    right = spark.range(10).select(F.col("id").cast("string").alias("k"))
    rest = exclude_matches(left, right, "k")
    sizes = rest.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 2_500


def test_user_statistics_aggregate_before_any_window(spark):
    plan = before_running(QUERIES["a17_top_share"](spark, FOLDER))
    assert plan.index("Window") < plan.index("hashpartitioning(posts")
    assert "partial_count" in plan[plan.index("hashpartitioning(o_custkey"):]


@pytest.mark.parametrize("name", ["j2_exclude_by_text", "a28_repeated_texts", "a28_repeated_totals",
                                  "w7_top_repeated_texts", "a34_findings"])
def test_texts_are_not_shuffle_keys(spark, name):
    plan = before_running(QUERIES[name](spark, FOLDER))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)
    assert keys and not [k for k in keys if re.search(r"\b(text|norm_text)#", k)]


def test_findings_are_put_together_from_written_counts(spark):
    plan = before_running(QUERIES["a34_findings"](spark, FOLDER))
    assert "findings-" in plan and "events.parquet" not in plan and "documents.parquet" not in plan


def test_keys_of_different_width_meet(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,)], "k bigint")
    assert [r["k"] for r in exclude_matches(left, right, "k").orderBy("k").collect()] == [None, 1]


def exchanged(df):
    """Columns that go through each shuffle of a plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", df._jdf.queryExecution().explainString(mode))


def test_pool_shuffles_digests_and_what_is_asked_for(spark, merge_joins, tmp_path, monkeypatch):
    """No text meets the baseline or the other copies, and the baseline is read once."""
    monkeypatch.setattr(labelling, "BROADCAST_BYTES", 0)
    path = str(tmp_path / "posts")
    number = F.col("id").cast("string")
    posts = spark.range(1000).select(
        "id",
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("u"), number)).alias("url"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), number)).alias("text"),
        (F.col("id") % 300).cast("string").alias("text_clean"),
    )
    posts.write.parquet(path)
    posts = spark.read.parquet(path)
    pool = labelling.unlabelled_pool(posts, posts.filter("id % 3 = 0"), ["id"])
    narrow = pool.select("id", "label_source")
    columns = exchanged(narrow)
    assert len(columns) >= 3 and not [c for c in columns if re.search(r"\b(text|text_clean|url)#", c)]
    assert before_running(pool).count("FileScan parquet [id") == 1
    rest = [i for i in range(1000) if (i % 3 or i % 10 == 0) and (i % 3 or i % 7 == 0)]
    wanted = {c: next(i for i in rest if i % 300 == c) for c in {i % 300 for i in rest}}
    assert sorted(r.id for r in narrow.collect()) == sorted(wanted.values())
    monkeypatch.undo()
    few = labelling.unlabelled_pool(posts, posts.filter("id % 3 = 0"), ["id"])
    assert before_running(few).count("BroadcastHashJoin") == 2
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, pool.collect()))


def test_sketched_medians_meet_their_rows_without_a_shuffle(spark, merge_joins):
    """Six keys would be six tasks that sort all rows."""
    plan = before_running(QUERIES["a10_median_approx"](spark, FOLDER))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name, header", [("s1_malformed_rows", "id,lang"), ("s1_headers", "id,url")])
def test_files_of_lines_are_written_by_many_tasks(spark, merge_joins, name, header):
    query = {"s1_headers": "s1_mixed_headers"}.get(name, name)
    with scratch_scope(spark):
        assert QUERIES[query](spark, FOLDER).collect()
        (path,) = [p for p in session._SCOPE.get() if re.search("malformed|mixed", p)]
        files = [f for f in Path(path).glob("part-*.txt") if f.stat().st_size]
        lines = [f.read_text().splitlines() for f in files]
    assert len(files) > 4 and all(x[0] == header and header not in x[1:] for x in lines)
    assert max(map(len, lines)) < sum(map(len, lines)) / 3


def _view_tables(spark, folder):
    """Tables with repeated, absent and null keys."""
    documents = [(i, f"text {i}", "en", "web") for i in range(40)] + [(3, "again", None, "web"), (None, "x", "en", "y")]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string").write.parquet(
        f"{folder}/documents.parquet"
    )
    events = [(i, i % 4, ["view", "click", "signup", None][i // 5 % 4], i / 3) for i in range(170)]
    events += [(15, 9, "view", 1.0), (None, 1, "view", 2.0)]
    rows = spark.createDataFrame(events, "event_id long, user_id long, event_type string, value double")
    rows.withColumn("ts", F.timestamp_seconds("event_id")).write.parquet(f"{folder}/events.parquet")
    labels = [(i, i % 2, i % 3) for i in range(0, 40, 3)] + [(3, 1, 1), (None, 1, 1), (6, None, None)]
    spark.createDataFrame(labels, "doc_id long, toxic long, quality long").write.parquet(f"{folder}/labels.parquet")
    vectors = [(i, [i / 9, 0.2, -i / 7, 0.1]) for i in range(9)] + [(4, [0.5, 0.5, 0.1, 0.0]), (None, [0.0] * 4), (11, None)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")


def test_views_join_what_is_narrow_first(spark, merge_joins, tmp_path):
    """Labelled and scored posts are those of a plain join; their texts are shuffled once less."""
    _view_tables(spark, tmp_path)
    v = Views(spark, str(tmp_path))
    labels = v.table("labels").select("doc_id", "toxic", "quality")
    plain = v.posts.join(labels, F.col("id") == F.col("doc_id"))
    label = (
        F.when(F.col("toxic") == 1, " Negative").when(F.col("quality") == 0, "neutral ")
        .when(F.col("event_type") == "signup", "unknown").otherwise("POSITIVE")
    )
    plain = plain.select("id", "url", "text", "lang", label.alias("sentiment"))
    assert plain.columns == v.labelled_raw.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, v.labelled_raw.collect()))
    vectors = v.table("embeddings").count()
    joined = v.posts.withColumn("vec_id", F.col("id") % vectors).join(v.scored, "vec_id").drop("vec_id")
    assert joined.columns == v.scored_posts.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, v.scored_posts.collect()))
    assert len([c for c in exchanged(v.scored_posts) if "text#" in c and "Round" not in c]) < 3

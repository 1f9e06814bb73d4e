"""Sources, sinks and whole jobs."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.views import LABELS, PROBS
from tidepost import jobs
from tidepost.operators import classify
from tidepost.operators.sampling import split_by_hash
from tidepost.plans import active, export, ingest, labelling, merge
from tidepost.session import scratch_dir, scratch_path, scratch_scope
from tidepost.sources import files

GOOD, BAD = "great lovely happy sunny win", "awful broken sad angry fail"


def test_csv_cells_survive(spark, frame, tmp_path):
    rows = [("1", 'say "hi", twice'), ("2", "two\nlines\r\nhere"), ("3", "  spaced  "), ("4", None),
            ("5", ""), ("6", "back\\slash"), ("7", "é👍")]
    path = files.export_csv(frame(rows, "id string, text string"), str(tmp_path / "c"))
    got = files.read_posts_csv(spark, [path]).select("id", "text").collect()
    wanted = [(i, text or None) for i, text in rows]
    assert sorted(map(tuple, got)) == wanted


def test_csv_sources_differ_in_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,likeCount\n1,x,5\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("text,id\n\"y\nz\",2\n", encoding="utf-8")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "missing.csv")]
    got = {r["id"]: r for r in files.read_posts_csv(spark, paths, optional=paths[2:]).collect()}
    assert (got["1"]["likeCount"], got["2"]["likeCount"]) == ("5", None)
    assert (got["1"]["source_file"], got["2"]["source_file"]) == ("a.csv", "b.csv")
    assert got["2"]["text"] == "y\nz"
    with pytest.raises(FileNotFoundError):
        files.read_posts_csv(spark, paths[2:], optional=paths[2:])
    with pytest.raises(AnalysisException):
        files.read_posts_csv(spark, paths)


def test_lookup_file(spark, tmp_path):
    path = tmp_path / "words.json"
    path.write_text('{"a": "x", "b": "", "a": "y"}', encoding="utf-8")
    assert files.load_lookup(spark, str(path)) == {"a": "y", "b": ""}
    missing = str(tmp_path / "none.json")
    assert files.load_lookup(spark, missing, optional=True) == {}
    with pytest.raises(AnalysisException):
        files.load_lookup(spark, missing)


def test_stage_round_trip_counts_rows(spark, tmp_path):
    path = str(tmp_path / "stage")
    for n in (100, 37):
        assert files.write_stage(spark.range(n), path, 3) == n
        assert files.read_stage(spark, path).count() == n
    assert files.write_stage(spark.range(5), path) == 5


def test_table_load(spark, frame, tmp_path):
    df = frame([(1, "a"), (2, "b")], "id int, t string")
    assert files.load_table(df, "loaded_results") == 2
    assert files.load_table(df.limit(1), "loaded_results") == 1
    assert spark.table("loaded_results").count() == 1
    assert files.load_table(df, str(tmp_path / "t"), "parquet") == 2
    with pytest.raises(ValueError):
        export.export_results(df.filter("id < 0"), str(tmp_path / "e"), "parquet")


def test_summary_is_json(frame, tmp_path):
    df = frame([("a", "m", True), ("a", "b", False), ("b", "b", False), (None, "b", True)],
               "l string, s string, r boolean")
    one = active.summary(df, "l", F.col("s") == "b", "r")
    path = files.write_summary(one, str(tmp_path / "s"))
    line = next((tmp_path / "s").glob("part-*.json")).read_text(encoding="utf-8")
    got = json.loads(line)
    assert path and json.loads(got["label_distribution"]) == {"a": 2, "b": 1}
    assert (got["baseline_rows"], got["selected_rows"], got["review_required_rows"]) == (3, 1, 2)


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_clean_posts(frame):
    rows = [
        ("1", "Please READ this long post about rain", "true"),
        ("1", "Please READ this long post about rain", "false"),
        ("2", "rain", None),
        ("3", "nothing to see here at all today", "yes"),
        ("4", None, None),
        (None, "some rain fell on all of us", "x"),
    ]
    got = ingest.clean_posts(
        frame(rows, "id string, text string, isReply string"),
        ["rain"],
        {"please": "do"},
        {"isReply": "is_reply", "isQuote": "is_quote"},
        order=[F.desc("isReply")],
    ).collect()
    by_id = {r["id"]: r for r in got}
    assert set(by_id) == {"1", None}
    assert by_id["1"]["text_clean"] == "do read this long post about rain"
    assert (by_id["1"]["is_reply"], by_id["1"]["is_quote"], by_id["1"]["token_count"]) == (
        True, False, 7,
    )
    with pytest.raises(ValueError, match="text"):
        ingest.clean_posts(frame([("1",)], "id string"), ["x"])


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"l{i}", f"u{i}", f"{GOOD if i % 2 else BAD} number{i}",
             " Positive" if i % 2 else "NEGATIVE ") for i in range(200)]
    rows += [("x", "ux", "blank label", "?"), ("y", "uy", "  ", "positive"),
             ("z", "uz", rows[0][2], "negative"), ("n", "un", None, "negative")]
    return spark.createDataFrame(rows, "id string, url string, text string, sentiment string")


@pytest.fixture(scope="module")
def baseline(labelled):
    return labelling.labelled_baseline(labelled, LABELS, ["id"])


@pytest.fixture(scope="module")
def pool(spark, baseline):
    rows = [(f"p{i}", f"v{i}", f"{GOOD if i % 3 else BAD} thing{i}", f"clean {i % 50}")
            for i in range(120)]
    rows += [("q", "u1", "known url", "k"), ("r", None, f"{BAD} number0", "known text"),
             ("s", None, "no url", "no url")]
    posts = spark.createDataFrame(rows, "id string, url string, text string, text_clean string")
    return labelling.unlabelled_pool(posts, baseline, ["id"])


def test_baseline(baseline):
    rows = baseline.collect()
    assert len(rows) == 200 and {r["label_id"] for r in rows} == {0, 2}
    assert {(r["label_source"], r["review_required"]) for r in rows} == {("baseline_manual", False)}


def test_pool_excludes_the_baseline(pool, baseline):
    rows = pool.collect()
    assert {r["id"] for r in rows} & {"q", "r"} == set()
    assert "s" in {r["id"] for r in rows}
    assert len(rows) == 51 and len({r["text_clean"] for r in rows}) == 51


@pytest.fixture(scope="module")
def model(baseline):
    train, _ = split_by_hash(baseline, "id")
    return classify.train_text_classifier(train, "text_clean", "sentiment", LABELS, features=1024)


def test_classifier_learns_separable_labels(baseline, model, tmp_path):
    _, held_out = split_by_hash(baseline, "id")
    loaded = classify.load_model(classify.save_model(model, str(tmp_path / "m")))
    rows = classify.with_uncertainty(
        classify.score(held_out, loaded, "text_clean", PROBS), PROBS, LABELS
    ).collect()
    assert rows and all(r["sentiment"] == r["predicted_sentiment"] for r in rows)
    assert all(abs(sum(r[p] for p in PROBS) - 1) < 1e-9 for r in rows)
    assert all(r["model_confidence"] > r["uncertainty_margin"] >= 0 for r in rows)


def test_python_model_sees_whole_texts_in_batches(frame):
    def load():
        def predict(texts):
            assert len(texts) <= 4
            return np.array([[float(len(t)), 0.0] for t in texts])

        return predict

    df = frame([(i, "x" * i if i else None) for i in range(11)], "id int, t string")
    rows = classify.score_with_python(df, load, "t", ["a", "b"], batch=4).collect()
    for r in rows:
        assert r["a"] == pytest.approx(1 / (1 + np.exp(-r["id"])))


def test_learning_round(spark, baseline, pool, model):
    scored = classify.with_uncertainty(
        classify.score(pool, model, "text", PROBS), PROBS, LABELS
    )
    chosen = active.select_candidates(scored, baseline.count(), 210, ["id"])
    whole = active.assemble(active.baseline_as_scored(baseline, LABELS, PROBS), chosen, ["text"])
    rows = whole.collect()
    assert len(rows) == 210 and "text" not in whole.columns
    assert whole.columns[:3] == ["id", "url", "sentiment"]
    weak = [r for r in rows if r["label_source"] == "al_prediction"]
    assert len(weak) == 10 and all(r["review_required"] for r in weak)
    margins = sorted(r["uncertainty_margin"] for r in scored.collect())
    assert sorted(r["uncertainty_margin"] for r in weak) == pytest.approx(margins[:10])
    manual = [r for r in rows if r["label_source"] != "al_prediction"]
    assert {r["model_confidence"] for r in manual} == {1.0}
    assert {r["uncertainty_entropy"] for r in manual} == {None}
    cut = active.head_cut(whole, F.when(F.col("review_required"), 1).otherwise(0), ["id"], 205)
    assert cut.filter("review_required").count() == 5


def test_candidate_limits(pool, model):
    scored = classify.with_uncertainty(
        classify.score(pool, model, "text", PROBS), PROBS, LABELS
    )
    assert active.select_candidates(scored, 50, 40, ["id"]).count() == 0
    assert active.select_candidates(scored, 0, 1000, ["id"]).count() == 51
    with pytest.raises(ValueError, match="empty"):
        active.select_candidates(scored.filter("id = ''"), 0, 10, ["id"])
    with pytest.raises(ValueError, match="fewer"):
        active.select_candidates(scored, 0, 1000, ["id"], strict=True)
    with pytest.raises(ValueError, match="reach"):
        active.select_candidates(scored, 10, 10, ["id"], strict=True)


def test_candidates_are_ranked_without_texts(spark, pool, model):
    scored = classify.with_uncertainty(
        classify.score(pool, model, "text", PROBS), PROBS, LABELS
    )
    scratch = Path(scratch_dir(spark))
    before = set(scratch.iterdir())
    with scratch_scope(spark):
        narrow = active.select_candidates(scored, 0, 10, ["id"], posts=pool)
        (written,) = set(scratch.iterdir()) - before
        assert "text" not in spark.read.parquet(str(written)).columns
        whole = active.select_candidates(scored, 0, 10, ["id"])
        assert narrow.columns == whole.columns
        assert narrow.collect() == whole.collect()
        hashed = F.xxhash64("id", "text").alias("_row")
        marked = active.select_candidates(
            scored.select("*", hashed), 0, 10, ["id"], posts=pool.select("*", hashed), row="_row"
        )
        assert marked.drop("_row").collect() == whole.collect()
    assert set(scratch.iterdir()) == before


def test_candidates_with_null_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "b"), ("x", "c"), ("x", "d"), ("x", "d"), (None, None), ("y", "e"), ("z", "f")]
    posts = spark.createDataFrame(rows, "id string, text string")
    margin = F.coalesce(F.ascii("text"), F.lit(90)) / 1000
    scored = posts.withColumns(
        {
            "predicted_sentiment": F.lit("neutral"),
            "uncertainty_margin": margin,
            "uncertainty_entropy": 1 - margin,
        }
    )
    ranked = [(None, None), (None, "a"), (None, "b"), ("x", "c"), ("x", "d"), ("x", "d"), ("y", "e"), ("z", "f")]
    with scratch_scope(spark):
        for n in range(1, 10):
            chosen = active.select_candidates(scored, 0, n, ["id"], posts=posts)
            got = [(r.id, r.text) for r in chosen.collect()]
            assert got == ranked[:n], n
        assert chosen.columns == active.select_candidates(scored, 0, 3, ["id"]).columns


@pytest.mark.parametrize("name", ["l8_select_candidates", "l10_assemble"])
def test_queries_write_no_text_of_the_scored_pool(spark, name):
    scratch = Path(scratch_dir(spark))
    before = set(scratch.iterdir())
    with scratch_scope(spark):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        (written,) = set(scratch.glob("scored-pool-*")) - before
        columns = spark.read.parquet(str(written)).columns
    assert "uncertainty_margin" in columns and not {"text", "text_clean", "url"} & set(columns)


@pytest.mark.parametrize("name", ["l3_train_report", "l8_select_candidates", "l10_assemble"])
def test_scratch_tables_are_removed(spark, name):
    scratch = Path(scratch_dir(spark))
    before = set(scratch.iterdir())
    with scratch_scope(spark):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        assert set(scratch.iterdir()) > before
    assert set(scratch.iterdir()) == before


def test_merge(frame):
    scored = frame([(1, "positive", "a"), (2, "neutral", "b"), (3, "negative", "c"),
                    (4, "positive", "d"), (None, "positive", "e"), (6, None, "f")],
                   "id long, sentiment string, text string")
    irony = frame([("1", 1, 0.8), ("1", 0, 0.6), ("2", 1, 0.7), ("3", 1, 0.9), ("4", 0, 0.9),
                   ("None", 1, 1.0), ("6", 1, 1.0)],
                  "id string, sarcasm_label int, sarcasm_confidence double")
    got = merge.merge_predictions(scored, irony, ["positive", "neutral"], "negative")
    by_text = {r["text"]: r for r in got.collect()}
    assert len(by_text) == 6
    assert [by_text[x]["final_sentiment"] for x in "abcdef"] == [
        "negative", "negative", "negative", "positive", "positive", None,
    ]
    assert (by_text["e"]["sarcasm_label"], by_text["e"]["sarcasm_confidence"]) == (0, 0.0)
    assert (by_text["a"]["sarcasm_text"], by_text["d"]["sarcasm_text"]) == ("sarcasm", "non_sarcasm")
    assert not by_text["e"]["irony_matched"]
    with pytest.raises(ValueError, match="sarcasm_confidence"):
        merge.merge_predictions(scored, irony.drop("sarcasm_confidence"), ["positive"], "negative")


def test_from_raw_files_to_the_result_table(spark, tmp_path):
    """All jobs in a row, handing over through written tables."""
    path = lambda name: str(tmp_path / name)
    kinds = [GOOD, BAD]
    rows = [(str(i), f"https://x.com/u{i % 9}/status/{i}", f"Rain {kinds[i % 2]} no{i} @a #tag{i}",
             str(i % 50), "TRUE" if i % 4 == 0 else "") for i in range(150)]
    raw = spark.createDataFrame(rows, "id string, url string, text string, likeCount string, "
                                      "isReply string")
    again = raw.filter("cast(id as int) < 30").drop("likeCount")
    sources = [files.export_csv(raw, path("a")), files.export_csv(again, path("b"))]
    (tmp_path / "words.json").write_text('{"no5": "five"}')
    assert jobs.clean(spark, sources, path("cleaned"), ["rain"], path("words.json"),
                      flags={"isReply": "is_reply"},
                      order=["likeCount", "source_file"]) == {"posts": 150}
    cleaned = files.read_stage(spark, path("cleaned"))
    assert cleaned.filter("likeCount is null").count() == 0
    assert cleaned.filter("text_clean like '%five%'").count() == 1

    labels = [(r[0], r[1], r[2], "Positive" if int(r[0]) % 2 == 0 else "negative")
              for r in rows[:60]]
    marked = spark.createDataFrame(labels, "id string, url string, text string, sentiment string")
    files.export_csv(marked, path("labelled"))
    assert jobs.separate(spark, path("cleaned"), [path("labelled")], path("baseline"),
                         path("pool"), LABELS) == {"baseline": 60, "pool": 90}
    scratch = Path(scratch_dir(spark))
    before = set(scratch.iterdir())
    jobs.train(spark, path("baseline"), path("model"), path("report"), LABELS, PROBS, features=1024)
    assert jobs.select(spark, path("baseline"), path("pool"), path("model"), path("learning"), 100,
                       LABELS, PROBS) == {"selected": 100}
    settings = [{"kind": "count", "slots": 64}, {"kind": "count", "slots": 512}]
    jobs.choose(spark, path("baseline"), path("weights"), path("choice"), LABELS, settings)
    choice = files.read_stage(spark, path("choice")).orderBy("setting").collect()
    assert [r["parameters"] for r in choice] == ["kind=count, slots=64", "kind=count, slots=512"]
    slots = next(settings[r["setting"]]["slots"] for r in choice if r["chosen"])
    assert jobs.select(spark, path("baseline"), path("pool"), path("weights"), path("other"), 100,
                       LABELS, PROBS, slots=slots) == {"selected": 100}
    assert set(scratch.iterdir()) == before
    whole = files.read_stage(spark, path("learning"))

    irony = classify.irony_predictions(
        whole.select("id", F.when(F.col("id") == "2", 0.1).otherwise(0.9).alias("p0")).withColumn(
            "p1", 1 - F.col("p0")
        ),
        "id",
        ["p0", "p1"],
    )
    files.write_stage(irony, path("irony"))
    assert jobs.resolve(spark, path("learning"), path("irony"), path("final"),
                        ["positive", "neutral"], "negative") == {"posts": 100}
    assert jobs.load(spark, path("final"), path("results"), "parquet", path("csv")) == {
        "results": 100
    }
    results = spark.read.parquet(path("results"))
    by_id = {r["tweet_id"]: r for r in results.collect()}
    assert by_id["2"]["sentiment_label"] == "positive"
    assert by_id["2"]["final_sentiment"] == "negative"
    wrong = [i for i, r in by_id.items()
             if r["sentiment_label"] != ("positive" if int(i) % 2 == 0 else "negative")]
    assert not wrong
    assert files.read_posts_csv(spark, [path("csv")]).count() == 100

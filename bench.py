"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local cores, ``BENCH_RUNS`` the
number of timed runs after one warm run (the median counts), ``BENCH_QUERIES`` an optional list of
name prefixes. Every run computes all rows and columns and drops them in a no-op sink.

``BENCH_REPEAT=n`` measures how queries grow: they run on the tables as they are and on tables whose
documents, labels and events are repeated n times under new ids (written to a temporary folder), and
``growth`` has the ratio of the times; n is what work in proportion would give, less the fixed cost of a
query. ``fit`` and ``score`` of the term model are timed apart.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from checks.queries import QUERIES
from tidepost.operators.terms import count_model, score_terms
from tidepost.session import build_session

HEADLINE = [
    "flagship_clean_counts",
    "ingest_clean_posts",
    "p5_clean_text",
    "p12_normalize_tokens",
    "p15_tokenize",
    "j6_normalize_tokens_join",
    "d2_keep_best",
    "d3_dedup_clean_text",
    "j3_unlabelled_pool",
    "j4_attach_predictions",
    "l8_select_candidates",
    "l11_merge_predictions",
    "r2_stratified_split",
    "r3_fixed_sample",
    "w1_most_uncertain",
    "w1_top_n_by_number",
    "p2_number_rows",
    "a3_sentiment_summary",
    "a4_kpi_row",
    "a6_monthly_share",
    "a10_median_by_lineitem",
    "a14_profile",
    "a16_user_activity",
    "a17_top_share_lineitem",
    "a18_histogram_lineitem",
    "a22_category_counts",
    "a28_repeated_texts",
    "a29_text_statistics",
    "a30_term_counts",
    "a31_term_lift",
    "a32_spike_context",
    "a33_classification_report",
    "a34_findings",
    "l4_score",
]


def repeated_tables(spark, folder: str, times: int) -> str:
    """The tables with documents, labels and events repeated under new ids, in a new folder."""
    target = tempfile.mkdtemp(prefix="bench-")
    docs = spark.read.parquet(f"{folder}/documents.parquet").agg(F.max("doc_id") + 1).first()[0]
    ids = {"documents": ("doc_id", docs), "labels": ("doc_id", docs), "events": ("event_id", 5 * docs)}
    copies = spark.range(times).select(F.col("id").alias("_copy"))
    for path in sorted(Path(folder).glob("*.parquet")):
        df = spark.read.parquet(str(path))
        if path.stem in ids:
            key, shift = ids[path.stem]
            # events beyond the documents' would meet those of the next copy
            rows = df.filter(F.col(key) < shift).join(F.broadcast(copies))
            df = rows.withColumn(key, F.col(key) + F.col("_copy") * shift).drop("_copy")
            df = df.repartition(16)
        df.write.parquet(f"{target}/{path.name}")
    return target


def median_seconds(run, runs: int) -> float:
    spent = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        run()
        spent.append(time.perf_counter() - start)
    return round(statistics.median(spent[1:]), 3)


def fit_and_score(spark, folder: str, runs: int) -> dict[str, float]:
    """Seconds to count a term model, and to score all documents with it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = docs.filter("lang IS NOT NULL")
    langs = sorted(r[0] for r in known.select("lang").distinct().collect())
    model = count_model(known, "text", "lang", langs, slots=1 << 14)
    path = f"{tempfile.mkdtemp(prefix='bench-')}/model"
    fit = median_seconds(lambda: model.write.mode("overwrite").parquet(path), runs)
    scored = score_terms(docs, spark.read.parquet(path), "text", [f"p{i}" for i in range(len(langs))], 1 << 14)
    score = median_seconds(lambda: scored.write.format("noop").mode("overwrite").save(), runs)
    return {"fit": fit, "score": score}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE
    if chosen == "all":
        names = list(QUERIES)
    elif chosen:
        names = [n for n in QUERIES if any(n.startswith(p) for p in chosen.split(","))]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__sql__files__openCostInBytes="1048576",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("OFF")
    def timed(name: str, folder: str) -> float:
        def run():
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

        seconds = median_seconds(run, runs)
        print(f"{name}: {seconds}", file=sys.stderr)
        return seconds

    times = {name: timed(name, folder) for name in names}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    if repeat := int(os.environ.get("BENCH_REPEAT", "0")):
        larger = repeated_tables(spark, folder, repeat)
        result["repeated"] = {name: timed(name, larger) for name in names}
        result["growth"] = {n: round(result["repeated"][n] / max(times[n], 1e-3), 2) for n in names}
        result["model"] = {"once": fit_and_score(spark, folder, runs), "repeated": fit_and_score(spark, larger, runs)}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

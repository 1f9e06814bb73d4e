"""Sources and sinks: what is written is read back and compared."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.sql import r, stamp
from tidepost.operators.counts import observed
from tidepost.plans.active import summary
from tidepost.session import scratch_path
from tidepost.sources.files import (
    export_csv,
    load_results,
    load_table,
    malformed_rows,
    read_labelled_csv,
    read_posts_csv,
    read_stage,
    write_results,
    write_stage,
)


@query(
    "s1_read_posts_csv",
    """SELECT id::VARCHAR AS id, url, text, CASE WHEN src = 'a.csv' THEN lang END AS lang,
         view_count::VARCHAR AS view_count, true AS has_file FROM posts_raw""",
    "posts_raw",
)
def s1(v):
    columns = ["id", "url", "text", "lang", "view_count"]
    first = v.posts_raw.filter("src = 'a.csv'").select(*columns)
    second = v.posts_raw.filter("src = 'b.csv'").select(*columns).drop("lang")
    paths = [
        export_csv(first, scratch_path(v.spark, "a")),
        export_csv(second, scratch_path(v.spark, "b")),
        scratch_path(v.spark, "absent"),
    ]
    posts = read_posts_csv(v.spark, paths, optional=paths[2:])
    return posts.select(*columns, F.col("source_file").endswith(".csv").alias("has_file"))


@query(
    "s3_read_labelled_csv",
    "SELECT id::VARCHAR AS id, url, text, sentiment FROM labelled_raw",
    "labelled_raw",
)
def s3(v):
    path = export_csv(v.labelled_raw, scratch_path(v.spark, "labelled"))
    return read_labelled_csv(v.spark, [path]).select("id", "url", "text", "sentiment")


def write_lines(lines, header, path):
    """Add text files of lines, each with the header first, and one that has only the header.

    Every task writes a file of its own, so that none holds all rows.
    """
    lines.sparkSession.range(1).select(F.lit(header)).write.mode("append").text(path)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    value = F.col("value")
    headed = F.when(place == 0, F.concat(F.lit(f"{header}\n"), value)).otherwise(value)
    lines.select(headed.alias("value")).write.mode("append").text(path)


_HEADERS = ["id", "url", "lang"], ["lang", "id", "view_count"], ["url", "id"]


@query(
    "s1_mixed_headers",
    """SELECT id::VARCHAR AS id, CASE WHEN id % 3 <> 1 THEN url END AS url,
         CASE WHEN id % 3 <> 2 THEN lang END AS lang,
         CASE WHEN id % 3 = 1 THEN view_count::VARCHAR END AS view_count,
         false AS malformed FROM posts
       UNION ALL SELECT id::VARCHAR, url, NULL, NULL, false FROM posts WHERE id % 10 = 3
       UNION ALL SELECT id::VARCHAR, url, NULL, NULL, true FROM posts WHERE id % 10 = 4
       UNION ALL SELECT id::VARCHAR, NULL, NULL, NULL, true FROM posts WHERE id % 10 = 5""",
    "posts",
)
def s1_headers(v):
    """One folder with three orders of columns, and files with too many and too few cells."""
    path = scratch_path(v.spark, "mixed")
    plain = {"header": True, "escape": '"'}
    for i, header in enumerate(_HEADERS):
        part = v.posts.filter(F.col("id") % 3 == i).select(*header)
        part.write.mode("append").options(**plain).csv(path)
    cells = {
        3: F.concat_ws(",", "id", "url"),
        4: F.concat_ws(",", "id", "url", F.lit("surplus"), F.lit("cells")),
        5: F.col("id").cast("string"),
    }
    for digit, line in cells.items():
        lines = v.posts.filter(F.col("id") % 10 == digit).select(line.alias("value"))
        write_lines(lines, "id,url", path)
    posts = read_posts_csv(v.spark, [path], malformed="bad")
    return posts.select(
        "id", "url", "lang", "view_count", F.col("bad").isNotNull().alias("malformed")
    )


@query(
    "s1_malformed_rows",
    """SELECT count(*) AS rows, count(*) FILTER (id % 4 = 0) AS malformed_rows FROM posts""",
    "posts",
)
def s1_malformed(v):
    path = scratch_path(v.spark, "malformed")
    surplus = F.when(F.col("id") % 4 == 0, F.lit(",x")).otherwise(F.lit(""))
    lines = v.posts.select(F.concat(F.concat_ws(",", "id", "lang"), surplus).alias("value"))
    write_lines(lines, "id,lang", path)
    counts = malformed_rows(read_posts_csv(v.spark, [path], malformed="bad"), "bad")
    return counts.agg(
        F.sum("rows").alias("rows"), F.sum("malformed_rows").alias("malformed_rows")
    )


@query("s4_read_stage", "SELECT doc_id, lang, n_chars FROM documents")
def s4(v):
    return read_stage(v.spark, f"{v.folder}/documents.parquet", ["doc_id", "lang", "n_chars"])


@query(
    "s5_write_stage",
    f"""SELECT id, text, {stamp('created_at')} AS created_at, view_count,
          (SELECT count(*) FROM posts) AS written FROM posts""",
    "posts",
)
def s5(v):
    path = scratch_path(v.spark, "stage")
    written = write_stage(v.posts.select("id", "text", "created_at", "view_count"), path, 4)
    return read_stage(v.spark, path).withColumn("written", F.lit(written).cast("bigint"))


@query(
    "s7_load_table",
    f"""SELECT id, final_sentiment, {r('model_confidence')} AS model_confidence,
          (SELECT count(*) FROM final) AS loaded FROM final""",
    "final",
)
def s7(v):
    path = scratch_path(v.spark, "table")
    rows = v.final.select("id", "final_sentiment", "model_confidence")
    loaded = load_table(rows, path, "parquet")
    return v.spark.read.parquet(path).withColumn("loaded", F.lit(loaded).cast("bigint"))


@query(
    "s5_replace_what_is_read",
    "SELECT id, view_count + 2 AS view_count FROM posts WHERE id % 2 = 0",
    "posts",
)
def s5_replace(v):
    """A stage table that is replaced twice by what a job reads from it."""
    path = scratch_path(v.spark, "stage")
    write_stage(v.posts.select("id", "view_count"), path)
    for _ in range(2):
        rows = read_stage(v.spark, path).filter("id % 2 = 0")
        write_stage(rows.withColumn("view_count", F.col("view_count") + 1), path)
    return read_stage(v.spark, path)


@query(
    "s7_replace_after_failure",
    f"""SELECT id, final_sentiment, {r('model_confidence')} AS model_confidence, true AS failed,
          (SELECT count(*) FROM final) AS loaded FROM final""",
    "final",
)
def s7_failure(v):
    """A load that breaks off half-way leaves the rows of the one before."""
    path = scratch_path(v.spark, "table")
    rows = v.final.select("id", "final_sentiment", "model_confidence")
    loaded = load_table(rows, path, "parquet")
    breaks = F.when(F.col("id") % 7 == 3, F.raise_error(F.lit("broken off"))).otherwise(F.col("id"))
    try:
        load_table(v.spark.read.parquet(path).withColumn("id", breaks.cast("bigint")), path, "parquet")
        failed = False
    except Exception as error:  # noqa: BLE001
        failed = "broken off" in str(error)
    return v.spark.read.parquet(path).withColumns(
        {"failed": F.lit(failed), "loaded": F.lit(loaded).cast("bigint")}
    )


@query(
    "s8_export_csv",
    "SELECT id::VARCHAR AS id, text, sentiment, review_required::VARCHAR AS review_required "
    "FROM al_set",
    "al_set",
)
def s8(v):
    rows = v.al_set.select("id", "text", "sentiment", "review_required")
    path = export_csv(rows, scratch_path(v.spark, "csv"))
    return read_posts_csv(v.spark, [path]).drop("source_file")


@query(
    "s9_load_results",
    f"SELECT id, {stamp('created_at')} AS created_at, lang, like_count FROM posts "
    "WHERE created_at IS NOT NULL",
    "posts",
)
def s9(v):
    return load_results(v.posts, ["id", "created_at", "lang", "like_count"])


@query(
    "s9_results_by_month",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
       WHERE o_orderdate BETWEEN DATE '1995-03-15' AND DATE '1995-05-02'""",
)
def s9_months(v):
    path = scratch_path(v.spark, "months")
    orders = v.table("orders").withColumn("created_at", F.col("o_orderdate").cast("timestamp"))
    write_results(orders, path)
    stored = v.spark.read.parquet(path)
    rows = load_results(
        stored, ["o_orderkey", "created_at"], start="1995-03-15", end="1995-05-02"
    )
    return rows.select("o_orderkey", F.date_format("created_at", "yyyy-MM-dd").alias("day"))


@query(
    "s10_al_summary",
    """SELECT count(*) FILTER (label_source = 'manual') AS baseline_rows,
         count(*) FILTER (label_source <> 'manual') AS selected_rows, count(*) AS all_rows,
         (SELECT '{' || string_agg('"' || sentiment || '":' || n, ',' ORDER BY sentiment) || '}'
          FROM (SELECT sentiment, count(*) AS n FROM al_set GROUP BY 1)) AS label_distribution,
         count(*) FILTER (review_required) AS review_required_rows FROM al_set""",
    "al_set",
)
def s10(v):
    return summary(v.al_set, "sentiment", F.col("label_source") == "manual", "review_required")


@query(
    "a1_observed_rows",
    "SELECT count(*) AS rows, count(*) AS observed FROM documents",
)
def a1_observed(v):
    docs, watch = observed(v.table("documents"), "documents")
    path = scratch_path(v.spark, "observed")
    docs.select("doc_id").write.parquet(path)
    written = v.spark.read.parquet(path)
    return written.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "observed", F.lit(watch.get["rows"]).cast("bigint")
    )

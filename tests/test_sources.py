"""Readers of mixed CSV folders, replacement of tables, results by month."""

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidepost.sources import files, headers, replace


def ids(df):
    return sorted(r[0] for r in df.collect())


def broken(df):
    """The frame, failing while its later rows are written."""
    stop = F.when(F.col("id") >= 90, F.raise_error(F.lit("stopped"))).otherwise(F.col("id"))
    return df.withColumn("id", stop.cast("bigint"))


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "table")
    assert files.write_stage(spark.range(50), path) == 50
    return path


def test_folder_is_replaced(spark, stored):
    assert files.write_stage(spark.range(7), stored) == 7
    assert ids(files.read_stage(spark, stored)) == list(range(7))
    assert [p.name for p in Path(stored).parent.iterdir()] == ["table"]


def test_failed_write_leaves_the_old_table(spark, stored):
    for write in (files.write_stage, lambda df, p: files.load_table(df, p, "parquet")):
        with pytest.raises(Exception, match="stopped"):
            write(broken(spark.range(100)), stored)
        assert files.read_stage(spark, stored).count() == 50
        assert [p.name for p in Path(stored).parent.iterdir()] == ["table"]


def test_table_is_read_and_replaced(spark, stored):
    for _ in range(2):
        files.write_stage(files.read_stage(spark, stored).filter("id % 2 = 0").selectExpr("id div 2 id"), stored)
    assert ids(files.read_stage(spark, stored)) == list(range(13))
    assert files.load_table(files.read_stage(spark, stored), stored, "parquet") == 13


def test_columns_may_change(spark, stored):
    files.write_stage(spark.range(3).withColumn("x", F.lit("a")), stored)
    assert files.read_stage(spark, stored).columns == ["id", "x"]
    files.write_stage(spark.range(0), stored)
    assert files.read_stage(spark, stored).count() == 0


def test_broken_off_swap_is_put_right(spark, stored):
    folder = replace.Folder(spark, stored)
    folder.rename(folder.path.toString(), folder.sibling(".old-"))
    assert not Path(stored).exists()
    assert replace.recover(spark, stored) and not replace.recover(spark, stored)
    assert files.read_stage(spark, stored).count() == 50


def test_failed_swap_puts_the_old_version_back(spark, stored):
    folder = replace.Folder(spark, stored)
    with pytest.raises(Exception):
        folder.swap_in(stored + "-that-is-not-there")
    assert files.read_stage(spark, stored).count() == 50


def test_missing_rows_are_noticed(spark, stored, monkeypatch):
    monkeypatch.setattr(replace.Observation, "get", {"rows": 99})
    with pytest.raises(RuntimeError, match="sent 99 rows, found 5"):
        files.load_table(spark.range(5), stored, "parquet")
    assert files.read_stage(spark, stored).count() == 50


@pytest.mark.parametrize("fmt", ["csv", "json", "orc"])
def test_other_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    for n in (9, 4):
        assert files.load_table(spark.range(n), path, fmt, {"header": "true"}) == n
    assert spark.read.format(fmt).option("header", True).load(path).count() == 4


def test_catalog_table_is_replaced(spark):
    name = "replaced_results"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        assert files.load_table(spark.range(20), name) == 20
        with pytest.raises(Exception, match="stopped"):
            files.load_table(broken(spark.range(100)), name)
        assert spark.table(name).count() == 20
        rows = spark.table(name).filter("id < 5").withColumn("x", F.lit(1))
        assert files.load_table(rows, name) == 5
        assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 5
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_headers_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("text,id\ny,2\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("﻿id,likes\n3,7\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("", encoding="utf-8")
    (tmp_path / "e [1] 50%.csv").write_text("id,text\n4,z\n", encoding="utf-8")
    with gzip.open(tmp_path / "f.csv.gz", "wt") as file:
        file.write("text,id\nw,5\n")
    got = {r["id"]: r for r in files.read_posts_csv(spark, [str(tmp_path)]).collect()}
    assert {i: (r["text"], r["likes"]) for i, r in got.items()} == {
        "1": ("x", None), "2": ("y", None), "3": (None, "7"), "4": ("z", None), "5": ("w", None),
    }
    assert got["4"]["source_file"].startswith("e") and got["5"]["source_file"] == "f.csv.gz"


def test_quoted_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"a ""long""\nname"\n1,x\n', encoding="utf-8")
    assert headers.header_of(spark, str(tmp_path / "a.csv")) == 'id,"a ""long""\nname"'
    row = files.read_posts_csv(spark, [str(tmp_path)]).first()
    assert (row[0], row[1]) == ("1", "x")


@pytest.mark.parametrize("multi_line", [True, False])
def test_malformed_rows_are_kept_and_counted(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n2\n3,y,z\n4,\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("text,id\nu,5\n", encoding="utf-8")
    posts = files.read_posts_csv(spark, [str(tmp_path)], multi_line=multi_line, malformed="bad")
    got = {r["id"]: (r["text"], r["bad"]) for r in posts.collect()}
    assert got == {"1": ("x", None), "2": (None, "2"), "3": ("y", "3,y,z"), "4": (None, None), "5": ("u", None)}
    assert posts.filter("bad IS NOT NULL").select("id").count() == 2
    counts = {r[0]: (r[1], r[2]) for r in files.malformed_rows(posts, "bad").collect()}
    assert counts == {"a.csv": (4, 2), "b.csv": (1, 0)}


def test_reports_read_only_their_months(spark, tmp_path):
    path = str(tmp_path / "results")
    day = F.make_date(F.lit(2024), (F.col("id") % 12 + 1).cast("int"), (F.col("id") % 28 + 1).cast("int"))
    rows = spark.range(2000).withColumn("created_at", day.cast("timestamp"))
    rows = rows.withColumn("created_at", F.when(F.col("id") != 5, F.col("created_at")))
    assert files.write_results(rows, path) == 2000
    stored = spark.read.parquet(path)
    part = files.load_results(stored, ["id", "created_at"], start="2024-03-10", end="2024-04-05")
    wanted = rows.filter("created_at >= '2024-03-10' AND created_at < '2024-04-06'").count()
    assert part.count() == wanted > 0
    plan = plan_of(part)
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "month" in filters and "2024-03" in filters and "2024-04" in filters
    assert "GreaterThanOrEqual(created_at" in plan
    assert len(part.inputFiles()) <= len(stored.inputFiles())
    assert files.load_results(stored, ["id"]).count() == 1999


def test_stages_have_more_parts_where_their_input_is_large(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "the source"), str(tmp_path / "target")
    spark.range(5000).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).repartition(2).write.parquet(source)
    rows = spark.read.parquet(source)
    size = sum(f.stat().st_size for f in Path(source).glob("*.parquet"))
    assert files.input_bytes(rows) == size and files.input_bytes(spark.range(3)) == 0
    parts = lambda: len(list(Path(target).glob("*.parquet")))
    assert files.write_stage(rows, target, 3) == 5000 and parts() == 3
    monkeypatch.setattr(files, "PART_BYTES", size // 10)
    assert files.write_stage(rows, target, 3) == 5000 and parts() in (10, 11)
    assert files.write_stage(spark.range(50), target, 3) == 50 and parts() == 3
    assert ids(spark.read.parquet(target)) == list(range(50))

"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Every partition's rows are permuted locally; how many of them go to which shard is drawn first,
from the distribution that a uniform permutation of all rows would give. Rows then move once and
are permuted again. Everything is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import save

#: Children of a node in the tree over partitions.
FAN = 64


def _let(body, **values: Column) -> Column:
    """``body`` of a struct of values that are computed once."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body)[0]


def _double(*columns: Column) -> list[Column]:
    return [c.cast("double") for c in columns]


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` from ``total`` items are among the ``good`` ones, for a uniform ``u``.

    Inversion: the probabilities, by their ratio from one count to the next, are summed over nine
    standard deviations (and 30) around the mean; what lies beyond is less than a double shows.
    """
    zero = F.lit(0).cast("long")

    def spread(p):
        t, k, d = _double(p.t, p.k, p.d)
        mean = d * k / F.greatest(t, F.lit(1.0))
        deviation = F.sqrt(
            F.greatest(mean * (t - k) * (t - d), F.lit(0.0))
            / F.greatest(t * (t - 1), F.lit(1.0))
        )
        return _let(bounds, t=p.t, k=p.k, d=p.d, u=p.u, mean=mean, reach=deviation * 9 + 30)

    def bounds(p):
        low = F.greatest(zero, p.d - p.t + p.k, F.floor(p.mean - p.reach))
        high = F.least(p.k, p.d, F.ceil(p.mean + p.reach))
        return _let(summed, t=p.t, k=p.k, d=p.d, u=p.u, low=low, high=F.greatest(low, high))

    def ratio(p, x):
        t, k, d, x = _double(p.t, p.k, p.d, x)
        return (k - x) * (d - x) / ((x + 1) * F.greatest(t - k - d + x + 1, F.lit(1.0)))

    def summed(p):
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        total_weight = F.aggregate(
            F.sequence(p.low, p.high),
            start,
            lambda s, x: F.struct((s.w * ratio(p, x)).alias("w"), (s.sum + s.w).alias("sum")),
            lambda s: s.sum,
        )
        return _let(chosen, t=p.t, k=p.k, d=p.d, low=p.low, high=p.high, goal=p.u * total_weight)

    def chosen(p):
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), p.low.alias("at"))

        def step(s, x):
            passed = s.sum + s.w < p.goal
            return F.struct(
                (s.w * ratio(p, x)).alias("w"),
                (s.sum + s.w).alias("sum"),
                F.when(passed, x + 1).otherwise(s.at).alias("at"),
            )

        return F.aggregate(
            F.sequence(p.low, p.high), start, step, lambda s: F.least(s.at, p.high)
        )

    return _let(
        spread, t=total.cast("long"), k=good.cast("long"), d=draws.cast("long"), u=u
    )


def _uniform(*columns: Column) -> Column:
    """Between 0 and 1, the same for the same values."""
    return F.xxhash64(*columns).cast("double") / F.lit(2.0**64) + F.lit(0.5)


def split_counts(children: Column, counts: Column, seed: Column) -> Column:
    """Counts per child: ``counts`` dealt uniformly to children of the given sizes, in turn."""

    def one_child(left, child):
        """How many of each kind the child takes from what is left."""
        start = F.struct(
            F.aggregate(left, F.lit(0).cast("long"), lambda a, b: a + b).alias("t"),
            child.n.alias("d"),
            F.slice(left, 1, 0).alias("taken"),
        )

        def one_kind(s, j):
            good = F.element_at(left, j)
            x = hypergeometric(s.t, good, s.d, _uniform(seed, child.node, j))
            return _let(
                lambda p: F.struct(
                    (s.t - good).alias("t"),
                    (s.d - p.x).alias("d"),
                    F.concat(s.taken, F.array(p.x)).alias("taken"),
                ),
                x=x,
            )

        return F.aggregate(F.sequence(F.lit(1), F.size(left)), start, one_kind, lambda s: s.taken)

    def next_child(s, child):
        return _let(
            lambda p: F.struct(
                F.zip_with(s.left, p.taken, lambda a, b: a - b).alias("left"),
                F.concat(
                    s.out, F.array(F.struct(child.node.alias("node"), p.taken.alias("counts")))
                ).alias("out"),
            ),
            taken=one_child(s.left, child),
        )

    empty = F.array().cast("array<struct<node:bigint,counts:array<bigint>>>")
    start = F.struct(counts.alias("left"), empty.alias("out"))
    return F.aggregate(children, start, next_child, lambda s: s.out)


def communication_matrix(sizes: DataFrame, shard_sizes: list[int], seed: int) -> DataFrame:
    """``part, counts``: rows of each partition for each shard.

    ``sizes`` has ``part, n``. Rows of the matrix are drawn down a tree over the partitions: a
    node's counts are dealt to up to 64 children, whose draws are then independent of each other.
    """
    numbered = sizes.select(
        "part", "n", (F.row_number().over(Window.orderBy("part")) - 1).cast("long").alias("node")
    )
    numbered = save(numbered, "shard-parts")
    parts = numbered.count()
    spark = sizes.sparkSession
    root = F.array(*[F.lit(int(x)).cast("long") for x in shard_sizes])
    level = spark.range(1).select(F.lit(0).cast("long").alias("parent"), root.alias("counts"))
    depth = 1
    while FAN**depth < parts:
        depth += 1
    for height in range(depth - 1, -1, -1):
        width = FAN**height
        children = (
            numbered.groupBy(F.floor(F.col("node") / width).alias("node"))
            .agg(F.sum("n").alias("n"))
            .groupBy(F.floor(F.col("node") / FAN).alias("parent"))
            .agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("children"))
        )
        drawn = level.join(children, "parent").select(
            F.explode(split_counts(F.col("children"), F.col("counts"), F.lit(seed + height)))
        )
        level = save(drawn.select(F.col("col.node").alias("parent"), "col.counts"), "shard-level")
    return level.join(numbered, level.parent == numbered.node).select("part", "counts")


def shard_rows(
    docs: DataFrame, shards: int = 40, seed: int = 7, broadcast_bytes: int = 32 << 20
) -> DataFrame:
    """All documents in ``shards`` shards whose row counts differ by one at most.

    Returns ``doc_id, size, text_crc32, shard, slot``; size is the text's UTF-8 bytes plus 16
    (null text: no bytes), slots count from 0 without gaps in a uniformly random order. Rows with
    null or repeated ids and equal texts are rows like others. The order depends on ids, texts and
    how the input is split; it is fixed when the local permutation has been written. Slots are
    numbered in blocks of about the square root of all rows, so no task sorts a whole shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), crc.alias("text_crc32")
    )
    key = F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")
    local = narrow.withColumn("key", key).sortWithinPartitions("key", "doc_id")
    row = F.monotonically_increasing_id()
    local = save(local.drop("key").withColumn("row", row), "shard-rows").withColumns(
        {"part": F.shiftright("row", 33), "place": F.col("row").bitwiseAND((1 << 33) - 1)}
    )
    rows = local.count()
    sizes = [rows // shards + (i < rows % shards) for i in range(shards)]
    matrix = communication_matrix(
        local.groupBy("part").agg(F.count("*").alias("n")), sizes, seed
    )
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda i: F.aggregate(
            F.slice("counts", F.lit(1), i), F.lit(0).cast("long"), lambda a, b: a + b
        ),
    )
    matrix = save(matrix.select("part", ends.alias("ends")), "shard-matrix")
    if matrix.count() * shards * 8 <= broadcast_bytes:
        matrix = F.broadcast(matrix)
    blocks = max(1, math.ceil(math.sqrt(rows) / shards))
    again = F.xxhash64(F.lit(seed + 1), "doc_id", "text_crc32", "row")
    place = F.col("place")
    dealt = save(
        local.join(matrix, "part")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= place)))
        .select("doc_id", "size", "text_crc32", "shard", again.alias("key"), "row")
        .withColumn("block", F.pmod(F.shiftright("key", 16), F.lit(blocks)).cast("int")),
        "shard-dealt",
    )
    filled = dealt.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    filled = filled.select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("key", "row"))
    return (
        dealt.withColumn("inside", inside)
        .join(filled, ["shard", "block"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("before") + F.col("inside") - 1).alias("slot"),
        )
    )

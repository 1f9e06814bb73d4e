"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies. Its whole part is certain; the
fractions are rounded in pairs. Each time expected words move from one document to the other, in a
random direction that keeps every expectation, until one of the fractions is 0 or 1; so a source's
words stay at their target, but for the last document. Documents of similar size are paired first
and what is left of a group goes up a tree. Everything is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import ROW_KEY, save

#: Weights that repeat over the sources in code point order, null last.
WEIGHTS = (3, 1, 2)
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
_UNIT = "struct<size:bigint,h:bigint,doc_id:bigint,key:string,p:double>"
_DONE = "array<struct<size:bigint,h:bigint,doc_id:bigint,key:string,up:int>>"


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not white space; 0 for null."""
    marks = F.regexp_replace(
        F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", "w"
    )
    return F.length(F.rtrim(marks, F.lit(_SPACES))).cast("long")


def source_targets(
    sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS
) -> DataFrame:
    """Targets per source from ``source_key, source, source_size, rows``.

    The budget is ``share`` of all sizes, split by weight. A target stops at ``most`` times its
    source's size; the excess goes to the others by weight until none is above. In the order of
    the ratio of limit to weight, the sources that stop come first, so running sums find them.
    The table of sources is ordered in one task; it has one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place - 1) % len(weights) + 1
    )
    placed = sizes.withColumn("weight", weight).withColumn(
        "limit", F.col("source_size") * F.lit(float(most))
    )
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "source_key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    left = F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    stops = F.col("limit") * F.sum("weight").over(rest) <= left * F.col("weight")
    free = F.when(~F.col("stops"), F.col("weight"))
    used = F.coalesce(F.sum(F.when(F.col("stops"), F.col("limit"))).over(everything), F.lit(0.0))
    per_weight = (F.col("budget") - used) / F.sum(free).over(everything)
    target = F.when(F.col("stops"), F.col("limit")).otherwise(
        F.least(F.col("limit"), per_weight * F.col("weight"))
    )
    return (
        placed.withColumn("budget", budget)
        .withColumn("stops", stops)
        .withColumn("target", target)
        .select("source_key", "source_size", "target", "rows")
    )


def _uniform(*columns: Column) -> Column:
    return F.xxhash64(*columns).cast("double") / F.lit(2.0**64) + F.lit(0.5)


def round_group(units: Column, seed: int) -> Column:
    """Pivotal rounding along an array of units: ``rest`` (the unit left over) and ``done``.

    A unit without words moves nothing; it is settled as it comes.
    """

    def unit(u, p):
        return F.struct(u.size, u.h, u.doc_id, u.key, p.alias("p")).cast(_UNIT)

    def settled(u, up):
        return F.struct(u.size, u.h, u.doc_id, u.key, up.cast("int").alias("up"))

    def step(s, x):
        a, b = s.rest, x
        u = _uniform(F.lit(seed), a.h, b.h)
        # words that can move to a or away from a before one of the two probabilities is 0 or 1
        gain = F.least((1.0 - a.p) * a.size, b.p * b.size)
        loss = F.least(a.p * a.size, (1.0 - b.p) * b.size)
        rises = u * (gain + loss) < loss
        a_first = F.when(rises, (1.0 - a.p) * a.size <= b.p * b.size).otherwise(
            a.p * a.size <= (1.0 - b.p) * b.size
        )
        moved = F.when(rises, gain).otherwise(-loss)
        one = F.lit(1.0)
        rest_a = F.greatest(F.least(a.p + moved / F.greatest(a.size * one, one), one), F.lit(0.0))
        rest_b = F.greatest(F.least(b.p - moved / F.greatest(b.size * one, one), one), F.lit(0.0))
        up_a = F.when(rises, F.lit(1)).otherwise(F.lit(0))
        goes_on = F.when(a_first, unit(b, rest_b)).otherwise(unit(a, rest_a))
        loser = F.when(a_first, settled(a, up_a)).otherwise(settled(b, 1 - up_a))
        return F.struct(
            goes_on.cast(_UNIT).alias("rest"),
            F.concat(s.done, F.array(loser).cast(_DONE)).alias("done"),
        )

    first = F.struct(
        F.element_at(units, 1).cast(_UNIT).alias("rest"), F.array().cast(_DONE).alias("done")
    )
    return F.aggregate(F.slice(units, F.lit(2), F.size(units)), first, step)


def numbered_repeats(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with ``number``: 0, or from 0 on within the rows of one hash that are more than ``most``.

    Repeated rows are numbered in their part of the table, from where the parts before it end, so no
    task sees all of them. ``h`` is the hash and ``row`` an increasing id that is written with the rows.
    """
    part = F.shiftright("row", 33)
    hot = rows.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("h")
    hot = save(hot, "mix-repeats")
    met = rows.join(hot, "h", "left_semi").withColumn("part", part)
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = met.groupBy("h", "part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy("h", "part").orderBy("row")) - 1
    numbers = (
        met.select("h", "part", "row", place.alias("place"))
        .join(parts, ["h", "part"])
        .select("row", (F.col("first") + F.col("place")).alias("number"))
    )
    if hot.isEmpty():
        return rows.withColumn("number", F.lit(0).cast("long"))
    return rows.join(numbers, "row", "left").withColumn("number", F.coalesce("number", F.lit(0)))


def mix_sources(
    docs: DataFrame,
    share: float = 1.5,
    most: float = 2.0,
    weights: tuple = WEIGHTS,
    seed: int = 11,
    group: int = 256,
    keyed: bool = False,
) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` for every document.

    A document's copies are the whole part of target / source size, or one more. Within a source
    documents meet in classes of similar size (eighths of a power of two), split by hash into
    groups of about ``group`` rows, so a large source or class is many groups. Rounding walks
    through a group from the largest; the rest of each group meets the rests of its class, then
    those of its source, and the last one is rounded by chance. All choices follow hashes of id
    and text, so reruns agree; rows that repeat id and text are interchangeable, and where they are
    more than a group, they are numbered and dealt to the groups in turn. Null text has no
    words, null source is a source, an empty table gives no rows. A source without words has
    target 0 and takes nothing. ``keyed`` adds ``ROW_KEY``, made of id, source and text.
    """
    source_key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    h = F.xxhash64(F.lit(seed), "doc_id", "text", "source")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), h)
    rows = save(
        docs.select(
            "doc_id",
            "source",
            source_key.alias("source_key"),
            word_count(F.col("text")).alias("size"),
            h.alias("h"),
            (key if keyed else F.lit(None).cast("string")).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-rows",
    )
    rows = numbered_repeats(rows, group)
    sizes = rows.groupBy("source_key").agg(
        F.first("source", True).alias("source"),
        F.sum("size").alias("source_size"),
        F.count("*").alias("rows"),
    )
    plan = source_targets(sizes, share, most, weights)
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    plan = plan.withColumn("factor", F.coalesce(factor, F.lit(0.0)))
    plan = save(
        plan.withColumn("base", F.floor("factor").cast("long")).withColumn(
            "p", F.col("factor") - F.col("base")
        ),
        "mix-plan",
    )
    # a source that is one group needs no classes
    rank = F.when(F.col("rows") <= group, 0).otherwise(F.floor(F.log2(F.col("size") + 1) * 8))
    rows = rows.join(plan.select("source_key", "p", "rows"), "source_key").withColumn(
        "rank", rank.cast("int")
    )
    classes = rows.groupBy("source_key", "rank").agg(
        F.ceil(F.count("*") / F.lit(group)).cast("long").alias("buckets")
    )
    classes = save(classes, "mix-classes")
    most_buckets = classes.agg(F.max("buckets")).first()[0] or 1
    unit = F.struct("size", "h", "doc_id", "key", "p")
    units = (
        rows.join(classes, ["source_key", "rank"])
        .select(
            "source_key",
            "rank",
            F.pmod(F.shiftright("h", 20) + F.col("number"), F.col("buckets")).alias("bucket"),
            unit.alias("unit"),
        )
    )
    decided = None
    levels = 1 + math.ceil(math.log(most_buckets, group)) if most_buckets > 1 else 1
    for level in range(levels + 1):
        last = level == levels
        by = ["source_key"] if last else ["source_key", "rank", "bucket"]
        order = F.sort_array(F.collect_list("unit"), asc=False)
        rounded = save(
            units.groupBy(*by)
            .agg(order.alias("units"))
            .select(*by, round_group(F.col("units"), seed + level).alias("r")),
            "mix-level",
        )
        done = rounded.select("source_key", F.explode("r.done").alias("d")).select(
            "source_key", "d.*"
        )
        decided = done if decided is None else decided.unionByName(done)
        if last:
            rest = rounded.select("source_key", "r.rest.*")
            chance = _uniform(F.lit(seed), F.lit("last"), F.col("h"))
            up = (chance < F.col("p")).cast("int").alias("up")
            rest = rest.select("source_key", "size", "h", "doc_id", "key", up)
            decided = decided.unionByName(rest)
        else:
            up_by = [c for c in by if c != "bucket"]
            bucket = F.floor(F.col("bucket") / group).alias("bucket")
            units = rounded.select(*up_by, bucket, F.col("r.rest").alias("unit"))
    copies = F.col("base") + F.col("up")
    return decided.join(plan, "source_key").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
        *([F.col("key").alias(ROW_KEY)] if keyed else []),
    )


def mixed_documents(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    decided = mix_sources(docs, seed=seed, keyed=True, **options)
    copies = decided.groupBy(ROW_KEY).agg(F.sort_array(F.collect_list("copies")).alias("__copies"))
    h = F.xxhash64(F.lit(seed), "doc_id", "text", "source")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), h)
    place = F.row_number().over(Window.partitionBy(ROW_KEY).orderBy("doc_id"))
    often = F.element_at("__copies", F.col("__place"))
    return (
        docs.withColumn(ROW_KEY, key)
        .join(copies, ROW_KEY)
        .withColumn("__place", place)
        .withColumn("__often", often)
        .filter("__often > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__often"))))
        .select(*docs.columns)
    )

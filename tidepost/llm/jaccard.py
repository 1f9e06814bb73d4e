"""Join of texts whose sets of word shingles have a Jaccard similarity of 0.75 or more.

The T-occurrence bound decides what is compared: texts x and y that are similar share at least
T = ceil(0.75 |x|) shingles, so y occurs in one of the |x| - T + 1 shortest inverted lists of x's
shingles. These short lists of both sides are joined, which gives the candidates; the long ones are
never merged. This is less than T-occurrence search by name: occurrences are not counted over the merged
lists, and no long inverted list is probed, since such a list has no single place in Spark. Each
candidate pair's own sorted shingles are compared instead, by binary search, and pairs with the
required overlap are retained.

Equal sets are one class, and only classes are compared. A shingle of one class alone has a list
that nobody shares, so it is counted but not kept; most texts end there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import ROW_KEY, bounded_batches, keep_keyed, row_key, save
from tidepost.llm.graph import components
from tidepost.llm.spans import mixed, shingle_sets, slices

WORDS, PERCENT = 5, 75
_MANY = -1


def _class_keys(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number for each set, equal for equal sets."""
    padded = np.append(mixed(sets + np.uint64(0x9E3779B97F4A7C15)), np.uint64(0))
    sums = np.add.reduceat(padded, bounds[:-1])
    sums[np.diff(bounds) == 0] = 0
    return mixed(sums + np.diff(bounds).astype(np.uint64)).view(np.int64)


def text_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n_shingles, class``: texts with equal sets have one class.

    ``mark`` is a hash of the text as it is.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                sets, bounds = shingle_sets(part.column(2), WORDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(np.diff(bounds)),
                        pa.array(_class_keys(sets, bounds)),
                    ],
                    ["doc_id", "mark", "n_shingles", "class"],
                )

    mark = F.xxhash64("text").alias("mark")
    return docs.select(F.col("doc_id").cast("long"), mark, "text").mapInArrow(
        read, "doc_id bigint, mark bigint, n_shingles bigint, class bigint"
    )


def _planes(names: np.ndarray) -> bytes:
    """Sorted numbers, first bytes first: those repeat, so that the shuffle's compression helps."""
    return np.ascontiguousarray(names.astype(">i8").view("u1").reshape(-1, 8).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    whole = np.ascontiguousarray(np.frombuffer(data, "u1").reshape(8, -1).T)
    return whole.view(">i8").ravel().astype(np.int64)


def _bucketed(sets: np.ndarray, bounds: np.ndarray, keys: np.ndarray, buckets: int):
    """Rows ``bucket, classes, places, low, high, direct`` of some texts.

    A bucket's row has the shingles that fall into it in the order of their classes: ``low`` and
    ``high`` bits, and a bit in ``places`` where the next of ``classes`` (see ``_planes``) begins.
    Shingles that several of these texts share are there once, for the class ``_MANY``; which texts
    have them goes along as ``direct``.
    """
    first = np.unique(keys, return_index=True)[1]
    chosen = np.zeros(len(keys), dtype=bool)
    chosen[first] = True
    text = np.repeat(np.arange(len(keys)), np.diff(bounds))
    sets, text = sets[chosen[text]], text[chosen[text]]
    order = np.argsort(sets, kind="stable")
    sorted_sets = sets[order]
    same = np.zeros(len(sets) + 1, dtype=bool)
    same[1:-1] = sorted_sets[1:] == sorted_sets[:-1]
    shared = np.empty(len(sets), dtype=bool)
    shared[order] = same[1:] | same[:-1]
    leaders = np.empty(len(sets), dtype=bool)
    leaders[order] = ~same[:-1] & same[1:]
    classes = keys[text]
    token = sets.view(np.int64)
    direct = np.flatnonzero(shared)
    alone = np.flatnonzero(~shared | leaders)
    owner = np.where(shared[alone], np.int64(_MANY), classes[alone])
    bucket = ((sets[alone] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.lexsort((owner, bucket))
    alone, owner, bucket = alone[by_bucket], owner[by_bucket], bucket[by_bucket]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    pieces = np.array_split(direct, buckets)
    for b in range(buckets):
        part = slice(edges[b], edges[b + 1])
        if edges[b] == edges[b + 1] and not len(pieces[b]):
            continue
        names, place = np.unique(owner[part], return_inverse=True)
        tokens = sets[alone[part]]
        yield (
            b,
            _planes(names),
            np.packbits(np.diff(place, prepend=0).astype(bool)).tobytes(),
            (tokens & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(),
            (tokens >> np.uint64(32)).astype("<u4").tobytes(),
            np.stack([classes[pieces[b]], token[pieces[b]]]).tobytes(),
        )


_BUCKETED = (
    "bucket int, classes binary, places binary, low binary, high binary, direct binary"
)


def shared_shingles(docs: DataFrame, total: int, per_bucket: int, flush: int) -> DataFrame:
    """``class, token`` for the shingles that more than one class may have.

    Every task divides the shingles of its texts by hash into buckets of about ``per_bucket`` and
    sends them packed, once per text (or once per task, if several of its texts have it); a bucket
    finds out which came from several classes. So a shingle of very many texts arrives once per
    task. Rows of a class that came up in several tasks may repeat.
    """
    buckets = max(1, min(1 << 23, math.ceil(total / per_bucket)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def rows():
            sets = np.concatenate([h[0] for h in held])
            lengths = np.concatenate([np.diff(h[1]) for h in held])
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            keys = np.concatenate([h[2] for h in held])
            columns = list(zip(*_bucketed(sets, bounds, keys, buckets), strict=True))
            types = [pa.int32(), *[pa.binary()] * 5]
            names = ["bucket", "classes", "places", "low", "high", "direct"]
            columns = columns or [()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                sets, bounds = shingle_sets(part.column(0), WORDS)
                full = np.flatnonzero(np.diff(bounds))
                keys = _class_keys(sets, bounds)[full]
                held.append((sets, np.append(bounds[full], bounds[-1]), keys))
                size += len(sets)
                if size >= flush or sum(len(h[2]) for h in held) > 20_000:
                    yield rows()
                    held, size = [], 0
        if held:
            yield rows()

    def decide(group: pa.Table) -> pa.Table:
        classes, tokens, direct = [], [], []
        for row in group.select(["classes", "places", "low", "high", "direct"]).to_pylist():
            low = np.frombuffer(row["low"], "<u4").astype(np.uint64)
            steps = np.unpackbits(np.frombuffer(row["places"], "u1"), count=len(low))
            classes.append(_from_planes(row["classes"])[np.cumsum(steps, dtype=np.int64)])
            high = np.frombuffer(row["high"], "<u4").astype(np.uint64)
            tokens.append((high << np.uint64(32) | low).view(np.int64))
            direct.append(np.frombuffer(row["direct"], np.int64).reshape(2, -1))
        owner, token = np.concatenate(classes), np.concatenate(tokens)
        order = np.lexsort((owner, token))
        owner, token = owner[order], token[order]
        fresh = np.ones(len(token), dtype=bool)
        fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        owner, token = owner[fresh], token[fresh]
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)])
        if len(starts):
            count = np.diff(np.append(starts, len(token)))
            many = np.logical_or.reduceat(owner == _MANY, starts) | (count > 1)
            kept = np.repeat(many, count) & (owner != _MANY)
        else:
            kept = np.zeros(0, dtype=bool)
        direct = np.concatenate(direct, axis=1)
        return pa.table(
            {
                "class": np.concatenate([owner[kept], direct[0]]),
                "token": np.concatenate([token[kept], direct[1]]),
            }
        )

    dealt = docs.select("text").mapInArrow(deal, _BUCKETED)
    return dealt.groupBy("bucket").applyInArrow(decide, "class bigint, token bigint")


def _required(n: Column | str) -> Column:
    """Shingles that a set of ``n`` shares at least with a similar one."""
    n = F.col(n) if isinstance(n, str) else n
    return F.ceil(n * PERCENT / 100)


def _verified(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that are similar, by probing one sorted list of shingles in the other."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column(2), batch.column(3)
            x_all, x_at = xs.flatten().to_numpy(), np.asarray(xs.offsets) - xs.offsets[0].as_py()
            y_all, y_at = ys.flatten().to_numpy(), np.asarray(ys.offsets) - ys.offsets[0].as_py()
            sizes = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            kept = np.zeros(len(batch), dtype=bool)
            for i in range(len(batch)):
                x, y = x_all[x_at[i] : x_at[i + 1]], y_all[y_at[i] : y_at[i + 1]]
                if len(x) > len(y):
                    x, y = y, x
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                overlap = int((y[place] == x).sum())
                kept[i] = 100 * overlap >= PERCENT * (sizes[i] - overlap)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(kept)), batch.column(1).filter(pa.array(kept))],
                ["a", "b"],
            )

    left = lists.select(F.col("class").alias("a"), F.col("tokens").alias("x"), F.col("n").alias("nx"))
    right = lists.select(F.col("class").alias("b"), F.col("tokens").alias("y"), F.col("n").alias("ny"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "nx", "ny")
    return met.mapInArrow(probe, "a bigint, b bigint")


#: What is known of a class in a merged list: size, shared shingles, place of the list among its own.
_KNOWN = ("n", "m", "place")


def _possible(pairs: DataFrame) -> DataFrame:
    """Pairs that can be similar, by what their list says.

    Similar sets share at least 3/7 of both sizes together. They can't share more than the shared
    shingles that either has, from the list on, which is the first that they have in common (if it
    isn't, the pair comes up in that one).
    """
    most = F.least(*[F.col(f"m{x}") - F.col(f"place{x}") + 1 for x in "ab"])
    least = (F.col("na") + F.col("nb")) * PERCENT
    return pairs.filter((F.col("a") != F.col("b")) & (most * (100 + PERCENT) >= least))


def _side(short: DataFrame, x: str) -> DataFrame:
    """A list's classes as one side of a pair."""
    names = {"class": x, "label": f"label{x}"} | {k: f"{k}{x}" for k in _KNOWN}
    return short.select("token", *[F.col(k).alias(v) for k, v in names.items()])


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def class_links(
    shared: DataFrame, sizes: DataFrame, rounds: int = 8, pairs_per_row: int = 4
) -> DataFrame | None:
    """Links ``a, b`` from a class to the smallest that similar pairs reach; None without links.

    ``shared`` has ``class, token``, ``sizes`` has ``class, n``. The shingles of a class travel as
    one array. Texts with fewer shared shingles than required are out. Of what is left, the classes in a merged list are first compared with
    one of them, the one whose shingles are shared most; what that connects needs no comparison
    any more. This is repeated with other members while unconnected pairs would be many and become
    fewer. In the end all pairs that no link connects are compared, if sizes, shared shingles and
    the list's place allow the overlap.
    """
    sets = shared.groupBy("class").agg(F.collect_set("token").alias("tokens")).join(sizes, "class")
    sets = save(sets.filter(F.size("tokens") >= _required("n")), "jaccard-shared")
    entries = sets.select("class", F.explode("tokens").alias("token"))
    lengths = entries.groupBy("token").agg(F.count("*").alias("length")).filter("length > 1")
    listed = entries.join(lengths, "token").groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("length", "token"))).alias("by_length")
    )
    listed = listed.join(sizes, "class").withColumn("m", F.size("by_length").cast("long"))
    listed = listed.filter(F.col("m") >= _required("n"))
    merged = (F.col("m") - _required("n") + 1).cast("int")
    listed = save(
        listed.select(
            "class",
            "n",
            "m",
            F.sort_array("by_length.token").alias("tokens"),
            F.slice("by_length.token", F.lit(1), merged).alias("merged"),
        ),
        "jaccard-lists",
    )
    lists = listed.select("class", "n", "tokens")
    short = listed.select("class", "n", "m", F.posexplode("merged").alias("place", "token"))
    short = short.withColumn("place", F.col("place") + 1)
    own = (F.col("n") - F.col("m")) / F.col("n")
    short = save(
        short.select("token", "class", *_KNOWN, own.alias("own"), F.col("class").alias("label")),
        "jaccard-short",
    )
    links, before = None, math.inf
    for turn in range(rounds + 1):
        by_label = short.groupBy("token", "label").agg(F.count("*").alias("c"))
        unsettled = by_label.groupBy("token").agg(
            F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("s"), F.count("*").alias("k")
        )
        unsettled = unsettled.filter("k > 1")
        short = save(short.join(unsettled.select("token"), "token", "left_semi"), "jaccard-short")
        rows, pairs = (
            unsettled.agg(F.sum("c"), F.sum((F.col("c") * F.col("c") - F.col("s")) / 2)).first()
        )
        if not rows:
            break
        few = pairs <= pairs_per_row * rows + 50_000
        last = turn == rounds or (turn > 0 and few) or pairs > 0.9 * before
        before = pairs
        if last:
            other = _side(short, "b")
            possible = F.col("a") < F.col("b")
        else:
            order = [F.col("own")] if not turn else []
            order += [F.xxhash64(F.lit(turn), "class").alias("h"), "class", "label", *_KNOWN]
            pivots = short.groupBy("token").agg(F.min(F.struct(*order)).alias("p"))
            other = _side(pivots.select("token", "p.*"), "b")
            possible = F.lit(True)
        found = _side(short, "a").join(other, "token").filter("labela <> labelb")
        found = _possible(found.filter(possible))
        found = save(_verified(_ordered(found), lists), "jaccard-links")
        # what links have connected so far is kept as one link for each class
        links = components(found if links is None else links.unionByName(found)).select(
            F.col("node").alias("a"), F.col("label").alias("b")
        )
        if last:
            break
        labels = links.select(F.col("a").alias("class"), F.col("b").alias("reached"))
        short = short.join(labels, "class", "left").select(
            "token", "class", *_KNOWN, "own", F.coalesce("reached", "class").alias("label")
        )
    return links


def _labelled(docs: DataFrame, per_bucket: int, flush: int) -> tuple[DataFrame, DataFrame]:
    """Classes of all documents, and ``class, least, label`` of those with words."""
    bounded_batches(docs.sparkSession)
    classed = save(text_classes(docs), "jaccard-classes")
    total = classed.agg(F.sum("n_shingles")).first()[0] or 0
    sizes = (
        classed.filter("n_shingles > 0")
        .groupBy("class")
        .agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("least"))
    )
    sizes = save(sizes, "jaccard-sizes")
    shared = save(shared_shingles(docs, total, per_bucket, flush), "jaccard-all")
    links = class_links(shared, sizes.select("class", "n"))
    if links is None:
        return classed, sizes.select("class", "least", F.col("class").alias("label"))
    labels = links.select(F.col("a").alias("class"), F.col("b").alias("label"))
    labelled = sizes.join(labels, "class", "left").select(
        "class", "least", F.coalesce("label", "class").alias("label")
    )
    return classed, save(labelled, "jaccard-labels")


def similar_groups(docs: DataFrame, per_bucket: int = 1_500_000, flush: int = 700_000) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document.

    A document's set has the hashes of the 5-word shingles of its whole text, lower-cased (A-Z);
    fewer words are one shingle, null or blank texts have none and are linked with nothing.
    ``component_id`` is the smallest id that links of similarity 0.75 or more reach (its own id
    for a text without words; null if no member has an id). Rows that repeat an id are documents
    like others, an empty table gives no rows, other columns play no part. 64-bit hashes stand for
    shingles and for sets.
    """
    classed, labelled = _labelled(docs, per_bucket, flush)
    heads = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    reached = labelled.join(heads, "label").select("class", "component_id")
    alone = classed.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return (
        classed.filter("n_shingles > 0")
        .join(reached, "class")
        .select("doc_id", "n_shingles", "component_id")
        .unionByName(alone)
    )


def drop_similar(docs: DataFrame, per_bucket: int = 1_500_000, flush: int = 700_000) -> DataFrame:
    """One document of each group, with the columns of ``docs``.

    The smallest id stays (null last, then by a hash of the text); texts without words all stay,
    but for rows that repeat both id and text.
    """
    classed, labelled = _labelled(docs, per_bucket, flush)
    mark = F.col("mark").cast("string")
    key = row_key(F.col("doc_id"), mark).alias(ROW_KEY)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first")
    by_class = classed.filter("n_shingles > 0").groupBy("class").agg(first)
    heads = by_class.join(labelled, "class").groupBy("label").agg(F.min("first").alias("first"))
    kept = heads.select("first.doc_id", F.col("first.mark")).select(key)
    alone = classed.filter("n_shingles = 0").select(key).distinct()
    own = row_key(F.col("doc_id").cast("long"), F.xxhash64("text").cast("string"))
    return keep_keyed(docs, own, kept.unionByName(alone))

"""Nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced partitions; a small classifier learns
which partition a vector belongs to. Every row is filed under its most probable partition, a
query visits its most probable ones, and what it meets there is ranked by exact distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import bounded_batches, save


def valid_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the vectors that take part.

    Null, empty and zero vectors and those with null or non-finite parts take no part, nor do
    vectors of another than the most frequent length, or without an id.
    """
    vector = F.col("embedding").cast("array<double>")
    fit = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    good = rows.select("vec_id", vector.alias("embedding")).filter(
        F.col("vec_id").isNotNull()
        & fit
        & F.exists("embedding", lambda x: x != 0)
    )
    sizes = good.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n"))
    size = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).first()
    return good.filter(F.size("embedding") == (size["size"] if size else 0))


def neighbour_graph(x: np.ndarray, neighbours: int) -> np.ndarray:
    """Numbers of the nearest rows of each row, itself excluded."""
    out = np.empty((len(x), neighbours), np.int64)
    square = (x * x).sum(axis=1)
    for a in range(0, len(x), 512):
        d = square[None] - 2 * x[a : a + 512] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a : a + 512] = np.argpartition(d, neighbours - 1, axis=1)[:, :neighbours]
    return out


def _weights(graph: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Sum of ``side`` over the neighbours of each row, in both directions of an edge."""
    out = side[graph].sum(axis=1)
    np.add.at(out, graph.ravel(), np.repeat(side, graph.shape[1]))
    return out


def balanced_partitions(x: np.ndarray, graph: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """Partition of each row: the graph halved again and again, with few edges cut.

    A half starts from the main direction of its rows and is improved by exchanging equally many
    rows that have most neighbours on the other side.
    """
    rng = np.random.default_rng(seed)
    label = np.zeros(len(x), np.int64)
    count = 1
    while count < parts:
        for part in range(count):
            rows = np.flatnonzero(label == part)
            if len(rows) < 2:
                continue
            center = x[rows] - x[rows].mean(axis=0)
            direction = rng.normal(size=x.shape[1])
            for _ in range(8):
                direction = center.T @ (center @ direction)
                direction /= max(np.linalg.norm(direction), 1e-12)
            order = np.argsort(center @ direction, kind="stable")
            side = np.zeros(len(x))
            side[rows[order[: len(rows) // 2]]] = -1.0
            side[rows[order[len(rows) // 2 :]]] = 1.0
            for _ in range(12):
                pull = _weights(graph, side)[rows] * side[rows]
                left, right = rows[side[rows] < 0], rows[side[rows] > 0]
                gain_left, gain_right = -pull[side[rows] < 0], -pull[side[rows] > 0]
                a = left[np.argsort(-gain_left, kind="stable")]
                b = right[np.argsort(-gain_right, kind="stable")]
                both = min(len(a), len(b))
                gain = np.sort(gain_left)[::-1][:both] + np.sort(gain_right)[::-1][:both]
                moves = int((gain > 0).sum()) // 2
                if not moves:
                    break
                side[a[:moves]], side[b[:moves]] = 1.0, -1.0
            label[rows[side[rows] > 0]] = part + count
        count *= 2
    return label


class Router:
    """One hidden layer; probabilities of the partitions of a vector."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int, seed: int, steps: int):
        """``target`` has a row of partition shares for each row of ``x``."""
        rng = np.random.default_rng(seed)
        self.scale = 1.0 / max(float(np.sqrt((x * x).mean())), 1e-12)
        sizes = [(x.shape[1], hidden), (hidden,), (hidden, target.shape[1]), (target.shape[1],)]
        self.p = [rng.normal(0, 1 / math.sqrt(s[0]), s) if len(s) > 1 else np.zeros(s) for s in sizes]
        m, v = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(x), min(256, len(x)))
            inputs = x[rows] * self.scale
            h = np.maximum(inputs @ self.p[0] + self.p[1], 0)
            error = (self._softmax(h @ self.p[2] + self.p[3]) - target[rows]) / len(rows)
            back = (error @ self.p[2].T) * (h > 0)
            grads = [inputs.T @ back, back.sum(axis=0), h.T @ error, error.sum(axis=0)]
            rate = 0.004 * (1 - step / (steps + 1))
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                move = m[i] / (1 - 0.9**step) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-9)
                self.p[i] = self.p[i] - rate * move

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(x * self.scale @ self.p[0] + self.p[1], 0)
        return self._softmax(h @ self.p[2] + self.p[3])


def learn_partitions(
    x: np.ndarray, parts: int, neighbours: int, recall: float, seed: int = 1, every: int = 5
) -> tuple[Router, int]:
    """The classifier, and how many partitions a query has to visit for ``recall``.

    Each ``every``-th row of the sample is kept from training. The visits are counted on those: their
    true neighbours in the sample are looked for in their most probable partitions.
    """
    graph = neighbour_graph(x, min(neighbours, len(x) - 1))
    label = balanced_partitions(x, graph, parts, seed)
    parts = int(label.max()) + 1
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 1.0)
    target[np.arange(len(x)), label] += graph.shape[1] / 2
    target /= target.sum(axis=1, keepdims=True)
    held_out = np.arange(len(x)) % every == every - 1 if len(x) >= 20 * every else np.ones(len(x), bool)
    learned = np.flatnonzero(~held_out) if not held_out.all() else np.arange(len(x))
    router = Router(x[learned], target[learned], 128, seed, 1500)
    probable = router(x)
    filed = probable.argmax(axis=1)
    order = np.argsort(-probable, axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None], axis=1)
    asked = np.flatnonzero(held_out)
    visit = np.sort(place[asked[:, None], filed[graph[asked]]].ravel())
    visits = int(visit[min(len(visit) - 1, math.ceil(recall * len(visit)))]) + 1
    return router, visits


def _nearest(queries: np.ndarray, query_ids, rows: np.ndarray, ids, k: int) -> list[tuple]:
    """``query_id, vec_id, score`` of the ``k`` nearest ids of each query, its own excluded.

    By exact distance, ties by id; an id counts with its nearest row.
    """
    out = []
    square = (rows * rows).sum(axis=1)
    repeated = len(np.unique(ids)) < len(ids)
    for q, query_id in zip(queries, query_ids, strict=True):
        rough = square - 2 * (rows @ q)
        rough[ids == query_id] = np.inf
        if len(rough) > k and not repeated:
            edge = np.partition(rough, k - 1)[k - 1]
            # rounding of the rough measure must not cut a tie
            room = 1e-9 * (square.max() + float(q @ q)) + 1e-12
            near = np.flatnonzero(rough <= edge + room)
        else:
            near = np.arange(len(rough))
        near = near[ids[near] != query_id]
        exact = np.sqrt(((rows[near] - q) ** 2).sum(axis=1))
        order = np.lexsort((ids[near], exact))
        if repeated:
            _, first = np.unique(ids[near[order]], return_index=True)
            order = order[np.sort(first)]
        best = order[:k]
        out += [(query_id, i, e) for i, e in zip(ids[near[best]].tolist(), exact[best].tolist())]
    return out


def _different(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and ids, each pair once."""
    order = np.lexsort((*rows.T, ids))
    ids, rows = ids[order], rows[order]
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1]).any(axis=1)
    return rows[fresh], ids[fresh]


def _vectors(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = part.column(4)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return part.column(3).to_numpy(), flat.reshape(len(column), -1)


def _found(placed: DataFrame, visiting: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of each block for the queries that visit it.

    A block's rows come first in a task's order; once they are read, the queries stream past them, so
    rows are sent once, however many queries there are.
    """
    columns = ["part", "block", "kind", "vec_id", "embedding"]
    both = placed.withColumn("kind", F.lit(0)).select(*columns).unionByName(
        visiting.withColumn("kind", F.lit(1)).select(*columns)
    )
    dealt = both.repartition("part", "block").sortWithinPartitions("part", "block", "kind")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            edges = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)], strict=True):
                if a == b:
                    continue
                if at != tuple(keys[a, :2]):
                    at, parts, block = tuple(keys[a, :2]), [], None
                ids, vectors = _vectors(batch.slice(a, b - a))
                if keys[a, 2] == 0:
                    parts.append((ids, vectors))
                    continue
                if block is None:
                    if not parts:
                        continue
                    ids_, rows = (np.concatenate(c) for c in zip(*parts, strict=True))
                    block, parts = _different(ids_, rows), []
                found = _nearest(vectors, ids.tolist(), *block, k)
                if found:
                    query, near, score = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query, pa.int64()), pa.array(near, pa.int64()), pa.array(score, pa.float64())],
                        ["query_id", "vec_id", "score"],
                    )

    return dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score double")


def nearest(
    rows: DataFrame,
    every: int = 100,
    k: int = 10,
    sample: int = 4096,
    rows_per_block: int = 4096,
    recall: float = 0.97,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found for each row whose id ``every`` divides.

    The sample (the ``sample`` first by hash of the id) reaches the driver; graph, partitions,
    classifier and number of visits come from it. All vectors are filed. There are about
    sqrt(rows) / 4 partitions, at most 256. A partition is split by hash of the row into blocks of
    about ``rows_per_block`` rows, so a partition of many equal vectors is many blocks. The best of a
    block are ranked again over all blocks; a query that has found fewer than ``k`` in the
    partitions it visits searches all of them. ``score`` is the Euclidean distance of the original
    vectors in double precision, ties go to the smaller id. Rows that repeat an id are one candidate, the
    nearest of them, and one query, with the vector that comes first in order. What takes no part is
    said at ``valid_vectors``; an empty table gives no rows.
    """
    spark = rows.sparkSession
    bounded_batches(spark, rows=5_000)
    vectors = save(valid_vectors(rows), "nearest-vectors")
    count = vectors.count()
    if count < 2:
        empty = "query_id bigint, rank int, vec_id bigint, score double"
        return spark.createDataFrame([], empty)
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(sample)
    x = np.array([r.embedding for r in drawn.select("embedding").collect()])
    parts = 2 ** max(0, min(8, round(math.log2(math.sqrt(count) / 4))))
    router, visits = learn_partitions(x, parts, k, recall)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            probable = router(np.array(batch["embedding"].tolist(), dtype=float))
            order = np.argsort(-probable, axis=1)[:, :visits]
            batch["visits"] = list(order.astype(np.int32))
            yield batch

    filed = save(
        vectors.mapInPandas(route, "vec_id bigint, embedding array<double>, visits array<int>"),
        "nearest-filed",
    )
    items = filed.select("vec_id", "embedding", F.col("visits")[0].alias("part"))
    asked = filed.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.min(F.struct("embedding", "visits")).alias("first")
    )
    asked = save(asked.select("vec_id", "first.*"), "nearest-asked")
    blocks = items.groupBy("part").agg(
        F.ceil(F.count("*") / F.lit(rows_per_block)).cast("int").alias("blocks")
    )
    blocks = F.broadcast(blocks)  # one row for each of at most 256 partitions
    placed = items.join(blocks, "part").select(
        "part",
        F.pmod(F.xxhash64("vec_id", "embedding"), F.col("blocks")).cast("int").alias("block"),
        "vec_id",
        "embedding",
    )

    def ranked(queries: DataFrame) -> DataFrame:
        visiting = (
            queries.select(F.explode("visits").alias("part"), "vec_id", "embedding")
            .join(blocks, "part")
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        )
        best = _found(placed, visiting, k).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    found = save(ranked(asked), "nearest-found")
    enough = found.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = save(asked.join(enough, "vec_id", "left_anti"), "nearest-short")
    if not short.isEmpty():
        filled = sorted(r.part for r in items.select("part").distinct().collect())
        wide = ranked(short.withColumn("visits", F.array(*[F.lit(p) for p in filled])))
        again = short.select(F.col("vec_id").alias("query_id"))
        found = found.join(again, "query_id", "left_anti").unionByName(wide)
    return found.select("query_id", "rank", "vec_id", "score")

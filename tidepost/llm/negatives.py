"""Hard negatives: threshold joins of anchors with all rows by inner product, after L2AP.

Rows are dealt to blocks, and a block keeps an inverted index in groups of dimensions, those with the
most weight first. Groups whose remaining norm can't lift a row to the threshold by itself are
omitted from the index. Anchors that arrive at a block accumulate partial scores group by group; pairs
that the norms of the remaining groups can't lift to the threshold are pruned, the others are
finished on the row's own components. Thresholds begin high and are lowered until windows fill, in
each anchor's own block; what fills a window there bounds the search in all the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import bounded_batches, save
from tidepost.llm.whitening import matrix, usable

#: Components are at most this large, so that scores of up to 127 dimensions fit a long.
LARGEST = 2**28
#: Dimensions that are accumulated between two looks at the bounds.
GROUP = 8
#: Pairs whose partial scores a worker holds at once.
PAIRS = 4 << 20
_EXACT = 2.0**53
_LOWEST = -(2**63)
_NONE = np.iinfo(np.int64).max


class Index:
    """Inverted index of a block's rows for scores of at least ``threshold``.

    ``length`` is the number of indexed groups of a row: from there on, its norm times ``reach`` (the
    largest norm of an anchor) stays below the threshold. Rows are sorted by it, so that those in a
    group's list are the first ones.
    """

    def __init__(self, rows: np.ndarray, order: np.ndarray, threshold: float, reach: float):
        rows = rows[:, order]
        self.groups = [slice(a, a + GROUP) for a in range(0, rows.shape[1], GROUP)]
        rest = self.remaining(rows)
        length = (rest * reach >= threshold).sum(axis=1)
        length = np.minimum(length, len(self.groups))
        self.place = np.argsort(-length, kind="stable")
        self.rows, self.rest, self.length = rows[self.place], rest[self.place], length[self.place]
        self.listed = [int((self.length > g).sum()) for g in range(len(self.groups))]
        self.order = order

    def remaining(self, x: np.ndarray) -> np.ndarray:
        """Norm of the groups from each one on; 0 after the last."""
        squares = np.stack([(x[:, g] ** 2).sum(axis=1) for g in self.groups], axis=1)
        out = np.zeros((len(x), len(self.groups) + 1))
        out[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
        return out * (1 + 1e-9)

    def pairs(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """Anchor, row and score of all pairs whose score is at least the anchor's ``least``."""
        q = anchors[:, self.order]
        rest = self.remaining(q)
        part = np.zeros((len(q), len(self.rows)))
        edge = least - 0.5
        for g, columns in enumerate(self.groups):
            count = self.listed[g]
            if not count:
                break
            part[:, :count] += q[:, columns] @ self.rows[:count, columns].T
            if g >= len(self.groups) // 2:
                done = np.minimum(self.length, g + 1)
                live = self._live(part, rest, done, edge)
                if np.count_nonzero(live) * 10 < live.size:
                    return self._finish(q, rest, part, live, done, edge)
        return self._finish(
            q, rest, part, self._live(part, rest, self.length, edge), self.length, edge
        )

    def _live(self, part, rest, done, edge) -> np.ndarray:
        room = rest[:, done] * self.rest[np.arange(len(self.rows)), done]
        return part + room >= edge[:, None]

    def _finish(self, q, rest, part, live, done, edge) -> tuple[np.ndarray, ...]:
        """Scores of live pairs: the groups that are not in yet, pruned by what is left."""
        a, r = np.nonzero(live)
        score, at = part[a, r], done[r]
        for g, columns in enumerate(self.groups):
            if not len(a):
                break
            due = np.flatnonzero(at <= g)
            if not len(due):
                continue
            more = np.einsum("ij,ij->i", q[a[due], columns], self.rows[r[due], columns])
            score[due] += more
            keep = np.ones(len(a), dtype=bool)
            left = rest[a[due], g + 1] * self.rest[r[due], g + 1]
            keep[due] = score[due] + left >= edge[a[due]]
            a, r, score, at = a[keep], r[keep], score[keep], at[keep]
        keep = score >= edge[a]
        return a[keep], self.place[r[keep]], np.rint(score[keep]).astype(np.int64)


def all_pairs(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same for components whose scores doubles can't hold, by whole numbers."""
    scores = anchors.astype(np.int64) @ rows.astype(np.int64).T
    a, r = np.nonzero(scores >= least[:, None].astype(np.float64))
    return a, r, scores[a, r]


class Block:
    """The rows of a block; each (id, label, vector) once."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.lexsort((*x.T, labels, ids))
        ids, labels, x = ids[order], labels[order], x[order]
        fresh = np.ones(len(ids), dtype=bool)
        fresh[1:] = (
            (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (x[1:] != x[:-1]).any(axis=1)
        )
        self.ids, self.labels, self.whole = ids[fresh], labels[fresh], x[fresh]
        self.x = self.whole.astype(np.float64)
        self.heavy = np.argsort(-(self.x**2).sum(axis=0), kind="stable")
        self.norm = float(np.sqrt((self.x**2).sum(axis=1).max()))

    def search(self, ids, labels, x, low, high, same: bool, k: int, lower: bool) -> list[tuple]:
        """``(anchor, window, row, score)``: each window's ``k`` best of this block.

        ``low`` and ``high`` bound the scores of an anchor's windows; a window with ``low`` above
        ``high`` is empty. With ``lower``, thresholds begin near ``high`` and go down to ``low``
        until all windows of an anchor are full; else they are ``low`` at once.
        """
        q = x.astype(np.float64)
        norm = np.sqrt((q**2).sum(axis=1))
        exact = self.norm * norm.max() < _EXACT
        most = np.minimum(high.astype(np.float64), (norm * self.norm)[:, None])
        floor = np.where(low > high, np.inf, np.maximum(low, -_EXACT * 4).astype(np.float64))
        waiting = np.flatnonzero(np.isfinite(floor).any(axis=1))
        share, found = (0.75 if lower else 0.0), []
        while len(waiting):
            bottom = np.maximum(floor, -(norm * self.norm)[:, None] - 1)
            level = np.where(np.isfinite(floor), bottom + share * np.maximum(most - bottom, 0), np.inf)
            least = level[waiting].min(axis=1)
            by = np.argsort(-least, kind="stable")
            waiting, least = waiting[by], least[by]
            step = max(1, PAIRS // len(self.ids))
            again, index = [], None
            if exact:
                index = Index(self.x, self.heavy, float(least.min()), float(norm[waiting].max()))
            for at in range(0, len(waiting), step):
                some = waiting[at : at + step]
                if index is not None:
                    a, r, s = index.pairs(q[some], least[at : at + step])
                else:
                    a, r, s = all_pairs(x[some], self.whole, least[at : at + step])
                alike = self.labels[r] == labels[some][a]
                keep = (alike if same else ~alike) & (self.ids[r] != ids[some][a])
                a, r, s = a[keep], r[keep], s[keep]
                cut = np.searchsorted(a, np.arange(len(some) + 1))
                for i, anchor in enumerate(some.tolist()):
                    rows, scores = r[cut[i] : cut[i + 1]], s[cut[i] : cut[i + 1]]
                    hits, full = [], True
                    for w in range(low.shape[1]):
                        if low[anchor, w] > high[anchor, w]:
                            continue
                        fits = (scores <= high[anchor, w]) & (scores >= low[anchor, w])
                        best = np.lexsort((self.ids[rows[fits]], -scores[fits]))[:k]
                        full &= len(best) == k
                        hits += [
                            (anchor, w, int(self.ids[rows[fits][b]]), int(scores[fits][b]))
                            for b in best.tolist()
                        ]
                    if full or share == 0:
                        found += hits
                    else:
                        again.append(anchor)
            waiting, share = np.array(again, dtype=np.int64), (share / 3 if share > 0.1 else 0.0)
        return found


def _searched(rows: DataFrame, asked: DataFrame, same: bool, k: int, lower: bool) -> DataFrame:
    """``anchor, window, vec_id, score``: what each block has for the anchors sent to it.

    A block's rows come first in a task's order; once they are read, the anchors stream past them,
    so neither side has to fit into a group and rows are sent once.
    """
    none = F.lit(None)
    columns = ["block", "kind", "anchor", "vec_id", "label", "x", "low", "high"]
    stored = rows.select(
        "block",
        F.lit(0).alias("kind"),
        none.cast("long").alias("anchor"),
        "vec_id",
        "label",
        "x",
        none.cast("array<bigint>").alias("low"),
        none.cast("array<bigint>").alias("high"),
    )
    both = stored.unionByName(asked.withColumn("kind", F.lit(1)).select(*columns))
    dealt = both.repartition(F.col("block")).sortWithinPartitions("block", "kind")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, parts = None, None, []
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(blocks) | np.diff(kinds)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if blocks[a] != number:
                    number, block, parts = blocks[a], None, []
                if kinds[a] == 0:
                    parts.append((*_plain(part), matrix(part.column(5))))
                    continue
                if block is None:
                    if not parts:
                        continue
                    block = Block(*(np.concatenate(c) for c in zip(*parts, strict=True)))
                    parts = []
                ids, labels = _plain(part)
                found = block.search(
                    ids, labels, matrix(part.column(5)), matrix(part.column(6)),
                    matrix(part.column(7)), same, k, lower,
                )
                keys = part.column(2).to_numpy()
                if found:
                    anchor, window, row, score = (np.array(c) for c in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[anchor]),
                            pa.array(window.astype(np.int32)),
                            pa.array(row.astype(np.int64)),
                            pa.array(score.astype(np.int64)),
                        ],
                        ["anchor", "window", "vec_id", "score"],
                    )

    return dealt.select(*columns).mapInArrow(
        search, "anchor bigint, window int, vec_id bigint, score bigint"
    )


def _plain(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part.column(3).to_numpy(), part.column(4).to_numpy()


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each window over all blocks, with their ``rank``."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _sent(anchors: DataFrame, blocks: int) -> DataFrame:
    """Every anchor to all blocks."""
    return anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def _floors(best: DataFrame, k: int) -> DataFrame:
    """Score of the last place of every full window."""
    return best.filter(F.col("rank") == k).select("anchor", "window", F.col("score").alias("floor"))


def ceil_div(number, by: int):
    """``number / by`` rounded up, for whole numbers."""
    return F.expr(f"-((-({number}) - pmod(-({number}), {by})) div {by})")


def floor_div(number, by: int):
    return F.expr(f"(({number}) - pmod({number}, {by})) div {by}")


def mine(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    scale: float = 256,
    rows_per_block: int = 131_072,
    least_per_block: int = 4096,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, embedding, label``. Components become ``floor(scale * c)``, a score is the
    inner product of two rows; higher scores come first, then smaller ids. Anchors are the rows
    whose id ``every`` divides; an anchor's positives are its first other rows of the same label,
    and for each of them its first rows of another label follow whose score is between
    ``low_percent`` and ``high_percent`` of the positive's (so a negative positive has none).

    Rows with a null label, vector or component, with a component that isn't finite, with a vector
    of another length than the most frequent one, or without an id take no part. Rows that repeat
    id, label and vector count once; rows that share an id are no positives or negatives of each
    other, and each is an anchor. Components beyond 2 ** 28 count as that. An empty table, anchors
    without positives and positives without negatives give no rows; other columns play no part.
    All rows are read for every anchor; a block has at most about ``rows_per_block`` of them.
    """
    spark = rows.sparkSession
    bounded_batches(spark, rows=5_000)
    whole = F.transform(
        "vector",
        lambda c: F.floor(
            F.greatest(F.least(c * F.lit(float(scale)), F.lit(LARGEST)), F.lit(-LARGEST))
        ).cast("long"),
    )
    labelled = rows.filter("label IS NOT NULL AND vec_id IS NOT NULL")
    # the label rides along as a part of the key, which keeps the choice of vectors in one place
    keyed = labelled.select(F.struct("vec_id", "label").alias("vec_id"), "embedding")
    numbers = save(
        usable(keyed).select(
            F.col("vec_id.vec_id").cast("long").alias("vec_id"),
            F.col("vec_id.label").cast("long").alias("label"),
            whole.alias("x"),
        ),
        "negatives-rows",
    )
    count = numbers.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-count // rows_per_block), min(-(-count // least_per_block), partitions), 1)
    key = F.xxhash64("vec_id", "label", "x")
    stored = numbers.withColumn("block", F.pmod(key, F.lit(blocks)).cast("int"))
    home = stored.filter(F.col("vec_id") % every == 0).withColumn("anchor", key).distinct()

    def fill(anchors: DataFrame, same: bool, k: int, name: str) -> DataFrame:
        """Best of all windows: first in the home block, then above its floors in all blocks."""
        there = _floors(_best(_searched(stored, anchors, same, k, True), k), k)
        floors = there.groupBy("anchor").agg(
            F.map_from_entries(F.collect_list(F.struct("window", "floor"))).alias("floors")
        )
        raised = (
            anchors.join(floors, "anchor", "left")
            .withColumn(
                "low",
                F.transform("low", lambda v, i: F.coalesce(F.try_element_at("floors", i), v)),
            )
            .drop("block", "floors")
        )
        found = _searched(stored, _sent(save(raised, f"{name}-asked"), blocks), same, k, False)
        return save(_best(found, k), f"{name}-found")

    open_low = F.array(F.lit(_LOWEST).cast("long")).alias("low")
    open_high = F.array(F.lit(_NONE).cast("long")).alias("high")
    first = save(home.select("*", open_low, open_high), "negatives-anchors")
    near = fill(first, True, positives, "positives")
    window = F.struct(
        "rank",
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        ceil_div(f"{low_percent} * score", 100).alias("low"),
        floor_div(f"{high_percent} * score", 100).alias("high"),
    )
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(window)).alias("windows"))
    # a window that no positive fills is empty: its low is above its high
    place = F.sequence(F.lit(0), F.lit(positives - 1))
    asked = save(
        first.drop("low", "high")
        .join(windows, "anchor")
        .withColumns(
            {
                "low": F.transform(place, lambda i: F.coalesce(F.get("windows", i)["low"], F.lit(1))),
                "high": F.transform(place, lambda i: F.coalesce(F.get("windows", i)["high"], F.lit(0))),
            }
        ),
        "negatives-asked",
    )
    hard = fill(asked.drop("windows"), False, negatives, "negatives")
    told = asked.select(
        "anchor", F.col("vec_id").alias("anchor_id"), F.posexplode("windows").alias("window", "w")
    )
    return hard.join(told, ["anchor", "window"]).select(
        "anchor_id",
        "w.positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "w.positive_score",
        F.col("score").alias("negative_score"),
    )

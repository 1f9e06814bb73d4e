"""Substrings that repeat anywhere: suffix arrays of shards that hold all that can be equal.

Every string of ``length`` bytes chooses one anchor, the run of ``GRAM`` bytes in it with the least hash,
so equal strings choose equal anchors at the same distance. Neighbouring places of a text that choose the
same anchor make one piece. Pieces whose anchor occurs once are settled; equal pieces are one string
with a count; strings that share an anchor meet in one shard, whose suffix array (induced sorting) and
permuted common prefixes tell which of their places repeat. An anchor with too many different strings is
split by the distance to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import bounded_batches, save
from tidepost.llm.spans import mixed, powers, slices, utf8
from tidepost.llm.suffixes import repeated_places

#: Bytes of an anchor, at most.
GRAM = 50
#: Places of a piece are counted in so many bits of its number.
_BITS = 16
#: Bytes of a long text that are read at once.
_PART = 4 << 20
#: Distances to an anchor that stay together when its strings are too many for a shard.
CELL = 13
_KEY = ["k", "j"]


class Pieces:
    """Pieces of all texts: text, first place, number of places, hash of the anchor and of the piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        gram = min(GRAM, length)
        window = length - gram + 1
        places = len(data) - length + 1
        empty = np.zeros(0, np.int64)
        self.doc = self.first = self.count = empty
        self.anchor = self.hash = empty.astype(np.uint64)
        if places <= 0:
            return
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        hashes = mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
        chosen = least_of_windows(hashes, window)
        doc = np.searchsorted(offsets, np.arange(places), side="right") - 1
        whole = np.arange(places) + length <= offsets[doc + 1]
        opens = whole.copy()
        opens[1:] &= ~whole[:-1] | (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(opens)
        if not len(first):
            return
        ends = np.flatnonzero(whole & np.append(opens[1:] | ~whole[1:], True)) + 1
        self.doc, self.first, self.count = doc[first], first - offsets[doc[first]], ends - first
        self.anchor = hashes[chosen[first]]
        until = ends + length - 1
        self.hash = mixed((sums[until] - sums[first]) * down[first] + self.count.astype(np.uint64))


def least_of_windows(hashes: np.ndarray, window: int) -> np.ndarray:
    """Place of the least hash of every window, the first of equals; the last bits don't count."""
    count = len(hashes) - window + 1
    bits = np.uint64(max(1, (window - 1).bit_length()))
    rows = -(-len(hashes) // window)
    packed = np.full(rows * window, np.uint64(2**64 - 1))
    packed[: len(hashes)] = hashes >> bits << bits
    packed = packed.reshape(rows, window) | np.arange(window, dtype=np.uint64)
    until = np.minimum.accumulate(packed, axis=1).ravel()
    onward = np.minimum.accumulate(packed[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(count)
    left, right = onward[:count], until[window - 1 : window - 1 + count]
    mask = (np.uint64(1) << bits) - np.uint64(1)
    row = start // window * window
    at_left = row + (left & mask).astype(np.int64)
    at_right = (start + window - 1) // window * window + (right & mask).astype(np.int64)
    return np.where(left >> bits <= right >> bits, at_left, at_right)


def _keyed(docs: DataFrame) -> DataFrame:
    """``k, j, text``: two hashes that stand for the text, which may be null."""
    text = F.coalesce(F.col("text"), F.lit(""))
    second = F.xxhash64(F.lit(1), text)
    return docs.withColumns(
        {"k": F.xxhash64(text), "j": F.pmod(second, F.lit(2**31)).cast("int"), "text": text}
    )


def _marks(texts: DataFrame, length: int) -> DataFrame:
    """``k, j, piece, anchor, hash`` lists of every text; ``piece`` is first place * 2 ** 16 + places."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                data, offsets = utf8(part.column(2))
                if len(part) == 1 and len(data) > _PART:
                    parts = [
                        (a, data[a : a + _PART + length - 1])
                        for a in range(0, len(data) - length + 1, _PART)
                    ]
                    found = [(a, Pieces(d, np.array([0, len(d)]), length)) for a, d in parts]
                else:
                    found = [(0, Pieces(data, offsets, length))]
                doc = np.concatenate([p.doc for _, p in found])
                piece = np.concatenate([(p.first + a) << _BITS | p.count for a, p in found])
                lists = [
                    piece,
                    np.concatenate([p.anchor for _, p in found]).view(np.int64),
                    np.concatenate([p.hash for _, p in found]).view(np.int64),
                ]
                at = pa.array(np.searchsorted(doc, np.arange(len(part) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        *[pa.ListArray.from_arrays(at, pa.array(v)) for v in lists],
                    ],
                    ["k", "j", "piece", "anchor", "hash"],
                )

    return texts.select("k", "j", "text").mapInArrow(
        read, "k bigint, j int, piece array<bigint>, anchor array<bigint>, hash array<bigint>"
    )


def _cut_out(texts: DataFrame, length: int) -> DataFrame:
    """``anchor, hash, count, bytes`` of the pieces that ``wanted`` lists for each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                data, offsets = utf8(part.column(0))
                wanted = part.column(1)
                fields = wanted.flatten()
                doc = np.repeat(np.arange(len(part)), np.diff(wanted.offsets.to_numpy()))
                piece = fields.field("piece").to_numpy()
                begin = offsets[doc] + (piece >> _BITS)
                end = begin + (piece & (2**_BITS - 1)) + length - 1
                data = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        *[fields.field(n) for n in ("anchor", "hash", "count")],
                        pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist())]),
                    ],
                    ["anchor", "hash", "count", "bytes"],
                )

    return texts.select("text", "wanted").mapInArrow(
        cut, "anchor bigint, hash bigint, count bigint, bytes binary"
    )


_RUNS = "anchor bigint, hash bigint, runs array<struct<start:int,stop:int>>"


def _as_runs(places: np.ndarray) -> list[dict]:
    """Places as runs of adjoining ones."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1)
    starts = places[np.append(0, cut + 1)]
    stops = places[np.append(cut, len(places) - 1)] + 1
    return [{"start": a, "stop": b} for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def _sorted_shards(strings: DataFrame, length: int, shards: int) -> DataFrame:
    """``anchor, hash, runs`` of repeated places, found in the suffix arrays of shards."""

    def search(shard: pa.Table) -> pa.Table:
        text = [b.as_py() for b in shard.column("bytes")]
        places = repeated_places(text, length)
        runs = [
            [{"start": 0, "stop": len(t) - length + 1}] if n > 1 else _as_runs(p)
            for t, n, p in zip(text, shard.column("count").to_pylist(), places, strict=True)
        ]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        return pa.table(
            [shard.column("anchor"), shard.column("hash"), pa.array(runs, kind)],
            ["anchor", "hash", "runs"],
        )

    dealt = strings.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    dealt = dealt.select("shard", "anchor", "hash", "count", "bytes")
    return dealt.groupBy("shard").applyInArrow(search, _RUNS).filter("size(runs) > 0")


class _Digests:
    """Hashes of stretches of the texts of a column."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = utf8(column)
        up, self.down = powers(len(self.data) + 1)
        self.sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin])


def _within(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each of ``counts`` items, and its number in the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _cells(strings: DataFrame, length: int) -> DataFrame:
    """Strings split by distance to their anchor: ``parent, above, first, anchor, hash, count, bytes``.

    A cell's own anchor is what all strings of ``length`` bytes that begin in it have in common, so
    places that repeat meet again. ``first`` is the cell's first place in the string (``parent``,
    ``above`` are its anchor and hash).
    """
    cell = min(CELL, length)
    gram = min(GRAM, length)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3, 1 << 18):
                digest = _Digests(part.column(3))
                data, offsets = digest.data.tobytes(), digest.offsets
                grams = digest(np.arange(len(data) - gram + 1), np.arange(gram, len(data) + 1))
                base = offsets[:-1]
                at = least_of_windows(grams, length - gram + 1)[base] - base
                places = np.diff(offsets) - length + 1
                low, high = (at - places + 1) // cell, at // cell
                row, number = _within(high - low + 1)
                number += low[row]
                last = at[row] - number * cell
                first, stop = np.maximum(last - cell + 1, 0), np.minimum(last + 1, places[row])
                inner = base[row] + last
                shared = digest(inner, inner - cell + 1 + length) + number.astype(np.uint64)
                begin, end = base[row] + first, base[row] + stop - 1 + length
                whole = digest(begin, end) + (end - begin).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row)),
                        part.column(1).take(pa.array(row)),
                        pa.array(first.astype(np.int32)),
                        pa.array(mixed(shared).view(np.int64)),
                        pa.array(mixed(whole).view(np.int64)),
                        part.column(2).take(pa.array(row)),
                        pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist())]),
                    ],
                    ["parent", "above", "first", "anchor", "hash", "count", "bytes"],
                )

    return strings.select("anchor", "hash", "count", "bytes").mapInArrow(
        split,
        "parent bigint, above bigint, first int, anchor bigint, hash bigint, count bigint, "
        "bytes binary",
    )


def _counted_places(strings: DataFrame, length: int) -> DataFrame:
    """``anchor, hash, runs`` by counting the digests of all places."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3, 1 << 18):
                digest = _Digests(part.column(3))
                row, place = _within(np.diff(digest.offsets) - length + 1)
                at = digest.offsets[row] + place
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(i).take(pa.array(row)) for i in range(3)],
                        pa.array(place.astype(np.int32)),
                        pa.array(digest(at, at + length).view(np.int64)),
                    ],
                    ["anchor", "hash", "count", "place", "digest"],
                )

    rows = strings.select("anchor", "hash", "count", "bytes").mapInArrow(
        digests, "anchor bigint, hash bigint, count bigint, place int, digest bigint"
    )
    rows = save(rows, "substring-digests")
    again = rows.groupBy("anchor", "digest").agg(F.sum("count").alias("n")).filter("n > 1")
    again = save(again.select("anchor", "digest"), "substring-again")
    found = rows.join(again, ["anchor", "digest"], "left_semi")
    places = F.sort_array(F.collect_list("place"))
    return found.groupBy("anchor", "hash").agg(
        F.transform(
            places, lambda p: F.struct(p.alias("start"), (p + 1).cast("int").alias("stop"))
        ).alias("runs")
    )


def _settled(strings: DataFrame, length: int, shard_bytes: int, most: int, split: bool) -> DataFrame:
    """``anchor, hash, runs`` of the different ``strings`` (``anchor, hash, count, bytes``).

    Anchors with up to ``most`` strings go to shards. The strings of others are split into cells, equal
    cells are one string again, and those are settled in the same way; where a cell has still more,
    its few places are counted by digest.
    """
    kinds = strings.groupBy("anchor").agg(F.count("*").alias("kinds"))
    kinds = save(kinds, "substring-kinds")
    met = strings.join(kinds, "anchor")
    few = met.filter(F.col("kinds") <= most)
    many = met.filter(F.col("kinds") > most)
    size = few.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    sorted_ = _sorted_shards(few, length, shards)
    if kinds.filter(F.col("kinds") > most).isEmpty():
        return sorted_
    if not split:
        return sorted_.unionByName(_counted_places(many, length))
    cells = save(_cells(many, length), "substring-cells")
    different = cells.groupBy("anchor", "hash").agg(
        F.sum("count").alias("count"), F.first("bytes").alias("bytes")
    )
    different = save(different, "substring-different")
    runs = save(_settled(different, length, shard_bytes, most, False), "substring-cell-runs")
    shifted = F.transform(
        "runs",
        lambda r: F.struct(
            (r.start + F.col("first")).alias("start"), (r.stop + F.col("first")).alias("stop")
        ),
    )
    places = cells.select("parent", "above", "first", "anchor", "hash")
    above = (
        places.join(runs, ["anchor", "hash"])
        .groupBy(F.col("parent").alias("anchor"), F.col("above").alias("hash"))
        .agg(F.flatten(F.collect_list(shifted)).alias("runs"))
    )
    return sorted_.unionByName(above)


def _met(left: DataFrame, keys: DataFrame, size: int, limit: int) -> DataFrame:
    """Rows of ``left`` whose text is among ``keys``; ``size`` keys below ``limit`` are sent along."""
    return left.join(F.broadcast(keys) if size <= limit else keys, _KEY, "left_semi")


def repeated_spans(
    docs: DataFrame,
    length: int = 200,
    shard_bytes: int = 1 << 20,
    kinds_per_anchor: int = 1024,
    broadcast_keys: int = 1 << 20,
) -> DataFrame:
    """``k, j, start, stop``: bytes to remove from the texts with these keys (see ``_keyed``).

    A byte is listed if a string of ``length`` bytes covers it that starts anywhere else too; spans
    of a text may overlap. ``shard_bytes`` is the size of a shard, ``kinds_per_anchor`` the number of
    different strings of an anchor beyond which they are split (``_settled``).
    """
    if length >= 2**_BITS:
        raise ValueError(f"length must be below {2**_BITS}")
    bounded_batches(docs.sparkSession)
    texts = _keyed(docs.select("text"))
    long_enough = texts.filter(F.octet_length("text") >= length)
    marks = save(_marks(long_enough, length), "substring-marks")
    each = F.explode(F.arrays_zip("piece", "anchor", "hash")).alias("p")
    pieces = marks.select("k", "j", each).select("k", "j", "p.piece", "p.anchor", "p.hash")
    anchors = marks.select(F.explode("anchor").alias("anchor"))
    twice = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    # written, so that the join has plain shuffles on both sides, which Spark can split
    twice = save(twice, "substring-anchors")
    places = save(pieces.join(twice, "anchor", "left_semi"), "substring-places")
    one = F.min(F.struct("k", "j", "piece")).alias("one")
    strings = places.groupBy("anchor", "hash").agg(F.count("*").alias("count"), one)
    strings = save(strings, "substring-strings")
    kinds = strings.groupBy("anchor").agg(F.count("*").alias("kinds"))
    strings = strings.join(save(kinds, "substring-kinds"), "anchor")
    alone = strings.filter("kinds = 1")
    several = save(
        strings.filter("kinds > 1").select(
            "one.k", "one.j", F.struct("one.piece", "anchor", "hash", "count").alias("w")
        ),
        "substring-several",
    )
    wanted = several.groupBy(*_KEY).agg(F.collect_list("w").alias("wanted"))
    keys = save(several.select(*_KEY).distinct(), "substring-keys")
    sources = _distinct_texts(long_enough, keys, broadcast_keys)
    cut = save(_cut_out(sources.join(wanted, _KEY), length), "substring-cut")
    windows = F.col("one.piece").bitwiseAND(2**_BITS - 1).cast("int")
    whole = F.array(F.struct(F.lit(0).alias("start"), windows.alias("stop"))).alias("runs")
    settled = _settled(cut, length, shard_bytes, kinds_per_anchor, True)
    runs = alone.select("anchor", "hash", whole).unionByName(settled)
    first = F.shiftright("piece", _BITS)
    return (
        places.join(save(runs, "substring-runs"), ["anchor", "hash"])
        .select("k", "j", "piece", F.explode("runs").alias("run"))
        .select(
            "k",
            "j",
            (first + F.col("run.start")).alias("start"),
            (first + F.col("run.stop") + F.lit(length - 1)).alias("stop"),
        )
    )


def _distinct_texts(texts: DataFrame, keys: DataFrame, broadcast_keys: int) -> DataFrame:
    """``k, j, text`` of the texts among ``keys``, equal texts once."""
    met = _met(texts.select("k", "j", "text"), keys, keys.count(), broadcast_keys)
    return met.groupBy(*_KEY).agg(F.first("text").alias("text"))


def cut_texts(docs: DataFrame, spans: DataFrame, broadcast_keys: int = 1 << 20) -> DataFrame:
    """``k, j, n_bytes, spans, kept, kept_sha256`` of the texts that lose something, equal texts once.

    ``spans`` are maximal runs of removed bytes, ``kept`` the bytes that stay, joined.
    """
    listed = spans.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    listed = save(listed, "substring-spans")
    sources = _distinct_texts(
        _keyed(docs.select("text")), listed.select(*_KEY), broadcast_keys
    ).join(listed, _KEY)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                data, offsets = utf8(part.column(2))
                lists = part.column(3)
                start = lists.flatten().field("start").to_numpy()
                stop = lists.flatten().field("stop").to_numpy()
                at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                spans, kept, sha = [], [], []
                for i in range(len(part)):
                    a, b = start[at[i] : at[i + 1]], stop[at[i] : at[i + 1]]
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    opens = np.append(True, a[1:] > b[:-1])
                    a, b = a[opens], b[np.append(opens[1:], True)]
                    text = data[offsets[i] : offsets[i + 1]].tobytes()
                    edges = zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True)
                    rest = b"".join(text[x:y] for x, y in edges)
                    spans.append([{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist())])
                    kept.append(rest)
                    sha.append(hashlib.sha256(rest).hexdigest())
                kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(np.diff(offsets)),
                        pa.array(spans, kind),
                        pa.array(kept, pa.binary()),
                        pa.array(sha),
                    ],
                    ["k", "j", "n_bytes", "spans", "kept", "kept_sha256"],
                )

    return sources.select("k", "j", "text", "spans").mapInArrow(
        cut,
        "k bigint, j int, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, "
        "kept binary, kept_sha256 string",
    )


def remove_repeats(docs: DataFrame, length: int = 200, digests: bool = False, **options) -> DataFrame:
    """Every document without the bytes that a repeated string of ``length`` bytes covers.

    Texts are UTF-8 bytes, null counts as empty; matches never cross documents. A string repeats if
    it also starts elsewhere, in the same document too (overlapping or not); all its occurrences
    go. Strings are judged on the input. Columns are ``doc_id, n_bytes, n_removed, n_spans``, and
    ``spans`` (maximal removed runs of bytes) and ``kept`` (the bytes that stay, which may cut a
    character); with ``digests``, ``kept_sha256`` stands for these two. Every row has its own result,
    rows that repeat an id or are equal in all columns too (equal texts of at least ``length`` bytes
    lose everything). An empty table gives no rows; other columns play no part.
    """
    bounded_batches(docs.sparkSession)
    rows = _keyed(docs.select("doc_id", "text"))
    results = cut_texts(docs, repeated_spans(docs, length, **options))
    results = save(results.drop(*(["kept"] if digests else ["kept_sha256"])), "substring-results")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x.stop - x.start)
    if digests:
        kept = F.coalesce("kept_sha256", F.col("sha")).alias("kept_sha256")
        rows = rows.select(
            "doc_id", "k", "j", F.octet_length("text").cast("long").alias("bytes"),
            F.sha2("text", 256).alias("sha"),
        )
        extra = [kept]
    else:
        extra = [
            F.coalesce("spans", F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("spans"),
            F.coalesce("kept", F.encode("text", "UTF-8")).alias("kept"),
        ]
        rows = rows.withColumn("bytes", F.octet_length("text").cast("long"))
    return rows.join(results.drop("n_bytes"), _KEY, "left").select(
        "doc_id",
        F.col("bytes").alias("n_bytes"),
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        *extra,
    )

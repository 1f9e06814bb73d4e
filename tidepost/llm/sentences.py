"""Substrings that repeat across documents: runs of consecutive sentences, hashed and joined.

A sentence ends with ``.``, ``!`` or ``?`` at the end of a word or at a line break. One of more than
``LONGEST`` words is cut where the hash of the last ``CONTEXT`` words is the least of a window, so
that the same words are cut alike wherever their sentence began; no part is longer than ``LONGEST``.
A span is the shortest run of at least ``SENTENCES`` sentences and ``WORDS`` words from a sentence
on, or back from a sentence's end. So 51 words that two texts share have a common span, wherever
they begin: at most 16 words before the first common cut and 15 after the last one are not in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import bounded_batches, save
from tidepost.llm.spans import Words, mixed, powers, slices, utf8

LONGEST, SENTENCES, WORDS = 16, 2, 20
CONTEXT = 3
#: Bits of a text's hash in the key of its row.
_BITS = 62
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[0x21, 0x2E, 0x3F]] = True


def least_places(hashes: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Places of the least hash of every window of ``size`` adjoining places; the last of equals."""
    count = len(places) - size + 1
    if count <= 0:
        return places[:0]
    starts = np.flatnonzero(places[size - 1 :] - places[:count] == size - 1)
    at, best = starts.copy(), hashes[starts]
    for i in range(1, size):
        other = hashes[starts + i]
        lower = other <= best
        at[lower], best[lower] = starts[lower] + i, other[lower]
    return places[at]


class Sentences:
    """Sentences of all texts: first and last word, text, hash, and place in characters."""

    def __init__(self, column: pa.Array, longest: int = LONGEST):
        data, offsets = utf8(column)
        words = Words(data, offsets, lower=False)
        count = len(words.start)
        breaks = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data == 0x0A) | (data == 0x0D), out=breaks[1:])
        first = np.ones(count, dtype=bool)
        if count > 1:
            gap = breaks[words.start[1:]] > breaks[words.end[:-1]]
            first[1:] = _ENDS[data[words.end[:-1] - 1]] | gap | np.diff(words.doc).astype(bool)
        up, down = powers(count + 1)
        sums = np.zeros(count + 1, np.uint64)
        np.cumsum(words.hash * up[:-1], out=sums[1:])
        self.sums, self.down = sums, down
        begin = np.flatnonzero(first)
        sizes = np.diff(np.append(begin, count))
        since = np.arange(count) - np.repeat(begin, sizes)
        size = np.repeat(sizes, sizes)
        # A cut before a word, with its context within the sentence.
        places = np.flatnonzero((size > longest) & (since >= CONTEXT))
        context = mixed((sums[places] - sums[places - CONTEXT]) * down[places - CONTEXT])
        first[least_places(context, places, longest - CONTEXT + 1)] = True
        self.begin = np.flatnonzero(first)
        self.stop = np.append(self.begin[1:], count) if count else self.begin
        self.doc = words.doc[self.begin]
        chars = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
        base = chars[offsets[self.doc]] if len(self.doc) else self.doc
        self.char_start = chars[words.start[self.begin]] - base
        self.char_end = chars[words.end[self.stop - 1]] - base if count else self.begin
        self.texts = len(offsets) - 1

    def spans(self, least: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First sentence, last sentence and hash of every span."""
        count = len(self.begin)
        one = np.arange(count)
        last = np.maximum(np.searchsorted(self.stop, self.begin + words), one + least - 1)
        back = np.searchsorted(self.begin, self.stop - words, side="right") - 1
        back = np.minimum(back, one - least + 1)
        # A run back that is also the shortest one from its start is listed once.
        again = (back >= 0) & (last[np.maximum(back, 0)] == one)
        first, last = np.append(one, back[~again]), np.append(last, one[~again])
        whole = (first >= 0) & (last < count)
        first, last = first[whole], last[whole]
        same = self.doc[first] == self.doc[last]
        first, last = first[same], last[same]
        a, b = self.begin[first], self.stop[last]
        hashes = mixed((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))
        return first, last, hashes


def text_hash(text: Column | str) -> Column:
    return F.xxhash64(text).bitwiseAND(2**_BITS - 1)


def row_keys(doc_id: pa.Array, hashes: pa.Array) -> np.ndarray:
    """``doc_id * 2 ** 62 + hash`` of every row as 128 bits, which decimals hold.

    One number that orders rows by id, nulls last, and then by text; rows of equal id and text
    share it.
    """
    doc = doc_id.fill_null(0).to_numpy(zero_copy_only=False)
    none = doc_id.is_null().to_numpy(zero_copy_only=False)
    out = np.empty((len(doc), 2), np.int64)
    out[:, 0] = (doc << _BITS) | hashes.to_numpy(zero_copy_only=False)
    out[:, 1] = np.where(none, 2 ** (_BITS - 1), doc >> (64 - _BITS))
    return out


def key_id(key: str) -> Column:
    """The id in a row's key."""
    whole = f"({key} - pmod({key}, {2**_BITS}BD)) div {2**_BITS}BD"
    return F.expr(f"CASE WHEN {key} < {2 ** (63 + _BITS)}BD THEN {whole} END")


def sentence_spans(docs: DataFrame, least: int, words: int) -> DataFrame:
    """``row, hash, first, last, start, stop, again``: every span of every document.

    ``row`` is the key of the row (see ``row_keys``). ``first`` and ``last`` number the sentences of the text, ``start`` and ``stop`` are places in
    characters, ``again`` marks a span that came up before in the same text.
    """
    bounded_batches(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sentences = Sentences(part.column(1))
                keys = row_keys(part.column(0), part.column(2))
                first, last, hashes = sentences.spans(least, words)
                doc = sentences.doc[first]
                begins = np.searchsorted(sentences.doc, doc)
                order = np.lexsort((first, hashes, doc))
                again = np.zeros(len(order), dtype=bool)
                if len(order):
                    d, h = doc[order], hashes[order]
                    again[order[1:]] = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.Array.from_buffers(
                            pa.decimal128(38, 0), len(doc), [None, pa.py_buffer(keys[doc].tobytes())]
                        ),
                        pa.array(hashes.view(np.int64)),
                        pa.array((first - begins).astype(np.int32)),
                        pa.array((last - begins).astype(np.int32)),
                        pa.array(sentences.char_start[first].astype(np.int32)),
                        pa.array(sentences.char_end[last].astype(np.int32)),
                        pa.array(again),
                    ],
                    ["row", "hash", "first", "last", "start", "stop", "again"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text", text_hash("text")).mapInArrow(
        read,
        "row decimal(38,0), hash bigint, first int, last int, start int, stop int, again boolean",
    )


def repeated_passages(
    docs: DataFrame, least: int = SENTENCES, words: int = WORDS
) -> DataFrame:
    """Passages to remove: ``doc_id, start, stop, first_sentence, last_sentence, kept_in, text_hash``.

    A span stays where it comes first: in the document with the smallest id (null ids last, rows
    that repeat an id by the hash of their text), at its first place. Every other occurrence is
    removed with all sentences it covers; adjoining and overlapping spans make one passage.
    ``kept_in`` lists the ids of documents that keep a span of it; ``text_hash`` tells rows with
    null or repeated ids apart. Rows that are equal in id and text count as one document, which
    keeps its text in all of them. Null and empty texts have no spans, an empty table gives no
    rows. A span that many documents share is summed up before it is shuffled, and the join back
    is one that Spark can split.
    """
    spans = save(sentence_spans(docs, least, words), "sentence-spans")
    holders = spans.filter("NOT again").groupBy("hash").agg(
        F.min("row").alias("keeper"), F.max("row").alias("other")
    )
    shared = save(holders.filter("keeper <> other").select("hash", "keeper"), "sentence-shared")
    places = ["row", "first", "last", "start", "stop"]
    others = spans.join(shared, "hash").filter("row <> keeper").select(*places, "keeper")
    inside = spans.filter("again").select(*places, F.col("row").alias("keeper"))
    covered = others.unionByName(inside)
    before = (
        Window.partitionBy("row")
        .orderBy("first", "last", "keeper")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    opens = F.col("first") > F.coalesce(F.max("last").over(before), F.lit(-2)) + 1
    passage = F.sum(opens.cast("int")).over(
        Window.partitionBy("row").orderBy("first", "last", "keeper")
    )
    keeper = key_id("keeper")
    kept = F.struct(keeper.isNull().alias("none"), keeper.alias("doc_id"))
    return (
        covered.withColumn("passage", passage)
        .groupBy("row", "passage")
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            F.min("first").alias("first_sentence"),
            F.max("last").alias("last_sentence"),
            F.sort_array(F.collect_set(kept)).alias("kept_in"),
        )
        .select(
            key_id("row").alias("doc_id"),
            "start",
            "stop",
            "first_sentence",
            "last_sentence",
            F.transform("kept_in", lambda d: d.doc_id).alias("kept_in"),
            F.expr(f"pmod(row, {2**_BITS}BD)").cast("long").alias("text_hash"),
        )
    )


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with the passages cut out of ``text``; a null text stays null."""
    cuts = passages.groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("__cuts")
    )
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def cut(s, c):
        kept = F.substring(F.col("text"), s.at + 1, c.start - s.at)
        return F.struct(F.concat(s.text, kept).alias("text"), c.stop.alias("at"))

    def rest(s):
        return F.concat(s.text, F.substring(F.col("text"), s.at + 1, F.length("text")))

    cleaned = F.coalesce(F.aggregate("__cuts", start, cut, rest), F.col("text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc"))
    return (
        docs.join(cuts, same & (text_hash("text") == F.col("__hash")), "left")
        .withColumn("text", cleaned)
        .select(*docs.columns)
    )

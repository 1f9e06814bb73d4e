"""Harmonic packing of token pieces into sequences of a fixed capacity.

A sequence of class k has k places of capacity / k ids. A piece belongs to the class of the smallest
places that hold it; a sequence takes k pieces of its class, whatever they are, so every class is
filled by position alone, independently in as many groups as wanted.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import bounded_batches, save

CAPACITY = 2048
END_ID = 1
#: Pieces per sequence. Few classes, so that few sequences stay incomplete.
CLASSES = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 64)
#: The vocabulary of byte_bpe_50k.json as ranks of its merges.
RANKS = "byte_bpe_50k.tiktoken"
#: The tokenizer itself, which lists tokens beside the vocabulary's.
TOKENIZER = "byte_bpe_50k.json"
_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
#: Words kept by a worker, and characters of the longest word kept.
_KEPT_WORDS, _LONGEST = 200_000, 32
#: Characters for which the quick pattern might cut other words than the vocabulary's own.
_UNUSUAL = re.compile("[\x1c-\x1f²³¹¼½¾]|[^\x00-ɏ]")
_QUICK = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)


class WordIds:
    """Token ids as bytes (unsigned 32-bit little-endian), by a table of words that came up.

    The vocabulary merges within words only, so a text's ids are its words' ids in order. A text is
    first split at the strings of ``added`` tokens, which stand for their ids; the leftmost
    and longest counts. Without them such strings are ordinary text.
    """

    def __init__(self, ranks: str, pattern: str, added: dict[str, int] | None = None):
        import regex
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
        ).encode_ordinary
        self.exact = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.added = {t: np.array([i], dtype="<u4").tobytes() for t, i in (added or {}).items()}
        strings = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(map(re.escape, strings))})").split if strings else None

    def __call__(self, text: str) -> bytes:
        if self.split is None:
            return self.ordinary(text)
        parts = self.split(text)
        if len(parts) == 1:
            return self.ordinary(text)
        return b"".join(
            self.added[part] if i % 2 else self.ordinary(part) for i, part in enumerate(parts)
        )

    def ordinary(self, text: str) -> bytes:
        words = (self.exact if _UNUSUAL.search(text) else _QUICK).findall(text)
        known = self.known
        if len(known) > _KEPT_WORDS:
            known.clear()
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            pass
        out = []
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = np.array(self.encode(word), dtype="<u4").tobytes()
                if len(word) <= _LONGEST:
                    known[word] = ids
            out.append(ids)
        return b"".join(out)


def class_of(length: int, capacity: int) -> int:
    """Pieces of this length per sequence: the most of ``CLASSES`` whose place is large enough."""
    return max(k for k in CLASSES if capacity // k >= length)


def cut_lengths(tokens: int, capacity: int, slack: float, loss: int = 8) -> list[int]:
    """Lengths of the pieces of a document with so many tokens.

    Full sequences first. The remainder is one piece if at most ``slack`` of its class's place
    (or ``loss`` ids) would stay empty; else it gives a piece that fills a place of the next class,
    and the rest is looked at again.
    """
    out = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = class_of(rest, capacity)
        place = capacity // k
        if place - rest <= max(slack * place, loss) or k == CLASSES[-1]:
            out.append(rest)
            break
        smaller = capacity // CLASSES[CLASSES.index(k) + 1]
        out.append(smaller)
        rest -= smaller
    return out


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the tokens that a tokenizer's file lists beside its vocabulary."""
    with open(path, encoding="utf-8") as lines:
        tokens = json.load(lines)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
        raise ValueError("added tokens that depend on the text around them")
    return {t["content"]: t["id"] for t in tokens}


@functools.cache
def _word_ids(folder: str | None, added: bool) -> WordIds:
    """Kept by a worker from one task to the next."""
    import public_tokenizers

    def path(name: str) -> str:
        return public_tokenizers.path(name) if folder is None else f"{folder}/{name}"

    tokens = added_tokens(path(TOKENIZER)) if added else {}
    return WordIds(path(RANKS), public_tokenizers.PATTERN, tokens)


def token_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    slack: float = 0.06,
    keep_ids: bool = False,
    folder: str | None = None,
    added: bool = False,
) -> DataFrame:
    """Pieces of every document: ``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``).

    A document's ids end with ``END_ID``; null text counts as empty and is that one id. Rows with
    repeated or null ids are documents like others. ``folder`` holds the vocabulary's files; by
    default the installed ones. With ``added``, strings of its added tokens are those tokens, as the
    tokenizer reads them by default; else they are ordinary text.
    """
    bounded_batches(docs.sparkSession)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _word_ids(folder, added)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                ids = encode(text or "") + end
                tokens = len(ids) // 4
                start = 0
                for length in cut_lengths(tokens, capacity, slack):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, start, length, zlib.crc32(part), tokens, part)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    start += length
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            if keep_ids:
                names.append("ids")
                arrays.append(pa.array(columns[5], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = _PIECES + (", ids binary" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def harmonic_pack(
    pieces: DataFrame, capacity: int = CAPACITY, per_group: int = 16_384, number: str | None = None
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` is read several times and should be a written table. A class of many pieces is
    dealt to groups of about ``per_group`` pieces by hash; each group fills its own sequences
    and leaves one of them incomplete at most. ``number`` names a column that tells equal pieces
    apart, so that they are dealt to several groups too, and is dropped. Sequence ids count from 0
    without gaps. All other columns are kept.
    """
    kind = F.greatest(
        *[F.when(F.col("length") <= capacity // k, F.lit(k).cast("long")) for k in CLASSES]
    )
    classed = pieces.withColumn("__kind", kind)
    groups = F.ceil(F.count("*") / F.lit(per_group)).cast("long")
    counts = classed.groupBy("__kind").agg(groups.alias("__groups"))
    own = [] if number is None else [number]
    hashed = F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens", *own)
    dealt = classed.join(F.broadcast(counts), "__kind").withColumn(
        "__group", F.pmod(hashed, F.col("__groups"))
    )
    filled = dealt.groupBy("__kind", "__group").agg(
        F.ceil(F.count("*") / F.col("__kind")).alias("__sequences")
    )
    before = Window.orderBy("__kind", "__group").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("__sequences").over(before), F.lit(0)).alias("__first")
    filled = filled.select("__kind", "__group", first)
    order = ["doc_id", "start", "ids_crc32", *own]
    place = F.row_number().over(Window.partitionBy("__kind", "__group").orderBy(*order)) - 1
    placed = dealt.withColumn("__place", place).withColumn(
        "__sequence", F.floor(F.col("__place") / F.col("__kind"))
    )
    earlier = (
        Window.partitionBy("__kind", "__group", "__sequence")
        .orderBy("__place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long")
    return (
        placed.withColumn("offset", offset)
        .join(filled, ["__kind", "__group"])
        .withColumn("sequence_id", F.col("__first") + F.col("__sequence"))
        .select(*[c for c in pieces.columns if c != number], "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, keep_ids: bool = False, added: bool = False
) -> DataFrame:
    """Tokenise all documents, cut them and pack the pieces (``added``: see ``token_pieces``)."""
    pieces = token_pieces(docs, capacity, keep_ids=keep_ids, added=added)
    # written with the pieces, so that a piece keeps its number
    pieces = save(pieces.withColumn("__number", F.monotonically_increasing_id()), "pack-pieces")
    return harmonic_pack(pieces, capacity, number="__number")


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = END_ID) -> DataFrame:
    """``sequence_id, ids, padding``: the ids of each sequence, padded to ``capacity``.

    Needs ``ids``. A sequence holds at most ``capacity`` ids. One whose length is a power of two is
    left as it is.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    gathered = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    used = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p.length)
    power = F.bit_count(F.col("used")) == 1
    padding = F.when(power, F.lit(0).cast("long")).otherwise(F.lit(capacity) - F.col("used"))
    body = F.aggregate("parts", F.lit("").cast("binary"), lambda a, p: F.concat(a, p.ids))
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), F.col("padding").cast("int")))
    return (
        gathered.withColumn("used", used)
        .withColumn("padding", padding)
        .select("sequence_id", F.concat(body, pad).alias("ids"), "padding")
    )

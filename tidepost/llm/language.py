"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network labels every byte of windows of ``WINDOW`` bytes; a document's probabilities are the
mean over the bytes of letters in all of its windows. It is trained in numpy by backpropagation
through time on a bounded sample of windows and applied inside the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import bounded_batches, crc32_bucket, save
from tidepost.llm.spans import slices, utf8

UNKNOWN = "und"
WINDOW, HIDDEN = 64, 8
_LETTER = np.zeros(256, dtype=np.float32)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1.0
_ANY_LETTER = regex.compile(r"\p{L}")
#: Bits of a hash by which documents are counted before any are ranked.
_COUNTED_BITS = 14


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1.0
    return np.reciprocal(x, out=x)


class ByteGru:
    """Gates by lookup of the byte and a product with the state, in each direction."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        scale = 0.5 / np.sqrt(hidden)
        self.p = {}
        for way in "fb":
            self.p[f"x{way}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p[f"u{way}"] = rng.normal(0, scale, (hidden, 3 * hidden)).astype(np.float32)
            self.p[f"v{way}"] = rng.normal(0, scale, (hidden, len(languages))).astype(np.float32)
            self.p[f"x{way}"][:, :hidden] += 1.0  # remember at first
        self.p["b"] = np.zeros(len(languages), np.float32)

    def _states(self, data: np.ndarray, way: str, trace: list | None = None) -> np.ndarray:
        """States after each byte; ``data`` has a row per place and a column per window."""
        n = self.hidden
        x_gates = np.ascontiguousarray(self.p[f"x{way}"][:, : 2 * n])
        x_new = np.ascontiguousarray(self.p[f"x{way}"][:, 2 * n :])
        u_gates = np.ascontiguousarray(self.p[f"u{way}"][:, : 2 * n])
        u_new = np.ascontiguousarray(self.p[f"u{way}"][:, 2 * n :])
        places = range(len(data)) if way == "f" else range(len(data) - 1, -1, -1)
        h = np.zeros((data.shape[1], n), np.float32)
        out = np.empty((*data.shape, n), np.float32)
        for t in places:
            byte = data[t]
            gates = h @ u_gates
            gates += x_gates.take(byte, axis=0)
            _sigmoid(gates)
            keep, reset = gates[:, :n], gates[:, n:]
            inner = h @ u_new
            new = reset * inner
            new += x_new.take(byte, axis=0)
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((t, h, keep, reset, inner, new))
            h = h - new
            h *= keep
            h += new
            out[t] = h
        return out

    def probabilities(self, data: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Sum over the places of a window of label probabilities times ``weight``."""
        forward, backward = self._states(data, "f"), self._states(data, "b")
        total = np.zeros((data.shape[1], len(self.languages)), np.float32)
        for t in range(len(data)):
            e = forward[t] @ self.p["vf"]
            e += backward[t] @ self.p["vb"]
            e += self.p["b"]
            e -= e.max(axis=1, keepdims=True)
            np.exp(e, out=e)
            e *= (weight[t] / e.sum(axis=1))[:, None]
            total += e
        return total

    def gradients(self, data: np.ndarray, weight: np.ndarray, label: np.ndarray) -> dict:
        """Gradient of the mean cross entropy of all places, back through time."""
        n, p = self.hidden, self.p
        traces: dict[str, list] = {"f": [], "b": []}
        states = {w: self._states(data, w, traces[w]) for w in "fb"}
        e = states["f"] @ p["vf"] + states["b"] @ p["vb"] + p["b"]
        e = np.exp(e - e.max(axis=2, keepdims=True))
        e /= e.sum(axis=2, keepdims=True)
        e[:, np.arange(len(label)), label] -= 1.0
        e *= weight[:, :, None] / max(weight.sum(), 1.0)
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        grads["b"] = e.sum(axis=(0, 1))
        for w in "fb":
            grads[f"v{w}"] = np.einsum("tbn,tbc->nc", states[w], e)
            u_gates, u_new = p[f"u{w}"][:, : 2 * n], p[f"u{w}"][:, 2 * n :]
            dh = np.zeros((data.shape[1], n), np.float32)
            for t, before, keep, reset, inner, new in reversed(traces[w]):
                dh = dh + e[t] @ p[f"v{w}"].T
                dnew = dh * (1 - keep) * (1 - new * new)
                dkeep = dh * (before - new) * keep * (1 - keep)
                dreset = dnew * inner * reset * (1 - reset)
                dgates = np.concatenate([dkeep, dreset], axis=1)
                dinner = dnew * reset
                np.add.at(grads[f"x{w}"], data[t], np.concatenate([dgates, dnew], axis=1))
                grads[f"u{w}"][:, : 2 * n] += before.T @ dgates
                grads[f"u{w}"][:, 2 * n :] += before.T @ dinner
                dh = dh * keep + dgates @ u_gates.T + dinner @ u_new.T
        return grads

    def train(self, data: np.ndarray, label: np.ndarray, steps: int = 240, batch: int = 256):
        """Adam on random batches of windows (rows of ``data``)."""
        rng = np.random.default_rng(5)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            chosen = rng.integers(0, len(data), min(batch, len(data)))
            part = np.ascontiguousarray(data[chosen].T)
            grads = self.gradients(part, _LETTER[part], label[chosen])
            rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                size = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7
                self.p[k] -= (rate * first[k] / (1 - 0.9**step) / size).astype(np.float32)
        return self


def windows(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW):
    """All windows of all texts: bytes, which of them are letters, and the text of each window."""
    counts = -(-np.diff(offsets) // size)
    text = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[text] + number * size
    place = start[:, None] + np.arange(size)
    inside = place < offsets[text + 1][:, None]
    values = np.where(inside, data[np.minimum(place, max(len(data) - 1, 0))], 0)
    return values.astype(np.uint8), text


def training_windows(
    docs: DataFrame, per_language: int, per_text: int, size: int = WINDOW
) -> DataFrame:
    """``lang, piece``: windows at hashed places of a bounded sample of labelled documents.

    The sample takes the ``per_language`` documents of each language that come first by hash, of
    those whose ``crc32`` of the id modulo 5 is not 0, and ``per_text`` windows of each. Documents are
    counted by the first bits of their hash, so that only those which can be among the first are
    ranked.
    """
    learned = docs.filter(
        (crc32_bucket("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    first_bits = F.shiftright(F.xxhash64("doc_id"), 64 - _COUNTED_BITS)
    counts = learned.groupBy("lang", first_bits.alias("bits")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("bits"))
    # a row for each language, from at most 2 ** 14 of each
    last = counts.withColumn("upto", upto).withColumn("full", F.col("upto") >= per_language)
    last = last.groupBy("lang").agg(
        F.coalesce(F.min(F.when(F.col("full"), F.col("bits"))), F.max("bits")).alias("last")
    )
    learned = learned.join(save(last, "language-counts"), "lang").filter(first_bits <= F.col("last"))
    # places are drawn before the ranking, so that no whole text is shuffled
    texts = learned.select(
        "doc_id",
        "lang",
        F.xxhash64("text").alias("h"),
        F.transform(
            F.sequence(F.lit(0), F.lit(per_text - 1)),
            lambda i: F.substring(
                "text",
                F.pmod(
                    F.xxhash64("doc_id", i), F.greatest(F.length("text") - size, F.lit(1))
                ).cast("int")
                + 1,
                F.lit(size),
            ),
        ).alias("pieces"),
    )
    rank = F.row_number().over(
        Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "h", "doc_id")
    )
    sample = texts.withColumn("place", rank).filter(F.col("place") <= per_language)
    return sample.select("lang", F.explode("pieces").alias("piece"))


def train_language_model(
    docs: DataFrame, per_language: int = 400, per_text: int = 6, steps: int = 240
) -> ByteGru | None:
    """Network trained on the windows of the sample; None if no document has a language.

    At most ``per_language * per_text`` windows of each language reach the driver.
    """
    rows = training_windows(docs, per_language, per_text).orderBy("lang", "piece").collect()
    languages = sorted({r.lang for r in rows})
    if not languages:
        return None
    data = np.zeros((len(rows), WINDOW), np.uint8)
    for i, row in enumerate(rows):
        piece = row.piece.encode()[:WINDOW]
        data[i, : len(piece)] = np.frombuffer(piece, np.uint8)
    label = np.array([languages.index(r.lang) for r in rows])
    # each language counts alike
    counts = np.bincount(label, minlength=len(languages))
    draw = np.concatenate(
        [np.resize(np.flatnonzero(label == i), counts.max()) for i in range(len(languages))]
    )
    return ByteGru(languages).train(data[draw], label[draw], steps)


def predict_language(docs: DataFrame, model: ByteGru | None, batch: int = 4096) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, read from the whole text alone.

    A null text or one without a letter is ``und`` with score 0, as is everything if no language
    was learned. Other columns, null or repeated ids are passed through.
    """
    bounded_batches(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = columns.index("text")

    def label(part: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
        column = part.column(at)
        data, offsets = utf8(column)
        none = ([UNKNOWN] * len(column), np.zeros(len(column)))
        if model is None or not len(data):
            return none
        values, text = windows(data, offsets)
        pooled = np.zeros((len(column), len(model.languages)))
        for a in range(0, len(values), batch):
            window = np.ascontiguousarray(values[a : a + batch].T)
            sums = model.probabilities(window, _LETTER[window])
            np.add.at(pooled, text[a : a + batch], sums)
        total = pooled.sum(axis=1)
        best = pooled.argmax(axis=1)
        score = pooled[np.arange(len(best)), best] / np.maximum(total, 1e-9)
        known = [t is not None and bool(_ANY_LETTER.search(t)) for t in column.to_pylist()]
        names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, np.where(known, np.minimum(score, 1.0), 0.0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrived in batches:
            for part in slices(arrived, at, 1 << 20):
                names, score = label(part)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    [*columns, "lang_pred", "score"],
                )

    kept = docs.select(*columns)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(read, f"{types}, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` by a network trained on the same documents."""
    model = train_language_model(docs, **options)
    predicted = predict_language(docs.select("doc_id", "text"), model)
    held_out = crc32_bucket("doc_id", 5) == 0
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, least: float = 0.3, **options) -> DataFrame:
    """Documents with a recognised language: not ``und``, and at least ``least`` sure of it."""
    model = train_language_model(docs, **options)
    hidden = docs.withColumnsRenamed({"lang_pred": "__lang_pred", "score": "__score"})
    predicted = predict_language(hidden, model)
    kept = predicted.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    kept = kept.drop("lang_pred", "score")
    return kept.withColumnsRenamed({"__lang_pred": "lang_pred", "__score": "score"}).select(
        *docs.columns
    )

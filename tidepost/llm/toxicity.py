"""Toxicity by weak supervision.

Voters are words, word beginnings and patterns that are much more frequent in toxic documents of
the learning rows. A generative model over the votes of all documents estimates how often each
voter fires in toxic and in clean documents; voters that fire together are found by their
correlation and vote as one. A linear classifier over all voters is trained on the model's
posterior labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import bounded_batches, crc32_bucket, save
from tidepost.llm.spans import slices

_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (4, 5, 6, 7)
#: A voter counts how often its word or stem comes up: once, twice, or at least this often.
_OFTEN = 3
#: Patterns that vote besides words and stems.
PATTERNS = {
    "shouting": re.compile(r"(?:\b[^\W\d_a-zß-öø-ÿ]{3,}\b\W+){3}"),
    "exclaiming": re.compile(r"[!?]{3,}"),
    "masked": re.compile(r"\b[^\W\d_]+[*#@$]{2,}[^\W\d_]*"),
}


def voter_names(text: str) -> list[str]:
    """Names of all possible voters that fire on a text: ``=word 1``, ``stem~ 3``, ``?pattern``."""
    counts = Counter(_WORD.findall(text.lower()))
    stems: Counter = Counter()
    for word, n in counts.items():
        for size in _STEMS:
            if len(word) > size:
                stems[word[:size]] += n
    names = [f"={w} {min(n, _OFTEN)}" for w, n in counts.items()]
    names += [f"{s}~ {min(n, _OFTEN)}" for s, n in stems.items()]
    return names + [f"?{k}" for k, p in PATTERNS.items() if p.search(text)]


def learning_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``most`` labelled documents, the first by hash.

    Only documents whose ``crc32`` of the id modulo 4 is not 2 are taken; of several labels of a
    document the largest counts, and of several documents with one id the one whose text has the
    least hash, so that there is one row for each id.
    """
    marked = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(crc32_bucket("doc_id", 4) != 2)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    marked = F.broadcast(marked)  # at most `most` rows of two numbers
    text = F.coalesce("text", F.lit("")).alias("text")
    found = docs.select("doc_id", text).join(marked, "doc_id")
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return found.groupBy("doc_id").agg(first, F.first("toxic").alias("toxic"))


def choose_voters(rows: DataFrame, most: int, ratio: float, support: float) -> list[str]:
    """The voters: words and others that toxic documents have more often, the strongest first.

    The odds ratio, less two standard errors of its logarithm, is at least ``ratio``; ``support``
    is the least share of toxic documents (and five of them).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            toxic = batch.column(1).to_pylist()
            for text, label in zip(batch.column(0).to_pylist(), toxic, strict=True):
                for name in voter_names(text):
                    counts.setdefault(name, [0, 0])[label > 0] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.string()),
                    pa.array([c[0] for c in counts.values()], pa.int64()),
                    pa.array([c[1] for c in counts.values()], pa.int64()),
                ],
                ["voter", "clean", "toxic"],
            )

    totals = rows.agg(F.count(F.expr("IF(toxic > 0, 1, NULL)")), F.count("*")).first()
    toxic, clean = totals[0], totals[1] - totals[0]
    counted = (
        rows.select("text", F.col("toxic").cast("int").alias("toxic"))
        .mapInArrow(count, "voter string, clean bigint, toxic bigint")
        .groupBy("voter")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    odds = (F.col("toxic") + 0.5) * (clean + 1) / ((F.col("clean") + 0.5) * (toxic + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    sure = F.log(odds) - 2 * error
    least = max(5, math.ceil(support * toxic))
    chosen = (
        counted.withColumn("odds", odds)
        .filter((F.col("toxic") >= least) & (sure >= math.log(ratio)))
        .orderBy((F.col("toxic") * F.log("odds")).desc(), "voter")
        .limit(4 * most)
        .collect()
    )
    return own_voters([(r.voter, r.toxic) for r in chosen])[:most]


def own_voters(found: list[tuple[str, int]], share: float = 0.6) -> list[str]:
    """Names without the stems that live on one longer stem or word.

    Such a stem has ``share`` of its toxic documents from a longer name as often in the text, and
    would also fire on other words.
    """
    kept = []
    for name, toxic in found:
        stem, _, often = name.rpartition(" ")
        longer = (
            n
            for other, n in found
            if stem.endswith("~")
            and other.endswith(" " + often)
            and other.removeprefix("=").startswith(stem[:-1])
            and len(other) > len(name)
        )
        if not any(n >= share * toxic for n in longer):
            kept.append(name)
    return kept


def cast_votes(docs: DataFrame, voters: list[str]) -> DataFrame:
    """``doc_id, votes``: the numbers of the voters that fire on each whole text.

    A word or stem fires the voter of the highest chosen level that its count reaches.
    """
    bounded_batches(docs.sparkSession)
    words: dict[str, dict[int, int]] = {}
    stems: dict[int, dict[str, dict[int, int]]] = {size: {} for size in _STEMS}
    patterns = []
    for i, voter in enumerate(voters):
        if voter[0] == "?":
            patterns.append((PATTERNS[voter[1:]], i))
            continue
        name, often = voter.rsplit(" ", 1)
        table = words if name[0] == "=" else stems[len(name) - 1]
        table.setdefault(name[1:] if name[0] == "=" else name[:-1], {})[int(often)] = i
    for levels in [levels for table in (words, *stems.values()) for levels in table.values()]:
        for often in range(2, _OFTEN + 1):
            if often not in levels and often - 1 in levels:
                levels[often] = levels[often - 1]
    stems = {size: table for size, table in stems.items() if table}

    def votes(text: str) -> list[int]:
        counts = Counter(_WORD.findall(text.lower()))
        fired = [words[w].get(min(counts[w], _OFTEN)) for w in counts.keys() & words.keys()]
        for size, table in stems.items():
            found: Counter = Counter()
            for word in [w for w in counts if w[:size] in table and len(w) > size]:
                found[word[:size]] += counts[word]
            fired += [table[s].get(min(n, _OFTEN)) for s, n in found.items()]
        fired += [i for p, i in patterns if p.search(text)]
        return sorted(i for i in fired if i is not None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                fired = [votes(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(fired, pa.list_(pa.int32()))], ["doc_id", "votes"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        read, "doc_id bigint, votes array<int>"
    )


def correlated_groups(patterns: DataFrame, voters: int, alike: float) -> list[int]:
    """Group of each voter: voters whose correlation is at least ``alike`` are in one.

    Joint counts come from the vote patterns of all documents; there are at most as many as
    pairs of voters.
    """
    pairs = patterns.select(
        "n", F.explode("votes").alias("a"), F.col("votes").alias("others")
    ).select("n", "a", F.explode("others").alias("b"))
    counts = pairs.filter("a <= b").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    total = patterns.agg(F.sum("n")).first()[0] or 0
    joint = np.zeros((voters, voters))
    for r in counts:
        joint[r.a, r.b] = joint[r.b, r.a] = r.n
    single = joint.diagonal().copy()
    group = list(range(voters))
    spread = np.sqrt(np.maximum(single * (total - single), 1e-9))
    phi = (joint * total - np.outer(single, single)) / np.outer(spread, spread)
    for a in range(voters):
        for b in np.flatnonzero(phi[a, :a] >= alike):
            old, new = group[a], group[b]
            group = [new if g == old else g for g in group]
    names = {g: i for i, g in enumerate(dict.fromkeys(group))}
    return [names[g] for g in group]


def _sum_over(votes: Column, values: list[float]) -> Column:
    """Sum of ``values`` over an array of numbers."""
    table = F.array(*[F.lit(float(v)) for v in values])
    return F.aggregate(votes, F.lit(0.0), lambda s, v: s + F.get(table, v))


def _logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.exp(-x) + 1.0)


def label_model(
    patterns: DataFrame,
    groups: list[int],
    start: tuple[np.ndarray, np.ndarray, float],
    rounds: int,
    silence: float,
) -> tuple[float, np.ndarray]:
    """Intercept and weight of each group for the log odds that a document is toxic.

    Expectation maximisation over all vote patterns. ``start`` has the rates at which groups fire
    in toxic and clean documents, and the share of toxic ones, which stays. Voters that don't
    fire count by ``silence`` only, since their silence is correlated: a document has words of one
    language and few of the voters.
    """
    table = F.array(*[F.lit(g) for g in groups])
    grouped = patterns.select(
        "n", F.array_distinct(F.transform("votes", lambda v: F.get(table, v))).alias("fired")
    )
    grouped = save(
        grouped.groupBy("fired").agg(F.sum("n").alias("n")), "toxicity-patterns"
    )
    toxic, clean, share = start
    for step in range(rounds + 1):
        absent = np.log((1 - toxic) / (1 - clean))
        weight = np.log(toxic / clean) - silence * absent
        base = math.log(share / (1 - share)) + silence * float(absent.sum())
        if step == rounds:
            break
        posterior = _logistic(F.lit(base) + _sum_over(F.col("fired"), list(weight)))
        rated = grouped.select("fired", "n", (posterior * F.col("n")).alias("t"))
        all_n, all_t = rated.agg(F.sum("n"), F.sum("t")).first()
        fired = rated.select(F.explode("fired").alias("g"), "n", "t")
        sums = fired.groupBy("g").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).collect()
        n, t = np.zeros(len(toxic)), np.zeros(len(toxic))
        for r in sums:
            n[r.g], t[r.g] = r.n, r.t
        toxic = (t + 1.0) / (all_t + 20.0)
        clean = (n - t + 0.05) / (all_n - all_t + 20.0)
        toxic, clean = np.clip(toxic, 1e-6, 1 - 1e-6), np.clip(clean, 1e-9, 1 - 1e-6)
    return base, weight


def train_linear(votes: np.ndarray, target: np.ndarray, count: np.ndarray, steps: int = 300):
    """Logistic regression on soft labels: intercept and weights, by Adam on all rows."""
    w, b = np.zeros(votes.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    total = count.sum()
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(votes @ w + b, -30, 30))) - target) * count / total
        g = np.append(votes.T @ error + 1e-5 * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return b, w


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    most_rows: int = 30_000,
    most_voters: int = 512,
    ratio: float = 8.0,
    support: float = 0.001,
    alike: float = 0.6,
    rounds: int = 4,
    silence: float = 0.25,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document, by its whole text alone.

    Bounds: ``most_rows`` labelled documents choose the voters, start the label model and, with
    posterior labels, train the classifier; ``most_voters`` voters. The label model counts the
    votes of all documents. Null and empty texts get the score of a document without votes; null
    or repeated ids are documents like others; without toxic learning rows there are no voters and
    every score is the share of toxic documents. Labels, language, source and id are no inputs of
    a score.
    """
    bounded_batches(docs.sparkSession)
    rows = save(learning_rows(docs, labels, most_rows), "toxicity-learn")
    voters = choose_voters(rows, most_voters, ratio, support)
    votes = save(cast_votes(docs, voters), "toxicity-votes")
    patterns = save(votes.groupBy("votes").agg(F.count("*").alias("n")), "toxicity-counts")
    learn = (
        cast_votes(rows, voters)
        .join(rows.select("doc_id", "toxic"), "doc_id")
        .groupBy("votes", (F.col("toxic") > 0).alias("toxic"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    toxic_rows = sum(r.n for r in learn if r.toxic)
    share = (toxic_rows + 0.5) / (sum(r.n for r in learn) + 1.0)
    if voters:
        groups = correlated_groups(patterns, len(voters), alike)
        rates = np.zeros((2, max(groups) + 1))
        for r in learn:
            for g in {groups[v] for v in r.votes}:
                rates[int(r.toxic), g] += r.n
        clean_rows = sum(r.n for r in learn) - toxic_rows
        start = (
            np.clip((rates[1] + 0.5) / (toxic_rows + 1), 1e-6, 1 - 1e-6),
            np.clip((rates[0] + 0.05) / (clean_rows + 1), 1e-9, 1 - 1e-6),
            share,
        )
        base, weight = label_model(patterns, groups, start, rounds, silence)
        fired = np.zeros((len(learn), len(voters)))
        target = np.zeros(len(learn))
        for i, r in enumerate(learn):
            fired[i, r.votes] = 1.0
            target[i] = base + sum(weight[g] for g in {groups[v] for v in r.votes})
        target = 1 / (1 + np.exp(-np.clip(target, -30, 30)))
        intercept, weights = train_linear(fired, target, np.array([float(r.n) for r in learn]))
        logit = F.lit(float(intercept)) + _sum_over(F.col("votes"), list(weights))
    else:
        logit = F.lit(math.log(share / (1 - share)))
    scored = votes.select(
        "doc_id", (crc32_bucket("doc_id", 4) == 2).alias("held_out"), _logistic(logit).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))

"""Hard negatives, suffix arrays, substring removal and whitening against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidepost.llm import (
    chat,
    common,
    language,
    mixing,
    nearest,
    negatives,
    packing,
    substrings,
    suffixes,
    toxicity,
    whitening,
)
from tidepost.llm.common import save
from tidepost.llm.queries import QUERIES
from tidepost.session import scratch_dir

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<double>, label int, x string, anchor int, weight int"
TEXTS = "doc_id bigint, text string, k string, piece int"


def vectors(frame, rows):
    return frame([(i, e, label, "x", 1, 2) for i, e, label in rows], VECTORS)


# hard negatives


def mined(rows, every=100, low=80, high=100, k=5):
    """The contract, row by row."""
    whole = sorted({(i, label, tuple(int(np.floor(256 * c)) for c in e)) for i, e, label in rows})
    out = []
    for i, label, x in whole:
        if i % every:
            continue
        score = {r: sum(a * b for a, b in zip(x, r[2], strict=True)) for r in whole if r[0] != i}
        order = sorted(score, key=lambda r: (-score[r], r[0]))
        for p in [r for r in order if r[1] == label][:k]:
            fits = [r for r in order if r[1] != label and low * score[p] <= 100 * score[r] <= high * score[p]]
            out += [(i, p[0], n + 1, r[0], score[p], score[r]) for n, r in enumerate(fits[:k])]
    return sorted(out)


def some_vectors(count, seed, dims=12, labels=3, ids=None):
    draw = np.random.default_rng(seed)
    x = np.round(draw.normal(size=(count, dims)), 2) / 4
    return [
        (int(i if ids is None else draw.integers(ids)), x[i].tolist(), int(draw.integers(labels)))
        for i in range(count)
    ]


@pytest.mark.parametrize("block", [8, 64, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_mined_negatives(frame, block, seed):
    rows = some_vectors(260, seed)
    got = negatives.mine(vectors(frame, rows), every=10, least_per_block=block).collect()
    assert sorted(map(tuple, got)) == mined(rows, every=10)


def test_mined_negatives_with_ties_and_repeats(frame):
    rows = some_vectors(40, 3, dims=3, labels=2)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(30)] + rows[:10] * 2
    rows += [(0, rows[5][1], 1), (200, [0.0] * 3, 0), (300, [-1.0, 0.0, 0.0], 0)]
    got = negatives.mine(vectors(frame, rows), every=100, least_per_block=16).collect()
    assert sorted(map(tuple, got)) == mined(rows)


def test_mined_negatives_of_large_components(frame):
    rows = [(i, [c * 1e5 for c in e], label) for i, e, label in some_vectors(60, 4, dims=20)]
    got = negatives.mine(vectors(frame, rows), every=10, least_per_block=16).collect()
    assert sorted(map(tuple, got)) == mined(rows, every=10)


def test_mined_negatives_awkward(frame):
    good = some_vectors(30, 5, dims=4, labels=2)
    odd = [
        (100, None, 1), (200, [1.0, None, 0.0, 0.0], 1), (300, [1.0, float("nan"), 0.0, 0.0], 1),
        (400, [float("inf")] * 4, 0), (500, [0.5] * 4, None), (None, [0.5] * 4, 1), (600, [0.1], 0),
        (700, [], 0),
    ]
    got = negatives.mine(vectors(frame, good + odd), every=10).collect()
    assert sorted(map(tuple, got)) == mined(good, every=10)
    assert negatives.mine(vectors(frame, [])).count() == 0
    assert negatives.mine(vectors(frame, odd)).count() == 0
    assert negatives.mine(vectors(frame, [(0, [1.0], 0), (1, [1.0], 0)])).count() == 0


def test_index_finds_all_pairs():
    draw = np.random.default_rng(1)
    rows = np.floor(draw.normal(size=(300, 21)) * 50)
    anchors = np.floor(draw.normal(size=(7, 21)) * 50)
    order = np.argsort(-(rows**2).sum(axis=0))
    scores = anchors @ rows.T
    reach = float(np.sqrt((anchors**2).sum(axis=1)).max())
    for level in (-1e9, 0, 5_000, 20_000, 40_000):
        least = np.full(7, float(level))
        index = negatives.Index(rows, order, level, reach)
        a, r, s = index.pairs(anchors, least)
        wanted = {(i, j, int(scores[i, j])) for i, j in zip(*np.nonzero(scores >= level))}
        assert set(zip(a.tolist(), r.tolist(), s.tolist())) == wanted
    assert negatives.Index(rows, order, 20_000, reach).listed[-1] < len(rows)


# suffix arrays


def some_strings(draw):
    letters = draw.choice([1, 2, 3, 26])
    made = [
        bytes(draw.randrange(97, 97 + letters) for _ in range(draw.randint(0, 30)))
        for _ in range(draw.randint(1, 6))
    ]
    return made + [made[0] * 3] if draw.random() < 0.3 else made


@pytest.mark.parametrize("short", [1, 8, 1 << 16])
def test_suffix_array(monkeypatch, short):
    monkeypatch.setattr(suffixes, "SHORT", short)
    draw = random.Random(short)
    for _ in range(150):
        strings = some_strings(draw)
        text, begins = suffixes.joined(strings)
        letters = text.tolist()
        whole = suffixes.suffix_array(text).tolist()
        assert whole == sorted(range(len(letters)), key=lambda i: letters[i:])
        order = suffixes.suffix_array(text, strings=True)
        until = [letters[i : letters.index(suffixes.BREAK, i) + 1] for i in range(len(letters) - 1)]
        until.append([suffixes.END])
        assert sorted(order.tolist()) == list(range(len(letters)))
        assert all(until[a] <= until[b] for a, b in zip(order, order[1:]))


def test_common_prefixes():
    draw = random.Random(5)
    for _ in range(100):
        strings = some_strings(draw)
        text, begins = suffixes.joined(strings)
        order = suffixes.suffix_array(text, strings=True)
        got = suffixes.common_prefixes(text, order, begins, max(map(len, strings)))
        for before, place in zip(order, order[1:]):
            a, b = (text[i:].tolist() for i in (before, place))
            room = a.index(suffixes.BREAK) if suffixes.BREAK in a else 0
            room = min(room, b.index(suffixes.BREAK) if suffixes.BREAK in b else 0)
            same = next((n for n in range(room) if a[n] != b[n]), room)
            assert min(got[place], room) == same


def repeated(strings, length):
    seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
    return [[i for i in range(len(s) - length + 1) if seen[s[i : i + length]] > 1] for s in strings]


def test_repeated_places():
    draw = random.Random(9)
    for _ in range(150):
        strings = some_strings(draw)
        for length in (1, 2, 5, 9):
            got = suffixes.repeated_places(strings, length)
            assert [g.tolist() for g in got] == repeated(strings, length)


# removal of repeated substrings


def removed(texts, length):
    """``n_bytes, n_removed, n_spans, spans, kept`` of each text, byte by byte."""
    whole = [(t or "").encode() for t in texts]
    out = []
    for data, places in zip(whole, repeated(whole, length), strict=True):
        gone = np.zeros(len(data) + 2, dtype=int)
        for i in places:
            gone[i + 1] += 1
            gone[i + 1 + length] -= 1 if i + 1 + length < len(gone) else 0
        gone = np.concatenate([[False], np.cumsum(gone)[1 : len(data) + 1] > 0, [False]])
        edges = np.flatnonzero(np.diff(gone.astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        kept = bytes(b for b, g in zip(data, gone[1:-1], strict=True) if not g)
        out.append((len(data), int(gone.sum()), len(spans), spans, kept))
    return out


def passages(seed):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdé ") for _ in range(draw.randint(3, 9))) for _ in range(60)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    shared = [text(draw.randint(5, 40)) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [text(draw.randint(0, 30))]
        for _ in range(draw.randint(0, 3)):
            parts += [draw.choice(shared), text(draw.randint(0, 10))]
        rows.append((i, draw.choice(["", " "]).join(parts)))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, rows[1][1][:80]), (103, "ab" * 300)]
    rows += [(104, None), (105, ""), (106, "short"), (106, "short"), (None, rows[2][1] + "!")]
    return rows + [(107, shared[0] + "x" * 500), (107, "x" * 130 + shared[1])]


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"kinds_per_anchor": 1},
        {"kinds_per_anchor": 2, "broadcast_keys": 0, "shard_bytes": 500},
    ],
)
@pytest.mark.parametrize("length", [60, 20])
def test_removed_bytes(frame, options, length):
    rows = passages(length)
    docs = frame([(i, t, "k", 1) for i, t in rows], TEXTS)
    wanted = defaultdict(list)
    for (i, t), (n, gone, count, spans, kept) in zip(rows, removed([t for _, t in rows], length), strict=True):
        wanted[i, n].append((gone, count, [tuple(s) for s in spans], kept))
    got = defaultdict(list)
    for r in substrings.remove_repeats(docs, length, **options).collect():
        spans = [(s.start, s.stop) for s in r.spans]
        got[r.doc_id, r.n_bytes].append((r.n_removed, r.n_spans, spans, bytes(r.kept)))
    assert got.keys() == wanted.keys()
    for key, some in wanted.items():
        assert sorted(got[key]) == sorted(some), key


def test_long_texts_are_read_in_parts(frame, monkeypatch):
    monkeypatch.setattr(substrings, "_PART", 100)
    rows = passages(3)
    rows.append((200, " ".join(t for _, t in rows if t)))
    docs = frame([(i, t, "k", 1) for i, t in rows], TEXTS)
    got = substrings.remove_repeats(docs.filter("doc_id >= 150 OR doc_id < 5"), 60, digests=True)
    texts = [t for i, t in rows if i is not None and (i >= 150 or i < 5)]
    wanted = [(n, g, s, hashlib.sha256(k).hexdigest()) for n, g, s, _, k in removed(texts, 60)]
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(wanted)


def test_substrings_of_empty_tables(frame, spark):
    assert substrings.remove_repeats(frame([], TEXTS)).count() == 0
    only = frame([(1, None, "k", 1), (2, "a", "k", 1)], TEXTS)
    got = substrings.remove_repeats(only).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.spans, bytes(r.kept)) for r in got] == [
        (0, 0, 0, [], b""), (1, 0, 0, [], b"a"),
    ]


def test_substring_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    wanted = removed([d.text for d in docs], 200)
    got = {tuple(r) for r in QUERIES["op12_substring_dedup"](spark, FOLDER).collect()}
    assert got == {
        (d.doc_id, n, gone, spans, hashlib.sha256(kept).hexdigest())
        for d, (n, gone, spans, _, kept) in zip(docs, wanted, strict=True)
    }


# whitening


def check_whitened(got, rows, multiplicity=True, components=8):
    """Against numpy, up to the sign of a component."""
    x = np.floor(1024 * np.array([e for _, e in rows])) + 100_000
    fit = x if multiplicity else np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    covariance = np.cov(fit.T, bias=True).reshape(x.shape[1], -1)
    values = np.linalg.eigvalsh(covariance)[::-1][:components]
    table = defaultdict(dict)
    for r in got:
        table[r.vec_id][r.component] = r
    assert len(got) == len(rows) * len(values)
    out = np.array([[table[i][k + 1].whitened for k in range(len(values))] for i, _ in rows])
    centred = x - total / n
    for k, value in enumerate(values):
        axis = np.linalg.lstsq(centred, out[:, k] * np.sqrt(value), rcond=None)[0]
        assert np.allclose(centred @ axis / np.sqrt(value), out[:, k], atol=1e-8)
        assert np.allclose(covariance @ axis, value * axis, atol=1e-6 * max(values))
        assert abs(np.linalg.norm(axis) - 1) < 1e-8
        one = table[rows[0][0]][k + 1]
        assert one.explained == pytest.approx(value / np.trace(covariance))
        assert one.n == n and one.identity_error < 1e-8
    for (i, _), v in zip(rows, x, strict=True):
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, total, strict=True))
        assert table[i][1].deviation == exact
    if multiplicity:
        assert np.allclose(np.cov(out.T, bias=True), np.eye(len(values)), atol=1e-8)


@pytest.mark.parametrize("multiplicity", [True, False])
def test_whitening(frame, multiplicity):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=10).tolist()) for i in range(80)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(60)]
    df = vectors(frame, [(i, e, 0) for i, e in rows])
    check_whitened(whitening.whiten(df, multiplicity=multiplicity).collect(), rows, multiplicity)


def test_whitening_awkward(frame):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=3).tolist()) for i in range(30)]
    odd = [(40, None), (41, [1.0, None, 2.0]), (42, [float("nan")] * 3), (43, [1.0]), (44, [])]
    odd += [(45, [float("inf"), 0.0, 0.0])]
    df = vectors(frame, [(i, e, 0) for i, e in rows + odd])
    check_whitened(whitening.whiten(df).collect(), rows)
    assert whitening.whiten(vectors(frame, [])).count() == 0
    assert whitening.whiten(vectors(frame, [(40, None, 1), (44, [], 1)])).count() == 0


def test_whitening_without_variance(frame):
    rows = [(1, [0.5, 0.25], 0), (1, [0.5, 0.25], 0), (None, [0.5, 0.25], 0)]
    got = whitening.whiten(vectors(frame, rows)).collect()
    assert len(got) == 6 and {(r.whitened, r.explained, r.identity_error) for r in got} == {(None,) * 3}
    assert {r.deviation for r in got} == {0} and {r.n for r in got} == {3}
    line = [(i, [float(i), 2.0 * i], 0) for i in range(5)]
    got = whitening.whiten(vectors(frame, line)).collect()
    assert {r.component for r in got if r.whitened is None} == {2}
    assert all(r.identity_error < 1e-8 for r in got)


def test_whitening_of_large_components(frame):
    rows = [(i, [1e9 * i, float(i % 3)], 0) for i in range(10)]
    rows.append((10, [1e300, 0.0], 0))
    got = whitening.whiten(vectors(frame, rows)).collect()
    assert len(got) == 22 and all(r.deviation is None for r in got if r.vec_id == 10)


def test_exact_deviations():
    x = np.array([[3, -4], [2**40, 5]])
    sums = np.array([10, 2**41], dtype=object)
    small = [sum((2 * int(v) - int(s)) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    assert whitening.deviations(x, 2, sums) == [v if v < 2**63 else None for v in small]


def test_whitened_query_covers_all_rows(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    got = QUERIES["op13_embedding_whitening"](spark, FOLDER)
    assert got.count() == 8 * rows.count()
    assert got.select(F.max("identity_error")).first()[0] < 1e-4


# nearest neighbours, chats, toxicity: repeated ids, few rows, odd roles


def nearest_by_hand(rows, k=10):
    """Of each id that 100 divides: the nearest other ids, by their nearest row."""
    first = {}
    for i, e in rows:
        if i % 100 == 0:
            first[i] = min(first.get(i, e), e)
    out = []
    for q, x in first.items():
        best = {}
        for i, e in rows:
            if i != q:
                d = float(np.sqrt(((np.array(e) - np.array(x)) ** 2).sum()))
                best[i] = min(best.get(i, d), d)
        ranked = sorted(best.items(), key=lambda p: (p[1], p[0]))[:k]
        out += [(q, n + 1, i, round(d, 9)) for n, (i, d) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("rows_per_block", [7, 4096])
def test_nearest_with_repeated_ids(frame, rows_per_block):
    draw = np.random.default_rng(4)
    rows = [(i, np.round(draw.normal(size=5), 2).tolist()) for i in range(120)]
    rows += [(100, rows[3][1])] * 2 + [(7, rows[9][1]), (7, rows[7][1]), (0, rows[50][1]), (200, [1.0] * 5)]
    rows += [(300 + i % 3, rows[0][1]) for i in range(40)]
    df = frame([(i, e, 0, "x", 1, 2) for i, e in rows], "vec_id bigint, embedding array<double>, part int, visits string, block int, kind int")
    got = nearest.nearest(df, rows_per_block=rows_per_block)
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got.collect()) == nearest_by_hand(rows)


def test_nearest_searches_further_when_rows_are_few(frame):
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(size=4) + 20 * (i % 16)).tolist()) for i in range(600)]
    rows += [(1000, [500.0, 0.0, 0.0, 0.0]), (1001, [501.0, 0.0, 0.0, 0.0])]
    df = frame(rows, "vec_id bigint, embedding array<double>")
    got = nearest.nearest(df, recall=0.0, k=60).groupBy("query_id").count().collect()
    assert {r["count"] for r in got} == {60}
    few = nearest.nearest(df.filter("vec_id < 4")).collect()
    assert [(r.query_id, r.rank) for r in sorted(few, key=lambda r: r.rank)] == [(0, 1), (0, 2), (0, 3)]


def test_roles_with_line_breaks(frame):
    roles = ["assistant\n", "a\nb", "user", "assistant", "100%", "%0A", "%25\n", "", None, "x</s>\n<<SYS>>"]
    rows = [(c, t, roles[(c + t) % len(roles)], f"text\n{t}%") for c in range(12) for t in range(c % 7 + 1)]
    turns = frame(rows, "conv_id bigint, turn bigint, role string, text string")
    read = chat.format_conversations(turns).select("conv_id", chat.read_turns(F.col("formatted")).alias("t"))
    got = {r.conv_id: [(t.role, t.text) for t in r.t] for r in read.collect()}
    assert got == {
        c: [(role or "", text) for i, _, role, text in sorted(rows, key=lambda r: r[:2]) if i == c]
        for c in range(12)
    }


def test_repeated_ids_are_learned_from_once(frame):
    rows = [(i, f"word {i}") for i in range(20)] + [(1, f"copy {i}") for i in range(60)]
    rows += [(None, "no id")] * 3
    docs = frame(rows, "doc_id bigint, text string")
    labels = frame([(i, i % 2) for i in range(20)] + [(1, 0)], "doc_id bigint, toxic int")
    learned = toxicity.learning_rows(docs, labels, 30_000).collect()
    assert len({r.doc_id for r in learned}) == len(learned) <= 20
    again = toxicity.learning_rows(docs.repartition(5), labels, 30_000).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, learned))


def test_texts_without_letters_have_no_language(frame):
    texts = ["²½ 12", "Ⅷ", "12 _ ?", "", None, "½ a", "ª", "中"]
    docs = frame(list(enumerate(texts)), "doc_id bigint, text string")
    model = language.ByteGru(["de", "en"])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_language(docs, model).collect()}
    assert [got[i][0] == "und" for i in range(len(texts))] == [True] * 5 + [False] * 3
    assert {got[i][1] for i in range(5)} == {0.0}


def test_sample_is_the_first_of_each_language_by_hash(spark):
    docs = spark.range(5000).selectExpr(
        "id as doc_id", "if(id % 9 = 0, null, if(id % 11 = 0, 'fr', if(id % 3 = 0, 'de', 'en'))) as lang",
        "concat('text number ', id) as text",
    )
    pieces = language.training_windows(docs, per_language=40, per_text=1, size=64).collect()
    learned = docs.filter((common.crc32_bucket("doc_id", 5) != 0) & F.col("lang").isNotNull())
    hashed = learned.select("lang", "text", F.xxhash64("doc_id").alias("h")).collect()
    for lang in ("de", "en", "fr"):
        wanted = sorted((r.h, r.text) for r in hashed if r.lang == lang)[:40]
        assert sorted(r.piece for r in pieces if r.lang == lang) == sorted(t for _, t in wanted)


# equal rows, and the last two stages of the pipeline


def test_equal_rows_are_numbered_without_gaps(spark):
    rows = spark.range(5000).selectExpr("if(id % 3 = 0, 7, id + 10) as h").repartition(6)
    rows = save(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    got = mixing.numbered_repeats(rows, 10).collect()
    assert sorted(r.number for r in got if r.h == 7) == list(range(1667))
    assert {r.number for r in got if r.h != 7} == {0} and len(got) == 5000


def test_many_equal_rows_are_mixed(spark):
    docs = spark.range(20_000).selectExpr(
        "cast(null as bigint) as doc_id", "'a b c' as text",
        "if(id % 4 = 0, cast(null as string), if(id % 4 = 1, 'x', 'y')) as source",
    )
    got = mixing.mix_sources(docs.repartition(5)).groupBy("source_size").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target"),
        F.max("copies").alias("most"),
    )
    again = mixing.mix_sources(docs.repartition(3)).agg(F.sum("taken")).first()[0]
    rows = got.collect()
    assert sum(r.n for r in rows) == 20_000 and sum(r.taken for r in rows) == again
    assert max(r.most for r in rows) <= 2
    # half as much again as all words, but for a text of each source
    assert abs(again - 1.5 * 60_000) <= 9


def test_many_equal_pieces_are_dealt_to_groups(spark):
    docs = spark.range(40_000).selectExpr("cast(null as bigint) as doc_id", "'' as text")
    packed = packing.pack_documents(docs.repartition(4), added=True)
    assert packed.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    filled = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("ids"), F.count("*").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")
    )
    rows = filled.collect()
    assert sum(r.n for r in rows) == 40_000 and all(r.ids == r.end <= 2048 for r in rows)
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "__number" in plan


def test_mixing_and_packing_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    mixed = save(stages["mixing"](spark, docs, FOLDER), "mixed")
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(docs).collect()}
    rows = mixed.collect()
    assert Counter(r.doc_id for r in rows) == Counter({i: n for i, n in copies.items() if n})
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all((r.text or "") == texts[r.doc_id] for r in rows)

    import public_tokenizers
    import tokenizers

    coder = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stages["packing"](spark, mixed, FOLDER).collect()
    by_doc = defaultdict(Counter)
    for p in pieces:
        by_doc[p.doc_id][p.start, p.length, p.ids_crc32, p.doc_tokens] += 1
    for i, often in copies.items():
        if not often:
            assert i not in by_doc
            continue
        ids = np.array([*coder.encode(texts[i], add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for (start, length, crc, tokens), n in sorted(by_doc[i].items()):
            assert (start, n, tokens) == (at, often, len(ids))
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    places = defaultdict(list)
    for p in pieces:
        places[p.sequence_id].append((p.offset, p.length))
    assert sorted(places) == list(range(len(places)))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048


def test_pipeline_removes_its_tables(spark):
    scratch = Path(scratch_dir(spark))
    before = set(scratch.iterdir())
    out = corpus_pipeline.run(spark, FOLDER)
    left = {p.name.split("-")[0] for p in set(scratch.iterdir()) - before}
    assert out.count() > 0 and left <= {"pipeline", "pack"}

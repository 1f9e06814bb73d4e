"""Dealt operators against brute force and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import connect, difference
from tidepost.llm import (
    chat,
    exact,
    graph,
    jaccard,
    language,
    mixing,
    nearest,
    packing,
    sentences,
    sharding,
    toxicity,
)
from tidepost.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, kept string, size int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(count, seed):
    draw = random.Random(seed)
    return [
        "".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(count)
    ]


LONG = " ".join(words(3000, 1))
ROWS = [
    (1, "Same  text\there", "en", "b", "x", 1),
    (0, "Same text here", "en", "a", None, 2),
    (2, None, None, None, "y", None),
    (3, "", "de", "a", "z", 3),
    (None, "Same text here", "en", None, "x", 4),
    (5, LONG, "fr", "a", "x", 5),
    (5, LONG, "fr", "a", "x", 5),
    (6, "éß 123 !!", "de", "b", "x", 6),
    (7, "123 456", "en", "b", "x", 7),
    (8, " \n ", "en", "b", "x", 8),
]


@pytest.fixture
def awkward(frame):
    return frame(ROWS, SCHEMA)


@pytest.fixture
def empty(frame):
    return frame([], SCHEMA)


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


# exact duplicates


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_exact_dedup_awkward(awkward, limit):
    rows = exact.exact_dedup(awkward, broadcast_bytes=limit, digest=True).collect()
    assert len(rows) == len(ROWS)
    groups = defaultdict(list)
    for r in rows:
        groups[r.text_sha256].append(r)
    same = hashlib.sha256(b"Same text here").hexdigest()
    assert {(r.doc_id, r.keep_id, r.kept) for r in groups[same]} == {
        (0, 0, True),
        (1, 0, False),
        (None, 0, False),
    }
    assert all(sum(r.kept for r in g) == 1 for g in groups.values())
    assert all(r.group_size == len(g) for g in groups.values() for r in g)


def test_drop_exact_keeps_columns(awkward, empty):
    kept = exact.drop_exact(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 5, 6, 7, 8]
    assert exact.drop_exact(empty).count() == 0


# sharding


def test_hypergeometric_frequencies(spark):
    total, good, draws, n = 40, 15, 12, 4000
    u = (F.col("id") + 0.5) / n
    x = sharding.hypergeometric(F.lit(total), F.lit(good), F.lit(draws), u)
    seen = Counter(r[0] for r in spark.range(n).select(x).collect())
    for k in range(draws + 1):
        share = math.comb(good, k) * math.comb(total - good, draws - k) / math.comb(total, draws)
        assert abs(seen[k] / n - share) < 2 / n


def test_matrix_rows_and_columns(spark):
    sizes = [(p, 3 + p % 7) for p in range(150)]
    total = sum(n for _, n in sizes)
    shards = [total // 4 + (i < total % 4) for i in range(4)]
    matrix = sharding.communication_matrix(
        spark.createDataFrame(sizes, "part bigint, n bigint"), shards, 3
    )
    rows = {r.part: r.counts for r in matrix.collect()}
    assert all(sum(rows[p]) == n and min(rows[p]) >= 0 for p, n in sizes)
    assert [sum(c) for c in zip(*rows.values(), strict=True)] == shards


def test_shards(awkward, empty, tables):
    docs, texts = tables
    rows = sharding.shard_rows(docs).collect()
    by_shard = defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        by_shard[r.shard].append(r.slot)
    assert sorted(by_shard) == list(range(40))
    assert all(sorted(s) == list(range(len(texts) // 40)) for s in by_shard.values())
    few = sharding.shard_rows(awkward, shards=3).collect()
    assert sorted(Counter(r.shard for r in few).values()) == [3, 3, 4]
    assert sharding.shard_rows(empty).count() == 0


# mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, budget = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        per = budget / sum(weight[s] for s in open_)
        over = {s for s in open_ if per * weight[s] > 2 * sizes[s]}
        if not over:
            target.update({s: per * weight[s] for s in open_})
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        budget -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def test_mixing(tables, awkward, empty):
    docs, texts = tables
    source = {r.doc_id: r.source for r in docs.collect()}
    size = {d: len(WORD.findall(t)) for d, t in texts.items()}
    sizes = Counter()
    for d, s in source.items():
        sizes[s] += size[d]
    target = brute_targets(sizes)
    rows = mixing.mix_sources(docs).collect()
    taken, largest = Counter(), Counter()
    for r in rows:
        s = source[r.doc_id]
        factor = target[s] / sizes[s]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s]
        assert r.target == pytest.approx(target[s])
        assert r.copies in (math.floor(factor + 1e-9), math.ceil(factor - 1e-9))
        assert r.taken == r.size * r.copies <= 2 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    assert len(rows) == len(texts)
    # mass moves between documents, so a source misses its target by less than one document
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(again) == sorted(rows)
    assert len(mixing.mix_sources(awkward).collect()) == len(ROWS)
    assert mixing.mix_sources(empty).count() == 0


def test_mixed_documents(tables, awkward):
    docs, _ = tables
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(docs, group=8).collect()}
    mixed = mixing.mixed_documents(docs, group=8)
    assert mixed.columns == docs.columns
    seen = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert seen == Counter({d: c for d, c in copies.items() if c})
    assert mixing.mixed_documents(awkward).count() == sum(
        r.copies for r in mixing.mix_sources(awkward).collect()
    )


# toxicity


def test_toxicity_held_out(tables, frame, awkward, empty):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(600):
        toxic = int(i % 6 == 0)
        text = words(40, i) + (rng.sample(["nastyone", "badword", "uglyword"], 2) if toxic else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        marks.append((i, toxic))
    docs, labels = frame(rows, "doc_id bigint, text string"), frame(marks, "doc_id bigint, toxic int")
    scored = toxicity.score_toxicity(docs, labels).collect()
    toxic = dict(marks)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
    held = [r for r in scored if r.held_out]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    few = toxicity.score_toxicity(awkward, labels.limit(0)).collect()
    assert len(few) == len(ROWS) and all(0 <= r.score <= 1 for r in few)
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_labels_of_held_out_rows_are_not_read(frame):
    docs = frame([(i, f"word{i % 9} text") for i in range(60)], "doc_id bigint, text string")
    marks = [(i, int(i % 9 == 1)) for i in range(60)]
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in marks]
    scores = [
        sorted(toxicity.score_toxicity(docs, frame(m, "doc_id bigint, toxic int")).collect())
        for m in (marks, flipped)
    ]
    assert scores[0] == scores[1]


def test_counts_fall_back_to_lower_voters(frame):
    voters = ["=bad 1", "ugly~ 2", "=mean 1", "=mean 3", "=rare 3"]
    texts = ["bad", "bad bad", "Bad bad x bad bad", "uglyx", "uglyx uglyy", "uglyx " * 5]
    texts += ["mean", "mean mean", "mean " * 4, "rare rare", "rare " * 3]
    docs = frame(list(enumerate(texts)), "doc_id bigint, text string")
    fired = {r.doc_id: r.votes for r in toxicity.cast_votes(docs, voters).collect()}
    assert [fired[i] for i in range(len(texts))] == [[0]] * 3 + [[], [1], [1], [2], [2], [3], [], [4]]


# chat


def test_chat_round_trip(frame, spark):
    says = ["</s>[INST] ok [/INST]", "a<sep>b", "<\\/s> <\\\\s>", "<<SYS>>x\n<</SYS>>", "", None]
    says += ["ends with <", "[INST] [/INST", "\\", "plain", LONG]
    roles = ["user", "assistant", "assistant", "tool <s>", None, "system", "user", "user"]
    rows = [
        (conv, turn, roles[(conv + turn) % len(roles)], says[(3 * conv + turn) % len(says)])
        for conv in range(24)
        for turn in range(conv % 9 + 1)
    ]
    rows += [(None, 0, "user", "no id"), (99, None, "user", "no turn"), (99, 1, "user", "no turn")]
    turns = frame(rows, "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_conversations(turns.withColumn("formatted", F.lit(1)))
    read = formatted.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()
    expected = defaultdict(list)
    for conv, turn, role, text in rows:
        expected[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert {r.conv_id: [(t.role, t.text) for t in r.t] for r in read} == {
        c: [(role, text) for _, _, role, text in sorted(t)] for c, t in expected.items()
    }
    assert chat.format_conversations(turns.limit(0)).count() == 0


# nearest neighbours


def test_nearest_recall_and_scores(frame, spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[40:80] = x[0]
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))]
    odd = [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [None] * 16)]
    odd += [(5400, [1.0] * 3), (None, [1.0] * 16)]
    vectors = frame(rows + odd, "vec_id bigint, embedding array<float>")
    found = defaultdict(list)
    for r in nearest.nearest(vectors, sample=600, rows_per_block=200).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(found) == [i for i in range(len(x)) if i % 100 == 0]
    hits = 0
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 11))
        distance = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        distance[q] = np.inf
        best = np.lexsort((np.arange(len(x)), distance))[:10]
        hits += len(set(best) & {g[1] for g in got})
        assert all(g[2] == pytest.approx(distance[g[1]], abs=1e-12) for g in got)
    assert [g[1] for g in found[0]] == list(range(40, 50))
    assert hits >= 0.9 * 10 * len(found)
    assert nearest.nearest(vectors.limit(0)).count() == 0


# similar texts


def brute_components(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for doc, text in texts.items():
        w = WORD.findall((text or "").translate(lower))
        runs = [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []
        sets[doc] = frozenset(runs)
    head = {d: d for d in texts}

    def find(d):
        while head[d] != d:
            d = head[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in texts}


@pytest.mark.parametrize("bucket,flush", [(500_000, 700_000), (400, 300)])
def test_similar_groups(frame, bucket, flush):
    rng = random.Random(8)
    texts = {0: None, 1: "", 2: " \n", 3: "Two words", 4: "two  WORDS", 5: "two other"}
    for family in range(12):
        base = words(rng.choice([6, 30, 80, 200]), 100 + family)
        for _ in range(rng.choice([1, 2, 12, 40])):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 20)):
                copy[rng.randrange(len(copy))] = rng.choice("klmno")
            texts[len(texts)] = " ".join(copy)
    passage = " ".join(words(60, 7))
    for i in range(30):
        texts[len(texts)] = passage + " " + " ".join(words(rng.randint(1, 40), 900 + i))
    docs = frame([(d, t, "x", 1) for d, t in texts.items()],
                 "doc_id bigint, text string, component_id string, class int")
    got = jaccard.similar_groups(docs, per_bucket=bucket, flush=flush).collect()
    expected = brute_components(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    if flush > 10_000:
        kept = jaccard.drop_similar(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in expected.values()})


def test_shingles_are_told_apart_by_whole_hashes(frame):
    ends = [216209, 2511826, 364635, 2370774]  # in pairs, the last 40 bits of the hashes are equal
    docs = frame([(i, f"a b c d {n}") for i, n in enumerate(ends)], "doc_id bigint, text string")
    groups = {r.doc_id: r.component_id for r in jaccard.similar_groups(docs).collect()}
    assert groups == {i: i for i in range(4)}


def test_similar_groups_awkward(awkward, empty):
    rows = jaccard.similar_groups(awkward).collect()
    assert len(rows) == len(ROWS)
    assert sorted((r.doc_id or -1, r.component_id) for r in rows if r.n_shingles == 1)[:3] == [
        (-1, 0),
        (-1, 0),
        (1, 0),
    ]
    assert jaccard.similar_groups(empty).count() == 0
    assert jaccard.drop_similar(awkward).count() == 7


def test_components_of_chain_and_star(frame):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    labels = {r.node: r.label for r in graph.components(frame(links, "a bigint, b bigint")).collect()}
    assert labels == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


# language


def test_language_held_out(tables, awkward, empty):
    docs, _ = tables
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs, steps=120).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    few = {r.doc_id: r for r in language.identify(awkward, steps=5).collect()}
    assert [few[d].lang_pred for d in (2, 3, 7, 8)] == ["und"] * 4 and few[6].lang_pred != "und"
    kept = language.known_language(awkward.withColumn("score", F.lit(1)), least=0.0, steps=5)
    assert kept.columns == [*awkward.columns, "score"] and kept.count() == 6
    assert language.identify(empty).count() == 0


def test_gru_gradients():
    model = language.ByteGru(["a", "b"], hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rng = np.random.default_rng(0)
    data = rng.integers(97, 102, (6, 4)).astype(np.uint8)
    label = np.array([0, 1, 1, 0])
    weight = np.ones(data.shape, np.float32)

    def loss():
        e = model._states(data, "f") @ model.p["vf"] + model._states(data, "b") @ model.p["vb"]
        e = e + model.p["b"]
        e -= np.log(np.exp(e).sum(axis=2, keepdims=True))
        return -e[:, np.arange(4), label].mean()

    grads = model.gradients(data, weight, label)
    for key, at in (("xf", (98, 4)), ("ub", (1, 7)), ("uf", (2, 0)), ("vb", (0, 1))):
        step = 1e-2
        model.p[key][at] += step
        high = loss()
        model.p[key][at] -= 2 * step
        low = loss()
        model.p[key][at] += step
        assert grads[key][at] == pytest.approx((high - low) / (2 * step), rel=0.05, abs=2e-4)


# passages


def brute_spans(text):
    out, current = [], []
    for m in WORD.finditer(text):
        if current and (
            current[-1].group()[-1] in ".!?"
            or re.search(r"[\n\r]", text[current[-1].end() : m.start()])
            or len(current) == sentences.LONGEST
        ):
            out.append(current)
            current = []
        current.append(m)
    out += [current] if current else []
    spans = []
    for i in range(len(out)):
        for j in range(i + sentences.SENTENCES - 1, len(out)):
            run = [w for s in out[i : j + 1] for w in s]
            if len(run) >= sentences.WORDS:
                spans.append((tuple(w.group() for w in run), i, j, run[0].start(), run[-1].end()))
                break
    return spans


def test_repeated_passages(frame, awkward, empty):
    rng = random.Random(6)
    passage = ". ".join(" ".join(words(9, s)) for s in range(6)) + "."
    texts = {}
    for d in range(40):
        own = [". ".join(" ".join(words(8, 1000 + 10 * d + s)) for s in range(5)) + ". é"] * 1
        if d % 3 == 0:
            own.insert(rng.randint(0, 1), passage)
        if d == 9:
            own += [passage]
        texts[d] = "\n".join(own)
    docs = frame(list(texts.items()), "doc_id bigint, text string")
    first, covered = {}, defaultdict(set)
    for d, text in texts.items():
        for key, i, j, *_ in brute_spans(text):
            if key in first:
                covered[d].update(range(i, j + 1))
            first.setdefault(key, d)
    got = defaultdict(set)
    passages = sentences.repeated_passages(docs)
    for r in passages.collect():
        got[r.doc_id].update(range(r.first_sentence, r.last_sentence + 1))
        assert all(k in texts for k in r.kept_in)
    assert got == covered and set(got) == {d for d in texts if d % 3 == 0 and d}
    cleaned = {r.doc_id: r.text for r in sentences.without_passages(docs, passages).collect()}
    assert all(cleaned[d] == texts[d] for d in texts if d not in got)
    assert all(passage not in cleaned[d] for d in got) and passage in cleaned[0]
    odd = sentences.repeated_passages(awkward)
    assert odd.count() == 0
    assert sentences.without_passages(awkward, odd).count() == len(ROWS)
    assert sentences.repeated_passages(empty).count() == 0


def test_passages_that_begin_within_a_sentence(frame):
    rng = random.Random(7)
    texts, planted = {}, {}
    for g in range(30):
        passage = words(51 + g, 5000 + g)
        if g % 3 == 1:
            passage[10 + g] += "."
        if g % 3 == 2:
            passage[7] += "."
            passage[-9] += "!"
        for d in (2 * g, 2 * g + 1):
            before, after = words(rng.randint(1, 40), 6000 + d), words(rng.randint(0, 40), 7000 + d)
            texts[d] = " ".join(before + passage + after)
            start = len(" ".join(before)) + 1
            planted[d] = start, start + len(" ".join(passage))
    docs = frame(list(texts.items()), "doc_id bigint, text string")
    got = defaultdict(list)
    for r in sentences.repeated_passages(docs).collect():
        assert r.kept_in == [r.doc_id - 1]
        got[r.doc_id].append((r.start, r.stop))
    assert sorted(got) == list(range(1, 60, 2))
    for d, ((start, stop),) in got.items():
        a, b = planted[d]
        assert a <= start < stop <= b
        head, body, tail = (len(t.split()) for t in (texts[d][a:start], texts[d][start:stop], texts[d][stop:b]))
        assert head <= 16 and body >= sentences.WORDS and tail <= 15


def test_passages_of_null_and_repeated_ids(frame):
    a, b, c = (". ".join(" ".join(words(9, 100 * n + s)) for s in range(6)) + "." for n in (81, 82, 83))
    own = [" ".join(words(30, 9000 + n)) + "." for n in range(9)]
    least, most = -(2**63), 2**63 - 1
    rows = [
        (None, f"{own[0]}\n{own[8]}\n{a}"),
        (None, f"{a}\n{own[1]}"),
        (most, f"{own[2]}\n{b}"),
        (None, f"{b}\n{own[3]}"),
        (None, own[7]),
        (4, f"{own[4]}\n{c}"),
        (4, f"{c}\n{own[5]}"),
        (least, f"{own[6]}\n{own[0]}"),
    ]
    docs = frame(rows, "doc_id bigint, text string")
    passages = sentences.repeated_passages(docs)
    got = {(r.doc_id, tuple(r.kept_in)) for r in passages.collect()}
    assert got == {(None, (least,)), (None, (None,)), (None, (most,)), (4, (4,))}
    left = sorted(r.text for r in sentences.without_passages(docs, passages).collect())
    joined = "\n".join(left)
    assert len(left) == len(rows)
    assert all(joined.count(x) == 1 for x in (a, b, c, *own))
    assert all(rows[i][1] in left for i in (2, 4, 7))


# packing


def test_packing_round_trip(tables, awkward, empty, spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs, texts = tables
    odd = ["<|endoftext|> x", "a\x1cb²½ ́ \xa0 z_9 it's  \n\n end ", "😀 日本語 ١٢٣"]
    more = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(odd)], "doc_id bigint, text string")
    texts = texts | {-i - 1: t for i, t in enumerate(odd)}
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    rows = packing.pack_documents(docs.select("doc_id", "text").unionByName(more), keep_ids=True)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows.collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32
    for d, text in texts.items():
        ids = coder.encode(text, add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[d], key=lambda r: r.start)
        assert b"".join(p.ids for p in pieces) == np.array(ids, "<u4").tobytes()
        assert all(p.doc_tokens == len(ids) for p in pieces)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    used = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        used += at
    assert used >= 0.85 * len(by_sequence) * packing.CAPACITY
    whole = packing.sequences(rows).collect()
    sizes = [len(r.ids) // 4 for r in whole]
    assert all(n == packing.CAPACITY or n & (n - 1) == 0 for n in sizes)
    few = packing.pack_documents(awkward).collect()
    assert {r.doc_tokens for r in few if r.doc_id in (2, 3)} == {1}
    assert len([r for r in few if r.start == 0]) == len(ROWS)
    assert packing.pack_documents(empty).count() == 0


def test_packing_splits_at_added_tokens(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"{end} x", end, f"a  {end}  b's{end}{end}\n", f"<|{end}|> <|endoftext |>", "plain", None]
    texts += [f"é²{end}日本語 {end[:-1]}", " ".join([*words(3000, 3), end, *words(9, 4)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = set()
    for d, text in enumerate(texts):
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        start = 0
        for n in packing.cut_lengths(len(ids), packing.CAPACITY, 0.06):
            expected.add((d, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids)))
            start += n
    packed = (QUERIES["op10_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, ""))
    for rows in packed:
        rows = rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()
        assert sorted(map(tuple, rows)) == sorted(expected)


# the pipeline


def test_pipeline_stages(spark, tables):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "jaccard_join", "mixing", "packing"]
    docs, texts = tables
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, FOLDER)
        assert kept.columns == docs.columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        left = {r.doc_id for r in kept.collect()}
        if name == "exact_dedup":
            norm = {d: re.sub(r"[\x20\x09-\x0D]+", " ", texts[d]) for d in before}
            assert left == {min(d for d in before if norm[d] == norm[x]) for x in before}
        if name == "jaccard_join":
            groups = brute_components({d: texts[d] for d in before})
            assert left == {c for _, c in groups.values()}
        before = left
    assert corpus_pipeline.run(spark, FOLDER).count() > len(left)

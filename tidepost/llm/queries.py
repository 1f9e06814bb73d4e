"""Queries of the operators of this folder, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost.llm import (
    chat,
    exact,
    jaccard,
    language,
    mixing,
    nearest,
    negatives,
    packing,
    sentences,
    sharding,
    substrings,
    toxicity,
    whitening,
)
from tidepost.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def wrap(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return wrap


@_query(r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h)
""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(table(spark, folder, "documents"), digest=True)


@_query()
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.shard_rows(table(spark, folder, "documents"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query()
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


@_query(r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, lag(role) OVER w AS before,
    regexp_replace(text, '([<\[])(\\*)(/?s>|sep>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS safe,
    regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'),
      '([<\[])(\\*)(/?s>|sep>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS safe_role
  FROM raw WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), sized AS (
  SELECT *, length(safe) + CASE
    WHEN before = role THEN length('<sep>')
    WHEN role = 'user' THEN length('[INST] ') + length(' [/INST]')
    WHEN role = 'assistant' THEN length('</s>')
    ELSE length('<<SYS>>') + length(safe_role) + 1 + length('<</SYS>>') END AS chars
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  (length('<s>') + sum(chars))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""")
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-7, 0, "user", says), (-7, 1, "assistant", says)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat.conversation_digests(chat.format_conversations(rows.unionByName(probe)))


@_query()
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), added=True)


@_query()
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.repeated_passages(table(spark, folder, "documents")).drop("text_hash")


@_query()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


@_query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@_query()
def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(table(spark, folder, "embeddings"))


@_query()
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, folder, "documents"))


@_query()
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@_query("""
WITH valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), n AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(e, lambda c: floor(256 * c)) AS x FROM valid
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_dot_product(a.x, b.x)::BIGINT AS score
  FROM n a JOIN n b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved))


@_query()
def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents"), digests=True)

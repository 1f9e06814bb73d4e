"""Stand-ins for posts, labels, scores and final rows, derived from the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost.functions.columns import resolve_sentiment
from tidepost.functions.scores import best_label, confidence, entropy, softmax
from tidepost.operators.lookup import attach_predictions
from tidepost.plans.merge import fill_irony
from tidepost.sources.files import read_stage

LABELS = ["negative", "neutral", "positive"]
PROBS = ["p_negative", "p_neutral", "p_positive"]
KEYWORDS = ["the", "license", "email"]
LOOKUP = {
    "the": "this",
    "this": "that",
    "and": "",
    "of": "of the",
    "les": "des",
    "der": "die",
    "to": "too",
    "license": "licence",
    "email": "e mail",
    "un": "une",
}
STOPWORDS = ["that", "with", "from", "this", "have", "license"]
CATEGORIES = {
    "legal": ["license", "copyright", "permission"],
    "contact": ["e?mail", "phone", "@"],
    "common": [r"\bthe\b", "une", "der"],
}
FLIPS, FLIP_TO = ["positive", "neutral"], "negative"


class Views:
    """The given tables below ``folder`` and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A given table. The text tables may be one file with one row group, which one task reads;
        those are dealt to all cores. Files for half of the cores are read as they are, as dealing would
        shuffle all texts."""
        df = read_stage(self.spark, f"{self.folder}/{name}.parquet")
        cores = self.spark.sparkContext.defaultParallelism
        if name in ("documents", "pages") and 2 * len(df.inputFiles()) < cores:
            if df.rdd.getNumPartitions() <= cores:
                df = df.repartition(cores)
        return df

    def posts_of(self, documents: DataFrame, events: DataFrame, *more: str) -> DataFrame:
        """Posts of given documents and events, with further columns that these have."""
        return documents.join(events, F.col("event_id") == F.col("doc_id") * 5).select(
            F.col("doc_id").alias("id"),
            F.concat(
                F.lit("https://x.com/u"), "user_id", F.lit("/status/"), "event_id"
            ).alias("url"),
            "text",
            "lang",
            F.col("source").alias("source_file"),
            F.col("ts").alias("created_at"),
            "event_type",
            F.when(F.col("event_type") == "click", "true")
            .when(F.col("event_type") == "view", "")
            .otherwise("false")
            .alias("is_reply_raw"),
            F.floor("value").alias("view_count"),
            (F.col("doc_id") % 7).alias("like_count"),
            (F.col("doc_id") % 3).alias("repost_count"),
            (F.col("doc_id") % 5).alias("reply_count"),
            *more,
        )

    @cached_property
    def posts(self) -> DataFrame:
        """A post per document, with the author, time and counts of an event."""
        return self.posts_of(self.table("documents"), self.table("events"))

    @cached_property
    def posts_raw(self) -> DataFrame:
        """Two scrapes: all posts, and those of viewed events again with more views."""
        again = self.posts.filter("event_type = 'view'").withColumn(
            "view_count", F.col("view_count") + 100
        )
        return self.posts.withColumn("src", F.lit("a.csv")).unionByName(
            again.withColumn("src", F.lit("b.csv"))
        )

    @cached_property
    def labelled_raw(self) -> DataFrame:
        """Labelled posts with loosely written labels, some of them unknown.

        Documents meet their labels first, so that no other text is shuffled to the events.
        """
        labels = self.table("labels").select("doc_id", "toxic", "quality")
        labelled = self.table("documents").join(labels, "doc_id")
        rows = self.posts_of(labelled, self.table("events"), "toxic", "quality")
        label = (
            F.when(F.col("toxic") == 1, " Negative")
            .when(F.col("quality") == 0, "neutral ")
            .when(F.col("event_type") == "signup", "unknown")
            .otherwise("POSITIVE")
        )
        return rows.select("id", "url", "text", "lang", label.alias("sentiment"))

    @cached_property
    def scored(self) -> DataFrame:
        """Class probabilities: softmax of three embedding components."""
        logits = [F.col("embedding")[i].cast("double") * 10 for i in range(3)]
        return self.table("embeddings").select(
            "vec_id", *[p.alias(n) for p, n in zip(softmax(logits), PROBS, strict=True)]
        )

    @cached_property
    def irony(self) -> DataFrame:
        """Two-class predictions from the fourth component."""
        p = 1 / (1 + F.exp(F.col("embedding")[3].cast("double") * -10))
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"),
            F.when(p > 0.5, 1).otherwise(0).alias("sarcasm_label"),
            F.greatest(p, 1 - p).alias("sarcasm_confidence"),
        )

    @cached_property
    def scored_posts(self) -> DataFrame:
        """Posts with the probabilities of one of the embeddings.

        A post's id is a fifth of its event's, so events get the probabilities before they meet the
        texts, which are shuffled no further time.
        """
        vectors = self.table("embeddings").agg(F.count(F.lit(1))).scalar()
        events = self.table("events").filter("event_id % 5 = 0")
        keyed = events.withColumn("vec_id", F.expr("event_id div 5") % vectors)
        return self.posts_of(self.table("documents"), keyed.join(self.scored, "vec_id"), *PROBS)

    @cached_property
    def al_set(self) -> DataFrame:
        """Posts with predicted sentiment, confidence, entropy and provenance."""
        labels = self.table("labels").select(F.col("doc_id").alias("id"), F.lit(1).alias("known"))
        return (
            self.scored_posts.join(labels, "id", "left")
            .withColumns(
                {
                    "sentiment": best_label(PROBS, LABELS),
                    "model_confidence": confidence(PROBS),
                    "uncertainty_entropy": entropy(PROBS),
                    "label_source": F.when(F.col("known") == 1, "manual").otherwise("model"),
                    "review_required": F.col("known").isNull(),
                }
            )
            .drop("known", *PROBS)
        )

    @cached_property
    def final(self) -> DataFrame:
        """The same after irony resolution."""
        merged = attach_predictions(
            self.al_set, self.irony, "id", ["sarcasm_confidence", "sarcasm_label"]
        )
        matched = F.col("sarcasm_label").isNotNull()
        return fill_irony(merged.withColumn("irony_matched", matched)).withColumn(
            "final_sentiment",
            resolve_sentiment("sentiment", "sarcasm_label", FLIPS, FLIP_TO),
        )

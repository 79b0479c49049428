"""Topics of cleaned review texts by latent Dirichlet allocation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import LDAModel, LocalLDAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import filters, topics, vectors
from reviewlake.operators.once import compute_once
from reviewlake.session import cut_lineage, stored

# The vocabulary of the topics and the shortest review.
NGRAM = (1, 2)
MAX_FEATURES = 1500
MIN_DF = 15
MAX_DF = 0.6
MIN_LENGTH = 20


@dataclass
class ReviewTopics:
    model: LDAModel
    terms: list[str]
    stop_words: list[str]

    def count(self, df: DataFrame, text: str) -> DataFrame:
        """Reviews with clean_text and their term counts."""
        rows = clean_words(df, text, self.stop_words)
        return vectors.count_vectors(rows, "words", self.terms, NGRAM).drop("words")

    def place(self, df: DataFrame, text: str, weights: str | None = None) -> DataFrame:
        """Reviews with their topic and its confidence, and the weights of all topics if a column is named for them."""
        return topics.lda_topics(self.count(df, text), self.model, weights).drop("counts")

    def top_words(self, n: int = 10) -> DataFrame:
        return topics.lda_top_words(self.model, self.terms, n)

    def perplexity(self, df: DataFrame, text: str) -> float:
        return topics.lda_perplexity(self.model, self.count(df, text))


def clean_words(df: DataFrame, text: str, stop_words: Sequence[str]) -> DataFrame:
    """Reviews of at least 20 characters with ``clean_text`` and its words."""
    rows = filters.at_least_chars(df, text, MIN_LENGTH)
    rows = compute_once(rows, {"clean_text": tx.drop_domain_terms(F.col(text))})
    kept = tx.remove_stop_words(tx.split_words(F.col("clean_text")), stop_words)
    return rows.withColumn("words", kept)


def fit(
    df: DataFrame,
    text: str,
    k: int = 3,
    stop_words: Sequence[str] = (),
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    seed: int = 42,
) -> ReviewTopics:
    """Topics of the reviews; ``place`` gives every review its topic."""
    rows = stored(clean_words(df, text, stop_words).select("words"))
    vocab = vectors.vocabulary(rows, "words", NGRAM, MAX_FEATURES, min_df, max_df)
    terms = vectors.vocabulary_terms(vocab, MAX_FEATURES)
    counted = cut_lineage(vectors.count_vectors(rows, "words", terms, NGRAM).select("counts"))
    return ReviewTopics(topics.lda(counted, "counts", k, seed), terms, list(stop_words))


def save(spark: SparkSession, model: ReviewTopics, path: str) -> None:
    """The model with its vocabulary and stop words."""
    model.model.write().overwrite().save(f"{path}/lda")
    rows = [(i, term, False) for i, term in enumerate(model.terms)]
    rows += [(i, word, True) for i, word in enumerate(model.stop_words)]
    table = spark.createDataFrame(rows, "position long, word string, stop boolean")
    table.write.mode("overwrite").parquet(f"{path}/words")


def load(spark: SparkSession, path: str) -> ReviewTopics:
    rows = spark.read.parquet(f"{path}/words").orderBy("position").collect()
    return ReviewTopics(
        LocalLDAModel.load(f"{path}/lda"),
        [row["word"] for row in rows if not row["stop"]],
        [row["word"] for row in rows if row["stop"]],
    )

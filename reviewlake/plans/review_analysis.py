"""Product reviews end to end: sentiment, product clusters, cluster articles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import clusters, evaluate, filters, sampling, sentiment, stats, vectors
from reviewlake.plans import summaries
from reviewlake.sinks.files import write_splits

SPLIT = {"train": 0.8, "test": 0.2}


@dataclass
class SentimentRun:
    model: PipelineModel
    scored: DataFrame
    metrics: DataFrame


def run_sentiment(df: DataFrame, text: str, label: str, key: str, path: str) -> SentimentRun:
    """Split 80/20 into tables under ``path``, train on the first, score and evaluate the second.

    Training reads its rows several times, so the split is written once and not worked out again.
    """
    write_splits(sampling.split(df, label, key, SPLIT), path)
    parts = df.sparkSession.read.parquet(path)
    model = sentiment.train(parts.filter(F.col("split") == "train"), text, label)
    scored = sentiment.predict(parts.filter(F.col("split") == "test"), model)
    metrics = evaluate.report(evaluate.confusion(scored, label, "prediction"))
    return SentimentRun(model, scored, metrics)


def cluster_products(
    df: DataFrame,
    category: str,
    product: str,
    k: int = 5,
    max_features: int = 1000,
    stop_words: tuple[str, ...] = (),
    output: str = "meta_category",
) -> DataFrame:
    """Rows with the k-means cluster of their 'category product' description.

    Equal descriptions have equal vectors, so vectors are made once per distinct description and
    weighted with its rows; document frequencies count rows.
    """
    described = df.withColumn("_description", filters.description(F.col(category), F.col(product)))
    present = described.filter(F.col("_description").isNotNull())
    words = tx.remove_stop_words(tx.tokens(F.col("_description")), stop_words)
    vocab = vectors.vocabulary(
        present.select(words.alias("_words")), "_words", max_features=max_features
    )
    distinct = present.groupBy("_description").agg(
        F.count(F.lit(1)).cast("double").alias("_rows")
    ).withColumn("_words", words)
    featured = vectors.tfidf_vectors(
        distinct, "_words", vectors.vocabulary_rows(vocab, max_features), present.count()
    )
    model = clusters.kmeans(featured, "features", k, weight="_rows")
    placed = clusters.assign(featured, model, "features", output).select("_description", output)
    return described.join(placed, "_description", "left").drop("_description")


def cluster_articles(
    df: DataFrame, cluster: str, product: str, label: str, text: str, rating: str, key: str
) -> DataFrame:
    """(cluster, body, summary) per cluster."""
    inputs = summaries.category_inputs(df, cluster, product, label, text, rating, key)
    name = F.concat(F.lit("Category_"), F.col(cluster).cast("string"))
    bodies = summaries.article_body(inputs, cluster, product, name)
    return bodies.join(summaries.template_summary(inputs, cluster, product, name), cluster)


def profile_clusters(df: DataFrame, cluster: str, category: str, product: str) -> DataFrame:
    return stats.cluster_profile(df, cluster, category, product)

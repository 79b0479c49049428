"""Topic model flow: vectors to components, density clusters, keywords, names; and new rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import PCAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import clusters, density, filters, hierarchy, topics
from reviewlake.operators.joins import with_topic_names
from reviewlake.operators.once import compute_once
from reviewlake.session import cut_lineage


def load_reviews(df: DataFrame, text: str, min_words: int = 5) -> DataFrame:
    """Reviews with a text, their ``cleaned_text``, and at least ``min_words`` words left in it."""
    rows = filters.drop_null(df, text)
    rows = compute_once(rows, {"cleaned_text": tx.drop_metadata(F.col(text))})
    return filters.at_least_words(rows, "cleaned_text", min_words)


@dataclass
class TopicModel:
    projection: clusters.Projection
    centres: DataFrame
    names: DataFrame
    radius: float | None

    def predict(self, df: DataFrame, vector: str) -> DataFrame:
        """Adds topic and topic_name by the nearest topic centre."""
        moved = self.projection.transform(df, vector, "_components")
        placed = clusters.nearest(moved, "_components", self.centres, self.radius, "topic")
        return with_topic_names(placed, self.names).drop("_components")


def fit(
    df: DataFrame,
    key: str,
    vector: str,
    words: str,
    components: int = 50,
    reach: float | None = None,
    min_samples: int = 35,
    min_cluster_size: int = 400,
    nr_topics: int | None = None,
    radius: float | None = None,
) -> tuple[TopicModel, DataFrame]:
    """The fitted model and the rows with topic and topic_name.

    Vectors are projected to ``components`` dimensions; density is measured over all of them. Topics are the most stable
    clusters of the density hierarchy; with ``reach``, those at this one radius instead.
    """
    projection = clusters.pca(df, vector, components)
    projected = cut_lineage(projection.transform(df, vector, "_components"))
    if reach is None:
        placed = hierarchy.hierarchical_clusters(
            projected, key, "_components", min_cluster_size, min_samples, "topic"
        )
    else:
        placed = density.density_clusters(
            projected, key, "_components", reach, min_samples, min_cluster_size, "topic"
        )
    placed = cut_lineage(placed)
    if nr_topics is not None:
        counts = topics.term_counts(placed.filter(F.col("topic") != -1), "topic", words)
        placed = cut_lineage(topics.reduce_topics(placed, "topic", counts, nr_topics))
    weights = topics.ctfidf(topics.term_counts(placed, "topic", words))
    names = cut_lineage(topics.names(topics.keywords(weights)))
    centres = cut_lineage(topics.centres(placed, "topic", "_components"))
    named = with_topic_names(placed, names).drop("_components")
    return TopicModel(projection, centres, names, radius), named


def save(model: TopicModel, path: str) -> None:
    model.projection.model.write().overwrite().save(f"{path}/pca")
    spark = model.names.sparkSession
    spark.createDataFrame(
        [(model.projection.mean, model.radius)], "mean array<double>, radius double"
    ).write.mode("overwrite").parquet(f"{path}/settings")
    model.centres.write.mode("overwrite").parquet(f"{path}/centres")
    model.names.write.mode("overwrite").parquet(f"{path}/names")


def load(spark: SparkSession, path: str) -> TopicModel:
    settings = spark.read.parquet(f"{path}/settings").first()
    projection = clusters.Projection(PCAModel.load(f"{path}/pca"), list(settings["mean"]))
    return TopicModel(
        projection,
        spark.read.parquet(f"{path}/centres"),
        spark.read.parquet(f"{path}/names"),
        settings["radius"],
    )

"""Sentiment models: training on split tables, batch scoring, reload check."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions.text import SPACE


def class_weight(df: DataFrame, label: str) -> Column:
    """n / (2 * n_class) for a 0/1 label: both classes weigh the same in training."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positive")
    ).first()
    rows, positive = counts["rows"], counts["positive"]
    if positive in (0, rows):
        raise ValueError("training needs rows of both classes")
    return F.when(F.col(label) == 1, rows / (2 * positive)).otherwise(rows / (2 * (rows - positive)))


# Numbers that words are hashed to: what a model, and the driver while it trains, hold for any number of words.
WIDTH = 1 << 18


def train(
    df: DataFrame,
    text: str,
    label: str,
    max_features: int | None = None,
    min_df: float = 1.0,
    max_iter: int = 50,
    regularisation: float = 0.01,
    stop_words: Sequence[str] = (),
    balanced: bool = True,
    width: int = WIDTH,
) -> PipelineModel:
    """TF-IDF and logistic regression on a 0/1 label.

    Words are hashed to ``width`` features, so no vocabulary is built and the driver holds a coefficient per feature, however
    many words there are; words that share a number share a coefficient. With ``max_features`` the most frequent words are
    the features, as a list of that length. ``min_df`` is the number of rows a feature is in at least, or below 1 their share.
    """
    rows = df.filter(F.col(text).isNotNull() & F.col(label).isNotNull())
    rows = rows.select(F.col(text), F.col(label).cast("double").alias(label))
    if balanced:
        rows = rows.withColumn("_class_weight", class_weight(rows, label))
    tokenizer = RegexTokenizer(
        inputCol=text, outputCol="_tokens", pattern=f"{SPACE}+", gaps=True, toLowercase=True
    )
    remover = StopWordsRemover(inputCol="_tokens", outputCol="_words", stopWords=list(stop_words))
    words = remover.transform(tokenizer.transform(rows))
    if max_features is None:
        counter = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=width)
        least = min_df if min_df >= 1 else min_df * rows.count()
    else:
        counter = CountVectorizer(inputCol="_words", outputCol="_counts", vocabSize=max_features, minDF=min_df).fit(words)
        least = 0
    # The later stages read the count vectors many times; the texts are not needed any more.
    counted = counter.transform(words).drop(text, "_tokens", "_words")
    counted = counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf = IDF(inputCol="_counts", outputCol="_features", minDocFreq=math.ceil(least)).fit(counted)
        regression = LogisticRegression(
            featuresCol="_features",
            labelCol=label,
            maxIter=max_iter,
            regParam=regularisation,
            probabilityCol="_probability",
            rawPredictionCol="_raw",
            predictionCol="_prediction",
        )
        if balanced:
            regression = regression.setWeightCol("_class_weight")
        classifier = regression.fit(idf.transform(counted))
    finally:
        counted.unpersist()
    return PipelineModel(stages=[tokenizer, remover, counter, idf, classifier])


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``prediction`` (0/1) and ``probability`` of the positive class."""
    scored = model.transform(df)
    return scored.withColumns(
        {
            "prediction": F.col("_prediction").cast("int"),
            "probability": vector_to_array("_probability")[1],
        }
    ).select(*df.columns, "prediction", "probability")


def score_with(
    df: DataFrame,
    columns: Sequence[str],
    score: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """Rows scored by a caller's model over Arrow batches: ``score`` maps a batch to its output rows."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield score(frame)

    return df.select(*columns).mapInPandas(batches, schema)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def reload_mismatches(df: DataFrame, key: str, first: PipelineModel, second: PipelineModel) -> DataFrame:
    """One row: rows scored by both models and rows whose predictions differ."""
    left = predict(df, first).select(key, F.col("prediction").alias("_a"))
    right = predict(df, second).select(key, F.col("prediction").alias("_b"))
    return left.join(right, key).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_a") != F.col("_b")).alias("mismatches")
    )

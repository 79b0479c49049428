"""Row filters and label columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import text as tx

# Spellings of the two labels. The comparison is case-sensitive.
POSITIVE_LABELS = ("positive", "pos", "good", "1")
NEGATIVE_LABELS = ("negative", "neg", "bad", "0")


def drop_blank(df: DataFrame, text: str) -> DataFrame:
    return df.filter(~tx.is_blank(F.col(text)))


def at_least_chars(df: DataFrame, text: str, n: int = 10) -> DataFrame:
    return df.filter(F.length(text) >= n)


def at_least_words(df: DataFrame, text: str, n: int = 5) -> DataFrame:
    return df.filter(tx.word_count(F.col(text)) >= n)


def longer_than(df: DataFrame, text: str, n: int) -> DataFrame:
    return df.filter(F.length(text) > n)


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null."""
    return df.dropna(subset=list(columns) if columns else None)


def topic_rows(df: DataFrame, topic: int, column: str = "topic") -> DataFrame:
    """Rows of one topic; -1 selects the outliers."""
    return df.filter(F.col(column) == topic)


def score_rows(df: DataFrame, id_column: str, scores: Sequence[str], threshold: float = 0.4) -> DataFrame:
    """(id, label, score) for every score that reaches the threshold."""
    long = df.select(id_column, *scores).unpivot([id_column], list(scores), "label", "score")
    return long.filter(F.col("score") >= threshold)


def normal_label(label: Column) -> Column:
    """1, 0 or null from the usual spellings of a binary label."""
    text = label.cast("string")
    return F.when(text.isin(*POSITIVE_LABELS), 1).when(text.isin(*NEGATIVE_LABELS), 0).cast("int")


def is_positive(label: Column) -> Column:
    """1 where the label reads 'positive', else 0."""
    return F.coalesce((label == "positive").cast("int"), F.lit(0))


def label_name(label: Column) -> Column:
    return F.when(label == 1, "Positive").when(label == 0, "Negative")


def description(category: Column, name: Column) -> Column:
    """Category and name as one text; null if either is null."""
    return F.concat(category, F.lit(" "), name)


def is_outlier(topic_name: Column) -> Column:
    return F.coalesce(topic_name == "Outlier", F.lit(False))


def model_prediction(label: Column) -> Column:
    """0/1 from the label text of a sentiment model."""
    upper = F.upper(label)
    positive = upper.contains("POSITIVE") | upper.isin("LABEL_1", "1")
    return F.coalesce(positive, F.lit(False)).cast("int")


def positive_probability(label: Column, score: Column) -> Column:
    """Probability of the positive class from the probability of the predicted one."""
    return F.when(model_prediction(label) == 1, score).otherwise(1 - score)

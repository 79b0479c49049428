"""Joins of the review model and the size check that allows a broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows a side may have to be broadcast: narrow rows, so tens of megabytes at most.
MAX_BROADCAST_ROWS = 100_000
SALTS = 16


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Counts at most ``max_rows + 1`` rows to find out."""
    return df.limit(max_rows + 1).count() <= max_rows


def few_values(df: DataFrame, columns: Sequence[str], max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a table with one row per distinct value of ``columns`` may be broadcast."""
    return is_small(df.select(*columns).distinct(), max_rows)


def with_games(reviews: DataFrame, games: DataFrame, rating: str | None = None) -> DataFrame:
    """Reviews with their game; optionally only of games with a rating description."""
    joined = reviews.join(games, "appid")
    return joined if rating is None else joined.filter(F.col("review_score_desc") == rating)


def with_topics(reviews: DataFrame, topics: DataFrame, key: str = "recommendationid") -> DataFrame:
    """Reviews that have a topic, with it."""
    return reviews.join(topics, key)


def beside(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of ``right`` beside the rows of ``left``; every left row stays."""
    return left.join(right, key, "left")


def with_topic_names(df: DataFrame, names: DataFrame, topic: str = "topic") -> DataFrame:
    """Adds ``topic_name``; topic -1 is 'Outlier'. ``names`` has (topic, topic_name).

    A topic may be that of a third of all rows, so names are handed out under every salt; how they are joined is Spark's choice.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    named = salted.join(names.withColumn("_salt", salts), [topic, "_salt"], "left").drop("_salt")
    return named.withColumn(
        "topic_name", F.when(F.col(topic) == -1, "Outlier").otherwise(F.col("topic_name"))
    )


def in_top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose value is among the ``n`` most frequent (ties by value)."""
    top = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .orderBy(F.desc("count"), column)
        .limit(n)
        .select(column)
    )
    # At most n rows by the limit above.
    return df.join(F.broadcast(top), column, "left_semi")


def not_in(df: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``done``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(done.select(*keys), keys, "left_anti")

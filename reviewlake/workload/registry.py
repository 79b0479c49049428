"""Names, queries and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.session import checkpoint_dir
from reviewlake.sources.tables import scan_spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, spread over the cores for heavy work on each text."""
    return scan_spread(spark, f"{sf}/documents.parquet", "doc_id")


def scratch(spark: SparkSession) -> str:
    """A new folder next to the checkpoints, which all executors can reach."""
    return f"{checkpoint_dir(spark).rstrip('/')}/reviewlake-{uuid.uuid4().hex}"


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a label, in the role of reviews."""
    return documents(spark, sf).join(table(spark, sf, "labels"), "doc_id")


REVIEWS_SQL = "(SELECT * FROM documents JOIN labels USING (doc_id))"


def games(spark: SparkSession, sf: str) -> DataFrame:
    """One row per source in the role of games, with a rating description made from its labels."""
    share = F.col("positive") / F.col("total")
    return (
        reviews(spark, sf)
        .groupBy(F.col("source").alias("appid"))
        .agg(F.count(F.lit(1)).alias("total"), F.sum("quality").alias("positive"))
        .withColumn(
            "review_score_desc",
            F.when(share >= 0.9, "Very Positive").when(share >= 0.8, "Positive").otherwise("Mixed"),
        )
    )


GAMES_SQL = f"""(
  SELECT source AS appid, count(*) AS total, CAST(sum(quality) AS BIGINT) AS positive,
    CASE WHEN sum(quality) * 1.0 / count(*) >= 0.9 THEN 'Very Positive'
         WHEN sum(quality) * 1.0 / count(*) >= 0.8 THEN 'Positive' ELSE 'Mixed' END AS review_score_desc
  FROM {REVIEWS_SQL} GROUP BY source)"""


def six(column: Column | str) -> Column:
    """Rounded to six decimals, so that sums taken in another order compare equal."""
    return F.round(column, 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: six(name) for name in columns})

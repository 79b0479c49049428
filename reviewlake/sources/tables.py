"""Table scans. Column choice and filters reach the Parquet reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators.sampling import random_rows


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_spread(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A table whose rows are about to get heavy work each.

    Kept in fewer files than the session has cores, it is spread by key over the cores; a table of many
    files is read as it lies.
    """
    rows = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if len(rows.inputFiles()) < cores else rows


def scan_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def scan_not_null(
    spark: SparkSession, path: str, column: str, limit: int | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Rows with a value in ``column``; with ``limit`` the first ones along ``order``."""
    rows = spark.read.parquet(path).filter(F.col(column).isNotNull())
    if limit is None:
        return rows
    return (rows.orderBy(*order) if order else rows).limit(limit)


def scan_sample(
    spark: SparkSession, path: str, columns: Sequence[str], n: int, key: str, seed: int = 42
) -> DataFrame:
    """``n`` random rows in which all ``columns`` have a value."""
    rows = spark.read.parquet(path).select(key, *[c for c in columns if c != key])
    return random_rows(rows, n, key, columns, seed)


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A SQL text over named DataFrames: ``query(spark, "SELECT * FROM {reviews}", reviews=df)``."""
    return spark.sql(sql, **tables)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lowest: int,
    highest: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table read in parallel over ranges of a numeric key (the driver jar is the caller's)."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=lowest, upperBound=highest,
        numPartitions=partitions, properties=properties or {},
    )

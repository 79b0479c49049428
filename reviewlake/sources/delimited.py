"""Delimited text files whose fields may hold line breaks and quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, separator: str = ";"
) -> DataFrame:
    """A file with a header line and double-quoted fields, read with the schema given."""
    return (
        spark.read.schema(schema)
        .option("sep", separator)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )

"""The corpus pipeline: from raw documents to packed training sequences.

Every stage works on all rows the one before it kept, as they were written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewlake.llm import bwt_dedup, packing, secrets, simhash, toxicity
from reviewlake.llm.common import written

#: Bytes of texts that Spark sends to a Python worker at a time, unless the session names another number. Workers and
#: executors hold several such batches at once, and Spark's own 64 MB each are a large part of a small executor.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def _small_batches(spark: SparkSession) -> None:
    key, value = ARROW_BYTES
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those the toxicity classifiers reject."""
    _small_batches(spark)
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    _small_batches(spark)
    return simhash.keep_first(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that earlier documents have."""
    _small_batches(spark)
    return bwt_dedup.without_repeats(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    _small_batches(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences of 2048 tokens."""
    _small_batches(spark)
    return packing.placements(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("secrets", redact_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the last stage returns for ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs)
    return docs

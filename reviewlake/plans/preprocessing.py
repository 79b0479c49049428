"""Clean, balance, split and report: the preparation of labelled reviews."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import filters, profile, sampling
from reviewlake.sinks.files import write_splits


def clean(
    df: DataFrame,
    text: str,
    label: str,
    min_length: int = 10,
    brackets: bool = True,
    output: str = "review_text_clean",
) -> DataFrame:
    """Distinct, non-blank, long enough, labelled rows with a 0/1 label and the cleaned text."""
    rows = filters.drop_blank(df.dropDuplicates(), text)
    rows = filters.drop_null(filters.at_least_chars(rows, text, min_length), label)
    rows = rows.withColumn(label, filters.normal_label(F.col(label)))
    sized = profile.with_text_sizes(rows, text)
    return sized.withColumn(output, tx.clean_text(F.col(text), brackets))


def balance(df: DataFrame, label: str, key: str, method: str = "undersample", seed: int = 42) -> DataFrame:
    """Equal classes: 'undersample' or 'oversample'; any other method leaves the rows as they are."""
    if method == "undersample":
        return sampling.undersample(df, label, key, seed)
    if method == "oversample":
        return sampling.repeat_rows(sampling.oversample(df, label, key, seed), key)
    return df


@dataclass
class Prepared:
    original: DataFrame
    cleaned: DataFrame
    balanced: DataFrame
    split: DataFrame

    def report(self) -> DataFrame:
        """Row counts: cleaning as a share of the original, splits as a share of the balanced rows."""
        parts = {name: self.split.filter(F.col("split") == name) for name in ("train", "validation", "test")}
        return profile.stage_report(
            {
                "original": self.original,
                "cleaned": self.cleaned,
                "balanced": self.balanced,
                **parts,
            },
            of=dict.fromkeys(parts, "balanced"),
        )


def prepare(
    df: DataFrame, text: str, label: str, key: str, method: str = "undersample", seed: int = 42
) -> Prepared:
    """The whole preparation as one lazy plan. Write the cleaned rows first when they are reused a lot."""
    cleaned = clean(df, text, label)
    balanced = balance(cleaned, label, key, method, seed)
    return Prepared(df, cleaned, balanced, sampling.split(balanced, label, key, seed=seed))


def run(
    df: DataFrame, text: str, label: str, key: str, path: str, method: str = "undersample"
) -> DataFrame:
    """Prepare, write each stage once, and return the report over the written tables."""
    spark = df.sparkSession
    clean(df, text, label).write.mode("overwrite").parquet(f"{path}/cleaned")
    cleaned = spark.read.parquet(f"{path}/cleaned")
    balance(cleaned, label, key, method).write.mode("overwrite").parquet(f"{path}/balanced")
    balanced = spark.read.parquet(f"{path}/balanced")
    write_splits(sampling.split(balanced, label, key), f"{path}/splits")
    return Prepared(df, cleaned, balanced, spark.read.parquet(f"{path}/splits")).report()

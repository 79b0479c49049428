"""File sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import ArrowInvalid, ArrowNotImplementedError
from pyarrow import fs as storage
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str, separator: str = ",", mode: str = "overwrite") -> None:
    """CSV part files with a header, quotes doubled inside quoted fields."""
    (
        df.write.mode(mode)
        .option("sep", separator)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        # Keep the ends of a text as they are.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """Replace the split tables: one Parquet data set with a folder per split."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_batched(df: DataFrame, path: str, batch_size: int = 5000, mode: str = "append") -> None:
    """Parquet files of at most ``batch_size`` rows."""
    df.write.mode(mode).option("maxRecordsPerFile", batch_size).parquet(path)


def write_texts(df: DataFrame, path: str, product: str, text: str, title: str | None = None) -> None:
    """One text file per product, in a folder ``<product>=<value>``.

    The products are hashed over the tasks, so a product is written by one task into one file.
    """
    body = F.col(text)
    if title is not None:
        body = F.concat(F.lit("SUMMARY FOR GAME "), F.col(title), F.lit("\n\n"), body)
    (
        df.select(F.col(product), body.alias("value"))
        .repartition(product)
        .write.mode("overwrite")
        .partitionBy(product)
        .text(path)
    )


def write_named(df: DataFrame, path: str, group: str, number: str, text: str) -> None:
    """One text file per row, ``<path>/<group>=<value>/<number>.json``, in a store that all executors share.

    A folder per file, as Spark's own writer needs it, costs more to make and to list than the file. Where tasks cannot
    write to the store themselves, that writer is used, with folders ``<number>=<value>``. A task that runs again writes the
    same files again, and a file has its name when it is whole.
    """
    names = [F.coalesce(F.col(name).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias(name) for name in (group, number)]
    spread = df.select(*names, F.coalesce(text, F.lit("")).alias("value")).repartition(group, number)
    try:
        storage.FileSystem.from_uri(path)
    except (ArrowInvalid, ArrowNotImplementedError, OSError):
        spread.write.partitionBy(group, number).text(path)
        return

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = storage.FileSystem.from_uri(path)
        attempt, made, count = TaskContext.get().taskAttemptId(), set(), 0
        for frame in frames:
            for folder, name, value in frame.itertuples(index=False, name=None):
                place = f"{root}/{group}={folder}"
                if place not in made:
                    store.create_dir(place, recursive=True)
                    made.add(place)
                with store.open_output_stream(f"{place}/_{name}.{attempt}") as out:
                    out.write(f"{value}\n".encode())
                store.move(f"{place}/_{name}.{attempt}", f"{place}/{name}.json")
                count += 1
        yield pd.DataFrame({"files": [count]})

    spread.mapInPandas(written, "files long").agg(F.sum("files")).collect()


def export_rows(summaries: DataFrame, statistics: DataFrame, config: dict[str, object]) -> DataFrame:
    """(value): JSON lines of kind 'summary' per product, then one 'metadata' and one 'config' line."""
    lines = summaries.select(
        F.to_json(
            F.struct(F.lit("summary").alias("kind"), *[F.col(name) for name in summaries.columns])
        ).alias("value")
    )
    metadata = statistics.select(
        F.to_json(
            F.struct(F.lit("metadata").alias("kind"), *[F.col(name) for name in statistics.columns])
        ).alias("value")
    )
    settings = statistics.sparkSession.range(1).select(
        F.to_json(
            F.struct(
                F.lit("config").alias("kind"), *[F.lit(v).alias(k) for k, v in config.items()]
            )
        ).alias("value")
    )
    return lines.unionByName(metadata).unionByName(settings)


def export_json(summaries: DataFrame, statistics: DataFrame, config: dict[str, object], path: str) -> None:
    export_rows(summaries, statistics, config).write.mode("overwrite").text(path)

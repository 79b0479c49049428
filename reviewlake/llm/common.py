"""Helpers of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the checkpoint folder, which all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` as Parquet in the shared folder, read again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: str = "text") -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def identifier(column: str = "doc_id") -> Column:
    return F.col(column).cast("long")


def bucketed(df: DataFrame, key: str, parts: int, name: str = "bucketed") -> DataFrame:
    """``df`` in the shared folder in ``parts`` buckets by ``key``, read again: what is joined to it by that key comes to it.

    The table is dropped from the catalog once it is read; its files stay, as those of ``written`` do.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(parts, key).write.option("path", scratch(spark, name)).option("compression", "zstd")
    writer.bucketBy(parts, key).saveAsTable(table, format="parquet")
    found = spark.table(table).select("*")
    found.schema  # resolves the table before its name goes
    spark.sql(f"DROP TABLE {table}")
    return found


def salted_join(left: DataFrame, right: DataFrame, on: list[str], spread: str, salts: int = 16, how: str = "inner") -> DataFrame:
    """``left`` joined to the few columns of ``right``, whose rows are unique by ``on``; a key of many left rows is salted.

    ``spread`` is a column of ``left`` that differs among rows of one key.
    """
    salt = "_join_salt"
    dealt = left.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*on, salt], how).drop(salt)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``df`` has."""
    taken, out = {name.lower() for name in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def range_cuts(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` values that split the rows into ranges of about equal counts."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(column, shares, max(10_000, 20 * parts)).alias("cuts")).first()
    return sorted(set(found["cuts"] or []))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_size(batches: Iterable[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a column of strings or bytes holds about ``limit`` bytes at most, one row at least."""
    for batch in batches:
        start, held = 0, 0
        for i, value in enumerate(batch.column(column)):
            size = value.as_buffer().size if value.is_valid else 0
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Gives a task's freed memory back to the system; workers outlive tasks and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class TwoGenerations(dict):
    """A cache of at most ``2 * size`` entries; those not asked for while ``size`` new ones came are forgotten.

    A missing key is looked up in the older entries, then made by ``make``.
    """

    def __init__(self, make: Callable[[Any], Any], size: int) -> None:
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key: Any) -> Any:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.older = {}


def document_shards(docs: DataFrame, size: int, carried: Column | None = None) -> DataFrame:
    """(shard, ids, lengths, data, carried): the documents in shards of about ``size`` bytes, compressed.

    ``carried`` is a string column of ``docs`` that goes with each document, or null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        packer = zstandard.ZstdCompressor(level=3)
        ids: list[int | None] = []
        extra: list[str | None] = []
        texts: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([number], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "lengths": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                "data": pa.array([packer.compress(b"".join(texts))], pa.binary()),
                "carried": pa.array([extra], pa.list_(pa.string())),
            })

        for batch in batches:
            for doc_id, text, more in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                value = text.as_py()
                if texts and held + len(value) > size:
                    yield row()
                    number, ids, extra, texts, held = number + 1, [], [], [], 0
                ids.append(doc_id)
                extra.append(more)
                texts.append(value)
                held += len(value)
        if texts:
            yield row()

    other = F.lit(None).cast("string") if carried is None else carried
    return docs.select(identifier().alias("doc_id"), utf8().alias("text"), other.alias("carried")).mapInArrow(
        run, "shard long, ids array<long>, lengths array<long>, data binary, carried array<string>"
    )


def opened(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shard's bytes, and where its documents end."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), np.cumsum(lengths)

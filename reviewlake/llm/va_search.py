"""Exact top-k inner products with vector-approximation files.

Vectors are stored in blocks. A block's approximation file has a cell number of a few bits per component, and the
cells' edges are the block's own. The cells bound every score from both sides, so a scan of the approximations gives
each query a score that its k-th result reaches at least. Then the vectors whose upper bound reaches it are read in the
order of their bounds, until the k-th exact score is above the next bound. Equal vectors are stored once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import written
from reviewlake.session import cut_lineage

BLOCK, QUERIES, CELLS = 4096, 1024, 16
_LONG = (1 << 63) - 1


def integers(embeddings: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, vector): floor(scale x) of each component as 64-bit numbers; repeated rows once.

    Rows without vec_id, and vectors that are null or hold null or non-finite components, take no part.
    """
    x = F.col(column).cast("array<double>")
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return (
        embeddings.filter(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & fit)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector"))
        .distinct()
    )


def _blocks(rows: DataFrame, key: str, size: int, fields: list[str]) -> DataFrame:
    """Rows in blocks of about ``size``, by a hash of ``key`` and apart by dimension: (block, dim, rows)."""
    count = max(1, -(-rows.count() // size))
    block = F.pmod(F.xxhash64(key), F.lit(count)).cast("int")
    return rows.groupBy(block.alias("block"), F.size("vector").alias("dim")).agg(
        F.collect_list(F.struct(*fields, "vector")).alias("rows")
    )


def _matrix(vectors: list) -> np.ndarray:
    return np.array([list(v) for v in vectors], np.int64).reshape(len(vectors), -1)


def _product(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products, in floating point where that is exact."""
    top = int(np.abs(queries.astype(float)).max(initial=0) * np.abs(vectors.astype(float)).max(initial=0)) + 1
    if top * max(1, queries.shape[1]) < 1 << 52:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return queries.astype(object) @ vectors.astype(object).T


def build(embeddings: DataFrame, k: int, column: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(vectors, files): the integer vectors, and the written blocks (block, dim, low, width, cells, ids, exact).

    A vector comes with the k + 1 smallest of its vec_ids: a query's results can't need more.
    """
    vectors = cut_lineage(integers(embeddings, column))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = (
        vectors.withColumn("place", place)
        .filter(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    blocks = _blocks(cut_lineage(distinct), "vector", BLOCK, ["ids"])

    def approximate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, dim, rows in zip(frame["block"], frame["dim"], frame["rows"]):
                exact = _matrix([row["vector"] for row in rows])
                low = exact.min(axis=0)
                spread = exact.max(axis=0).astype(object) - low.astype(object) + 1
                width = np.array([min(_LONG, -(-int(s) // CELLS)) for s in spread], np.int64)
                cells = ((exact.astype(np.uint64) - low.astype(np.uint64)) // width.astype(np.uint64)).astype(np.uint8)
                yield pd.DataFrame(
                    {
                        "block": [block], "dim": [dim], "low": [low.tobytes()], "width": [width.tobytes()],
                        "cells": [cells.tobytes()], "ids": [[list(row["ids"]) for row in rows]], "exact": [exact.tobytes()],
                    }
                )

    schema = "block int, dim int, low binary, width binary, cells binary, ids array<array<long>>, exact binary"
    return vectors, written(blocks.mapInPandas(approximate, schema), "va-file")


def _bounds(queries: np.ndarray, low: bytes, width: bytes, cells: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of a block's ``n`` vectors, from their cells."""
    least, wide = np.frombuffer(low, np.int64), np.frombuffer(width, np.int64)
    number = np.frombuffer(cells, np.uint8).reshape(n, len(least))
    safe = int(np.abs(least.astype(float)).max(initial=0) + CELLS * wide.astype(float).max(initial=0)) < 1 << 62
    if safe:
        corner, room = least + number.astype(np.int64) * wide, wide - 1
    else:
        corner, room = least.astype(object) + number.astype(object) * wide.astype(object), wide.astype(object) - 1
        queries = queries.astype(object)
    base = _product(queries, corner)
    over = np.maximum(queries, 0) @ room if safe is False else _product(np.maximum(queries, 0), room[None, :])[:, 0]
    under = np.minimum(queries, 0) @ room if safe is False else _product(np.minimum(queries, 0), room[None, :])[:, 0]
    return base + under[:, None], base + over[:, None]


def _meet(queries: DataFrame, files: DataFrame, columns: list[str]) -> DataFrame:
    """Every block of queries with every block of vectors of its dimension."""
    blocks = files.agg(F.max("block")).first()[0]
    sent = queries.select(
        F.col("block").alias("query_block"), "dim", F.col("rows").alias("queries"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks if blocks is not None else 0))).alias("block"),
    )
    return sent.join(files.select("block", "dim", *columns), ["block", "dim"])


def top_k(embeddings: DataFrame, is_query: str, k: int = 5, column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id that ``is_query`` holds for, the k rows of the highest scores.

    Ties go to the smaller vec_id; a query's own vec_id is no result. A vec_id with several vectors is one query that each of
    them asks, and a result once for each pair of vectors; repeated rows count once. Vectors are compared with those of their own
    dimension. Scores beyond 64 bits are returned as the nearest 64-bit number. An empty table gives an empty table.
    """
    vectors, files = build(embeddings, k, column)
    queries = cut_lineage(_blocks(vectors.filter(is_query), "vec_id", QUERIES, ["vec_id"]))

    def least(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                lower, _ = _bounds(_matrix([q["vector"] for q in row.queries]), row.low, row.width, row.cells, len(row.ids))
                own: dict[int, list[int]] = {}  # a vec_id may have several vectors
                for n, ids in enumerate(row.ids):
                    for i in ids:
                        own.setdefault(i, []).append(n)
                found = []
                for q, bounds in zip(row.queries, lower):
                    if q["vec_id"] in own:
                        bounds = np.delete(bounds, own[q["vec_id"]])
                    best = np.partition(bounds, len(bounds) - k)[-k:] if len(bounds) > k else bounds
                    found += [(q["vec_id"], max(-_LONG, min(_LONG, int(b)))) for b in best]
                yield pd.DataFrame(found, columns=["vec_id", "bound"])

    lower = _meet(queries, files, ["low", "width", "cells", "ids"]).mapInPandas(least, "vec_id long, bound long")
    best = Window.partitionBy("vec_id").orderBy(F.col("bound").desc())
    reached = (
        lower.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
        .groupBy("vec_id").agg(F.when(F.count(F.lit(1)) == k, F.min("bound")).alias("reached"))
    )
    # The query's own vector may be in a block under other ids only, so equal vectors make the bound weaker, not wrong.
    wanted = vectors.filter(is_query).join(reached, "vec_id", "left")
    again = cut_lineage(_blocks(wanted, "vec_id", QUERIES, ["vec_id", "reached"]))

    def refine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                matrix = _matrix([q["vector"] for q in row.queries])
                _, upper = _bounds(matrix, row.low, row.width, row.cells, len(row.ids))
                exact = np.frombuffer(row.exact, np.int64).reshape(len(row.ids), -1)
                found = []
                for q, vector, bounds in zip(row.queries, matrix, upper):
                    start = np.arange(len(bounds)) if q["reached"] is None else np.flatnonzero(bounds >= q["reached"])
                    order = start[np.argsort(-bounds[start], kind="stable")]
                    results: list[tuple[int, int]] = []
                    for at in range(0, len(order), 32):
                        if len(results) >= k and bounds[order[at]] < -results[k - 1][0]:
                            break
                        read = order[at : at + 32]
                        for n, score in zip(read.tolist(), _product(vector[None, :], exact[read])[0].tolist()):
                            results += [(-score, i) for i in row.ids[n] if i != q["vec_id"]]
                        results = sorted(results)[:k]
                    found += [(q["vec_id"], i, max(-_LONG - 1, min(_LONG, -score))) for score, i in results]
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    scores = _meet(again, files, ["low", "width", "cells", "ids", "exact"]).mapInPandas(
        refine, "query_id long, vec_id long, score long"
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Blocks of vectors against blocks of vectors, as matrix products: nearest centres and exact silhouettes.

A block holds a few thousand distinct vectors as one value, so a pair of blocks is one row of a join and one product in a
task. The pairs of a block of rows come to one task one after another, which keeps minima or sums, never a pair of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.operators.density import SALTS, _vector_name
from reviewlake.operators.hierarchy import distances
from reviewlake.session import cut_lineage

# Vectors of a block, on average, and rows of a block that are multiplied at a time.
BLOCK_ROWS, SLICE = 4096, 512
# Rows whose distances to a block stay in a core's cache.
NEAR_ROWS = 64
# Vectors whose sums one task keeps, at most: all others are sent once to each such group.
GROUP_ROWS = 32768


def vector_blocks(rows: DataFrame, key: str, vector: str, columns: Sequence[str], size: int = BLOCK_ROWS) -> DataFrame:
    """(block, v, *columns): about ``size`` rows each, by a hash of their unique ``key``; blocks are numbered from 0."""
    count = max(1, -(-rows.count() // size))
    numbers = F.col(vector).cast("array<double>")
    entry = F.struct(F.col(key).alias("_key"), numbers.alias("_v"), *columns)
    grouped = rows.groupBy(F.pmod(F.xxhash64(key), F.lit(count)).alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("_rows")
    )
    return grouped.select(
        "block", F.flatten("_rows._v").alias("v"), *[F.col(f"_rows.{name}").alias(name) for name in columns]
    )


def _paired(left: DataFrame, right: DataFrame, count: int) -> DataFrame:
    """Every block of ``left`` (block, ...) with every block of ``right`` (other, ...), block after block."""
    sent = left.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    return sent.join(right, "other").repartition("block").sortWithinPartitions("block", "other")


def _matrix(values, rows: int) -> np.ndarray:
    return np.asarray(values, dtype=float).reshape(rows, -1)


class Distances:
    """Euclidean distances to fixed vectors: one product for a slice of rows, and differences where they are short."""

    def __init__(self, others: np.ndarray) -> None:
        self.others, self.lengths = others, (others * others).sum(1)
        self.top = self.lengths.max(initial=0.0)
        ones = np.ones((len(others), 1))
        self.side = np.concatenate([-2 * others, ones, self.lengths[:, None]], axis=1).T.copy()

    def of(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        squared = np.concatenate([rows, lengths[:, None], np.ones((len(rows), 1))], axis=1) @ self.side
        # As ``distances`` has it, but only rows that may have a short one are looked through.
        for i in np.flatnonzero(~(squared.min(1) >= 1e-4 * (lengths + self.top))).tolist():
            j = np.flatnonzero(squared[i] < 1e-4 * (lengths[i] + self.lengths))
            squared[i, j] = ((rows[i] - self.others[j]) ** 2).sum(1)
            np.maximum(squared[i], 0, out=squared[i])
        return np.sqrt(squared, out=squared)


def nearest(
    df: DataFrame, vector: str, centres: DataFrame, radius: float | None = None, output: str = "topic"
) -> DataFrame:
    """Adds the id of the nearest centre (ties to the smaller id), or -1 beyond ``radius``.

    ``centres`` is (topic, centre), one per topic and as many as you like. Equal vectors are compared once. Rows whose
    vector is null or holds null or non-finite numbers have null, or -1 where there is a ``radius``.
    """
    named = df.select(_vector_name(vector).alias("_name"), F.col(vector).alias("_v")).filter("_name IS NOT NULL")
    distinct = named.groupBy("_name").agg(F.first("_v").alias("_v"))
    left = cut_lineage(vector_blocks(distinct, "_name", "_v", ["_name"]))
    right = vector_blocks(centres, "topic", "centre", ["topic"]).withColumnsRenamed({"block": "other", "v": "centre"})
    right = cut_lineage(right)
    count = (right.agg(F.max("other")).first()[0] or 0) + 1
    kind = centres.schema["topic"].dataType
    schema = T.StructType(
        [T.StructField("_name", T.StringType()), T.StructField("_far", T.DoubleType()), T.StructField("_topic", kind)]
    )

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, names, best, topic = None, None, None, None

        def done() -> pd.DataFrame:
            return pd.DataFrame({"_name": names, "_far": best, "_topic": topic})

        for frame in frames:
            for row in frame.itertuples(index=False):
                row = row._asdict() if hasattr(row, "_asdict") else dict(zip(frame.columns, row))
                if row["block"] != block:
                    if block is not None:
                        yield done()
                    block, names = row["block"], list(row["names"])
                    best, topic = np.full(len(names), np.inf), np.full(len(names), None, object)
                ids = np.array(list(row["topic"]), object)
                order = np.argsort(ids, kind="stable")
                ids, others = ids[order], _matrix(row["centre"], len(ids))[order]
                vectors = _matrix(row["v"], len(names))
                for at in range(0, len(names), SLICE):
                    far = distances(vectors[at : at + SLICE], others)
                    least = far.argmin(1)  # the first of equals has the smaller id
                    part = slice(at, at + len(far))
                    reached, said = far[np.arange(len(far)), least], ids[least]
                    nearer = reached < best[part]
                    for i in np.flatnonzero(reached == best[part]).tolist():
                        nearer[i] = said[i] < topic[at + i]
                    best[part][nearer], topic[part][nearer] = reached[nearer], said[nearer]
        if block is not None:
            yield done()

    pairs = _paired(left.withColumnRenamed("_name", "names"), right, count)
    placed = pairs.select("block", "other", "names", "v", "topic", "centre").mapInPandas(found, schema)
    choice = F.col("_topic") if radius is None else F.when(F.col("_far") <= radius, F.col("_topic")).otherwise(-1)
    # One vector may be that of a third of all rows: its topic is handed out under every salt.
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    labels = placed.select("_name", choice.alias(output), salts.alias("_salt"))
    rows = df.withColumns({"_name": _vector_name(vector), "_salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))})
    out = rows.join(labels, ["_name", "_salt"], "left")
    if radius is not None:
        out = out.withColumn(output, F.coalesce(output, F.lit(-1)))
    return out.select(*df.columns, output)


def mean_silhouettes(df: DataFrame, vector: str, labels: Sequence[str]) -> DataFrame:
    """(labelling, silhouette): the mean Euclidean silhouette for each of the cluster columns ``labels``.

    A row's silhouette is (b - a) / max(a, b), with a its mean distance to the other rows of its cluster and b that to the
    nearest other cluster; it is 0 for a row alone in its cluster or without another cluster. Distances are taken once for
    all labellings. Rows without a usable vector or with a null label take no part in that labelling.
    """
    numbers = [F.col(name).cast("long").alias(f"_l{i}") for i, name in enumerate(labels)]
    named = df.select(_vector_name(vector).alias("_name"), F.col(vector).alias("_v"), *numbers).filter("_name IS NOT NULL")
    own = [f"_l{i}" for i in range(len(labels))]
    distinct = named.groupBy("_name", *own).agg(F.first("_v").alias("_v"), F.count(F.lit(1)).alias("_n"))
    keyed = distinct.withColumn("_key", F.to_json(F.struct("_name", *own)))
    keyed = cut_lineage(keyed)
    # Groups as large as leaves work for all cores, two for each of them.
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = max(BLOCK_ROWS, min(GROUP_ROWS, -(-keyed.count() // (2 * cores))))
    blocks = cut_lineage(vector_blocks(keyed, "_key", "_v", ["_n", *own]))
    groups = vector_blocks(keyed, "_key", "_v", ["_n", *own], size)
    count = max(1, -(-keyed.count() // size))
    other = blocks.withColumnsRenamed({"block": "other", "v": "w", "_n": "_m"} | {f"_l{i}": f"_k{i}" for i in range(len(labels))})
    sent = other.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    # A group's own rows come once, before all others.
    pairs = groups.withColumn("other", F.lit(-1).cast("long")).unionByName(sent, allowMissingColumns=True)
    # A task for each group.
    pairs = pairs.repartitionById(count, F.col("block").cast("int")).sortWithinPartitions("block", "other")

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, mine, vectors, lengths = None, None, None, None
        # A column for each label of each labelling: the sums of distances to its rows, and their number.
        place: dict[tuple[int, int], int] = {}
        sums, sizes = np.zeros((0, 0)), np.zeros(0)

        def done() -> pd.DataFrame:
            total, rows = [], []
            for i, labels_ in enumerate(mine["labels"]):
                known = np.array([x is not None and x == x for x in labels_])
                names = {name: column for (labelling, name), column in place.items() if labelling == i}
                local = {name: at for at, name in enumerate(names)}
                columns = np.array(list(names.values()), np.int64)
                table, held = sums[:, columns], sizes[columns]
                at = np.array([local[int(x)] if k else 0 for x, k in zip(labels_, known)], np.int64)
                each = np.arange(len(at))
                alone = held[at] <= 1
                inner = table[each, at] / np.maximum(held[at] - 1, 1)
                means = table / held
                means[each, at] = np.inf
                outer = means.min(1)
                top = np.maximum(inner, outer)
                score = np.where(alone | ~np.isfinite(outer) | (top == 0), 0.0, (outer - inner) / np.where(top == 0, 1, top))
                total.append(float((score * mine["n"])[known].sum()))
                rows.append(int(mine["n"][known].sum()))
            return pd.DataFrame({"labelling": np.arange(len(total)), "total": total, "rows": rows})

        for frame in frames:
            for values in frame.itertuples(index=False, name=None):
                row = dict(zip(frame.columns, values))
                if row["block"] != block:
                    if block is not None:
                        yield done()
                    block = row["block"]
                    mine = {"n": np.asarray(row["_n"]), "labels": [list(row[name]) for name in own]}
                    vectors = _matrix(row["v"], len(mine["n"]))
                    lengths = (vectors * vectors).sum(1)
                    place, sums, sizes = {}, np.zeros((len(vectors), 0)), np.zeros(0)
                    continue
                weight = np.asarray(row["_m"], float)
                others = _matrix(row["w"], len(weight))
                held, columns = [], []
                for i in range(len(own)):
                    for at, x in enumerate(row[f"_k{i}"]):
                        if x is not None and x == x:
                            held.append(at)
                            columns.append(place.setdefault((i, int(x)), len(place)))
                sums = np.pad(sums, ((0, 0), (0, len(place) - sums.shape[1])))
                table = np.zeros((len(weight), len(place)))
                table[held, columns] = weight[held]
                sizes = np.pad(sizes, (0, len(place) - len(sizes))) + table.sum(0)
                side = Distances(others)
                for at in range(0, len(vectors), NEAR_ROWS):
                    part = slice(at, at + NEAR_ROWS)
                    sums[part] += side.of(vectors[part], lengths[part]) @ table
        if block is not None:
            yield done()

    parts = pairs.mapInPandas(found, "labelling int, total double, rows long")
    sums = parts.groupBy("labelling").agg((F.sum("total") / F.sum("rows")).alias("silhouette"))
    names = F.array(*[F.lit(name) for name in labels])
    return sums.select(F.get(names, F.col("labelling")).alias("labelling"), "silhouette")

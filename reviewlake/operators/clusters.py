"""K-means, PCA, cluster-count sweeps, grids and nearest centres on vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.operators.blocks import mean_silhouettes, nearest
from reviewlake.operators.grid import cell_densities, grid_cells, neighbour_offsets
from reviewlake.operators.ranks import top_n
from reviewlake.operators.vectors import term_at

__all__ = ["cell_densities", "grid_cells", "nearest", "neighbour_offsets"]

# Ten starts from these seeds, the best one kept.
START_SEEDS: tuple[int, ...] = tuple(range(42, 52))
PARALLEL_RUNS = 4
# Spark's default: centres that move less than this have converged.
TOLERANCE = 1e-4
# Vectors packed together, and those of a block that meet all centres at a time.
BLOCK_VECTORS, SLICE = 4096, 512


def as_vector(df: DataFrame, column: str) -> DataFrame:
    """The column as an ML vector, converted from an array if needed."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return df.withColumn(column, array_to_vector(F.col(column)))
    return df


def _at_once(spark: SparkSession, run: Callable[[Any], Any], inputs: Sequence[Any]) -> list[Any]:
    """Results of a few Spark jobs started side by side, in the order of the inputs."""
    if not inputs:
        raise ValueError("nothing to run")
    with ThreadPool(min(PARALLEL_RUNS, len(inputs))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), inputs)


def _blocks(part: Iterator[Row]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The vectors of a partition in blocks (dimensions, row, place, value, weights) of their non-zero entries."""
    while rows := list(islice(part, BLOCK_VECTORS)):
        row, place, value = [], [], []
        for i, (vector, *_) in enumerate(rows):
            if isinstance(vector, SparseVector):
                at, numbers = vector.indices, vector.values
            else:
                numbers = vector.toArray()
                at = np.flatnonzero(numbers)
                numbers = numbers[at]
            row.append(np.full(len(at), i, np.int32))
            place.append(at.astype(np.int32))
            value.append(numbers)
        weights = np.array([float(weight[0]) if weight else 1.0 for _, *weight in rows])
        yield len(rows[0][0]), np.concatenate(row), np.concatenate(place), np.concatenate(value), weights


def _moves(blocks: Iterator[tuple], centres: np.ndarray, starts: np.ndarray) -> Iterator[list]:
    """[weighted sums, weights of the centres, costs of the runs] over the blocks of a partition; run r begins at ``starts[r]``."""
    sums, held, costs = np.zeros_like(centres), np.zeros(len(centres)), np.zeros(len(starts))
    ends = np.append(starts[1:], len(centres))
    lengths = (centres * centres).sum(1)
    for dimensions, row, place, value, weights in blocks:
        for at in range(0, len(weights), SLICE):
            weight = weights[at : at + SLICE]
            low, high = np.searchsorted(row, [at, at + len(weight)])
            vectors = np.zeros((len(weight), dimensions))
            vectors[row[low:high] - at, place[low:high]] = value[low:high]
            far = lengths - 2 * (vectors @ centres.T)
            own = (vectors * vectors).sum(1)
            members = np.zeros(far.shape)
            each = np.arange(len(weight))
            for run, (start, end) in enumerate(zip(starts, ends)):
                nearest_ = start + far[:, start:end].argmin(1)
                members[each, nearest_] = weight
                costs[run] += (weight * np.maximum(own + far[each, nearest_], 0)).sum()
            sums += members.T @ vectors
            held += members.sum(0)
    yield [sums, held, costs]


def best_seeds(
    vectors: DataFrame, vector: str, ks: Sequence[int], seeds: Sequence[int], max_iter: int = 100, weight: str | None = None
) -> dict[int, int]:
    """For each k the seed whose k-means run ends at the least training cost, the first one of equals.

    All runs begin at Spark's own first centres and move on together, so that a pass over the vectors is one step of
    every run, not of one. ``vectors`` has an ML vector column and is persisted by the caller.
    """
    spark = vectors.sparkSession
    runs = [(k, seed) for k in ks for seed in seeds]

    def begun(run: tuple[int, int]) -> np.ndarray:
        return np.array(_estimator(vector, *run, 0, weight).fit(vectors).clusterCenters())

    centres = _at_once(spark, begun, runs)
    costs = [math.inf] * len(runs)
    columns = [vector] if weight is None else [vector, weight]
    blocks = vectors.select(*columns).rdd.mapPartitions(_blocks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        moving = list(range(len(runs)))
        for _ in range(max_iter):
            if not moving:
                break
            sizes = [len(centres[run]) for run in moving]
            starts = np.cumsum([0, *sizes[:-1]])
            sent = spark.sparkContext.broadcast((np.concatenate([centres[run] for run in moving]), starts))
            sums, held, spent = blocks.mapPartitions(lambda part, sent=sent: _moves(part, *sent.value)).treeReduce(
                lambda a, b: [x + y for x, y in zip(a, b)]
            )
            sent.destroy()
            still = []
            for run, start, size, cost in zip(moving, starts, sizes, spent):
                part = slice(start, start + size)
                filled = held[part] > 0
                moved = centres[run].copy()
                moved[filled] = sums[part][filled] / held[part][filled, None]
                # Spark's rule: a run ends when no centre moves further than its tolerance.
                if ((moved - centres[run]) ** 2).sum(1).max() > TOLERANCE**2:
                    still.append(run)
                centres[run], costs[run] = moved, float(cost)
            moving = still
    finally:
        blocks.unpersist()
    best = {}
    for k in ks:
        found = [(seed, cost) for (k_, seed), cost in zip(runs, costs) if k_ == k]
        # Sums in another order differ in their last digits.
        limit = min(cost for _, cost in found) * (1 + 1e-9)
        best[k] = next(seed for seed, cost in found if cost <= limit)
    return best


def _estimator(vector: str, k: int, seed: int, max_iter: int, weight: str | None = None) -> KMeans:
    estimator = KMeans(
        k=k, seed=seed, featuresCol=vector, predictionCol="cluster", maxIter=max_iter, tol=TOLERANCE
    )
    return estimator if weight is None else estimator.setWeightCol(weight)


def kmeans_sweep(
    df: DataFrame,
    vector: str,
    ks: Sequence[int],
    seeds: Sequence[int] = START_SEEDS,
    max_iter: int = 100,
    weight: str | None = None,
) -> list[KMeansModel]:
    """For each k the best of several k-means runs by training cost.

    The vectors are kept between the runs. All runs are compared in common passes; the best of each k is then fitted.
    """
    used = [vector] if weight is None else [vector, weight]
    vectors = as_vector(df.select(*used), vector)
    # A caller may keep the same table; then it isn't this sweep's to drop.
    shared = vectors.storageLevel != StorageLevel.NONE
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        best = {k: seeds[0] for k in ks} if len(seeds) == 1 else best_seeds(vectors, vector, ks, seeds, max_iter, weight)
        return _at_once(
            df.sparkSession, lambda k: _estimator(vector, k, best[k], max_iter, weight).fit(vectors), ks
        )
    finally:
        if not shared:
            vectors.unpersist()


def kmeans(
    df: DataFrame,
    vector: str,
    k: int = 5,
    seeds: Sequence[int] = START_SEEDS,
    max_iter: int = 100,
    weight: str | None = None,
) -> KMeansModel:
    """The best of several k-means runs by training cost.

    ``weight`` is the number of equal rows a row stands for.
    """
    return kmeans_sweep(df, vector, [k], seeds, max_iter, weight)[0]


def assign(df: DataFrame, model: KMeansModel, vector: str, cluster: str = "cluster") -> DataFrame:
    """Adds the cluster of every row."""
    scored = model.transform(as_vector(df, vector))
    return scored.withColumnRenamed(model.getPredictionCol(), cluster)


def top_terms(
    df: DataFrame, vector: str, cluster: str, terms: list[str], n: int = 10
) -> DataFrame:
    """(cluster, term, weight, rank): the heaviest terms of each cluster centre.

    ``vector`` is a term vector over ``terms``. Centres are mean vectors, combined map-side, so a
    cluster that holds most rows is no heavier than the others.
    """
    centres = df.groupBy(cluster).agg(Summarizer.mean(F.col(vector)).alias("_centre"))
    entries = centres.select(
        cluster, F.posexplode(vector_to_array("_centre")).alias("_at", "_weight")
    ).filter(F.col("_weight") > 0)
    # Rounded so that sums of equal parts added in another order tie and fall back to the term.
    named = entries.select(
        cluster, term_at(terms, F.col("_at")).alias("term"), F.round("_weight", 9).alias("weight")
    )
    return top_n(named, [cluster], [F.desc("weight"), F.col("term")], n)


@dataclass
class Projection:
    """A fitted PCA with the data mean, so that projections are centred."""

    model: PCAModel
    mean: list[float]

    def transform(self, df: DataFrame, vector: str, output: str = "components") -> DataFrame:
        """Adds the centred components as an array."""
        moved = as_vector(df.withColumn("_input", F.col(vector)), "_input")
        shift = [float(x) for x in self.model.pc.toArray().T @ self.mean]
        projected = self.model.setInputCol("_input").setOutputCol("_projected").transform(moved)
        offsets = F.array(*[F.lit(x) for x in shift])
        centred = F.zip_with(vector_to_array("_projected"), offsets, lambda x, m: x - m)
        return projected.withColumn(output, centred).drop("_input", "_projected")

    @property
    def explained_variance(self) -> list[float]:
        return [float(x) for x in self.model.explainedVariance]


def pca(df: DataFrame, vector: str, k: int) -> Projection:
    """Principal components. Only the dimension-by-dimension matrix reaches the driver."""
    vectors = as_vector(df.select(vector), vector)
    model = PCA(k=k, inputCol=vector, outputCol="_projected").fit(vectors)
    mean = vectors.agg(Summarizer.mean(F.col(vector))).first()[0]
    return Projection(model, [float(x) for x in mean.toArray()])


def silhouette_sweep(
    df: DataFrame, vector: str, ks: Sequence[int] = tuple(range(2, 11)), seeds: Sequence[int] = START_SEEDS
) -> DataFrame:
    """(k, silhouette, best): the mean Euclidean silhouette of k-means for each k; distances are taken once for all."""
    vectors = as_vector(df.select(vector), vector).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = kmeans_sweep(vectors, vector, ks, seeds)
        placed = vectors
        for k, model in zip(ks, models):
            placed = model.transform(placed).withColumnRenamed("cluster", f"_k{k}")
        points = placed.withColumn(vector, vector_to_array(vector))
        found = mean_silhouettes(points, vector, [f"_k{k}" for k in ks]).collect()
    finally:
        vectors.unpersist()
    scores = {int(row["labelling"][2:]): float(row["silhouette"]) for row in found}
    best = max(scores.items(), key=lambda pair: (pair[1], -pair[0]))[0]
    return df.sparkSession.createDataFrame(
        [(int(k), scores[k], k == best) for k in ks], "k long, silhouette double, best boolean"
    )


def elbow_sweep(
    df: DataFrame, vector: str, ks: Sequence[int] = tuple(range(1, 7)), seeds: Sequence[int] = START_SEEDS
) -> DataFrame:
    """(k, inertia): within-cluster sum of squares for each k."""
    vectors = as_vector(df.select(vector), vector).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        larger = [int(k) for k in ks if k > 1]
        models = kmeans_sweep(vectors, vector, larger, seeds) if larger else []
        found = {k: float(model.summary.trainingCost) for k, model in zip(larger, models)}
        if len(larger) < len(ks):
            # One cluster: the squared distances to the mean.
            stats = vectors.agg(
                Summarizer.metrics("variance", "count").summary(F.col(vector)).alias("s")
            ).first()["s"]
            found[1] = float(sum(stats["variance"].toArray()) * (stats["count"] - 1))
        rows = [(k, found[k]) for k in (max(1, int(k)) for k in ks)]
    finally:
        vectors.unpersist()
    return df.sparkSession.createDataFrame(rows, "k long, inertia double")

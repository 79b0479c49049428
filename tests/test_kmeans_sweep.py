"""K-means runs compared in common passes: the seeds chosen are those of runs made one by one."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors

from reviewlake.operators import clusters


def _rows(spark, kind: str):
    rng = np.random.default_rng(7)
    v = rng.normal(0, 1, (300, 6)).round(3)
    v[rng.random(v.shape) < 0.5] = 0
    if kind == "sparse":
        rows = [(Vectors.sparse(6, np.flatnonzero(x).tolist(), x[x != 0].tolist()), float(i % 3 + 1)) for i, x in enumerate(v)]
    else:
        rows = [(Vectors.dense(x), float(i % 3 + 1)) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, ["v", "n"]).repartition(3).persist()


@pytest.mark.parametrize(("kind", "weight", "steps"), [("dense", None, 100), ("sparse", "n", 100), ("dense", "n", 2)])
def test_best_seeds_are_those_of_single_runs(spark, monkeypatch, kind, weight, steps):
    monkeypatch.setattr(clusters, "BLOCK_VECTORS", 64)
    monkeypatch.setattr(clusters, "SLICE", 10)
    rows, seeds = _rows(spark, kind), [1, 2, 3, 4]
    found = clusters.best_seeds(rows, "v", [2, 5], seeds, steps, weight)
    for k in (2, 5):
        costs = [clusters._estimator("v", k, seed, steps, weight).fit(rows).summary.trainingCost for seed in seeds]
        assert costs[seeds.index(found[k])] <= min(costs) * (1 + 1e-9)


def test_only_the_best_run_of_each_k_is_fitted_alone(spark, monkeypatch):
    fitted = []
    fit = KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, df: (fitted.append(self.getMaxIter()), fit(self, df))[1])
    costs = clusters.elbow_sweep(_rows(spark, "dense"), "v", [1, 2, 3], [1, 2, 3, 4]).collect()
    assert [row["k"] for row in costs] == [1, 2, 3] and len([steps for steps in fitted if steps]) == 2


def test_the_silhouette_sweep_compares_all_runs_at_once(spark, monkeypatch):
    asked = []
    best = clusters.best_seeds
    monkeypatch.setattr(clusters, "best_seeds", lambda *a: (asked.append(a[2]), best(*a))[1])
    found = clusters.silhouette_sweep(_rows(spark, "dense"), "v", [2, 3], [1, 2]).collect()
    assert [row["k"] for row in found] == [2, 3] and asked == [[2, 3]]

"""Distances of slices to a block: one product, and no second look at rows that are near nothing."""

from __future__ import annotations

import numpy as np
import pytest

from reviewlake.operators import blocks
from reviewlake.operators.hierarchy import distances


@pytest.mark.parametrize("shift", [0.0, 50.0])
def test_distances_of_a_slice(shift):
    rng = np.random.default_rng(1)
    others = rng.normal(shift, 1, (300, 8))
    others[40] = others[7] + 1e-9
    others[50] *= 1e4
    rows = np.concatenate([rng.normal(shift, 1, (30, 8)), others[5:9], others[50:51]])
    found = blocks.Distances(others).of(rows, (rows * rows).sum(1))
    plain = np.sqrt(((rows[:, None] - others[None]) ** 2).sum(-1))
    assert np.allclose(found, distances(rows, others), rtol=1e-7, atol=0)
    assert np.allclose(found, plain, rtol=1e-7, atol=0)
    assert (found[[30, 31, 32, 33, 34], [5, 6, 7, 8, 50]] == 0).all() and 0 < found[32, 40] < 1e-8


def test_silhouettes_take_a_task_for_each_group(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(int(i % 3), x.tolist()) for i, x in enumerate(rng.normal(0, 1, (400, 4)))]
    df = spark.createDataFrame(rows, "a long, v array<double>")
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 20)
    asked = []
    frame, dealt = type(df), type(df).repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda self, n, key: asked.append(out := dealt(self, n, key)) or out)
    assert -1 <= blocks.mean_silhouettes(df, "v", ["a"]).first()["silhouette"] <= 1
    held = asked[0].select("block").rdd.glom().map(lambda part: len({row["block"] for row in part})).collect()
    assert len(held) == 2 * spark.sparkContext.defaultParallelism and set(held) == {1}

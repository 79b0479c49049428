"""The edges that a density hierarchy is joined from: few per point, whatever the number of blocks."""

from __future__ import annotations

import numpy as np

from reviewlake.operators import hierarchy


def test_edges_grow_with_the_points(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "BLOCK_POINTS", 10)
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))]
    points = hierarchy.numbered_points(spark.createDataFrame(rows, "id long, v array<double>").repartition(2), "id", "v")
    counts, chunked = [], hierarchy._chunked
    monkeypatch.setattr(hierarchy, "_chunked", lambda edges, chunk: (counts.append(edges.count()), chunked(edges, chunk))[1])
    tree, _, _ = hierarchy.linkage(points, 5, 10)
    assert max(counts) <= 8 * len(rows)
    vectors = np.array([v for _, v in rows])
    far = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(2))
    cores = np.sort(far, axis=1)[:, 5]
    weights = np.maximum(far, np.maximum(cores[:, None], cores[None, :]))
    wanted = sorted(weights[x, y] for x, y in hierarchy.block_tree(np.minimum(weights, weights.T), np.arange(len(rows))))
    assert np.allclose(sorted(row["w"] for row in tree.collect()), wanted, rtol=1e-9)


def test_close_pairs_equal_all_pairs():
    rng = np.random.default_rng(1)
    for scale, shift in ((1.0, 0.0), (1e-20, 0.0), (1e20, 0.0), (1.0, 1e5)):
        a, b = (scale * (rng.normal(size=(n, 7)) + shift) for n in (300, 131))
        rows, columns = scale * rng.uniform(0, 3, 300), scale * rng.uniform(0, 3, 131)
        both = scale * rng.uniform(0, 3, (300, 131))
        far = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
        limit = np.maximum(rows[:, None], columns[None])
        for found, wanted in (
            (hierarchy.close_pairs(hierarchy.Side(a), hierarchy.Side(b), rows), far <= rows[:, None]),
            (hierarchy.close_pairs(hierarchy.Side(a), hierarchy.Side(b), rows, columns), far <= limit),
            (hierarchy.close_pairs(hierarchy.Side(a), hierarchy.Side(b), rows, columns, both), far <= np.maximum(limit, both)),
        ):
            assert set(zip(found[0].tolist(), found[1].tolist())) == set(zip(*(x.tolist() for x in np.nonzero(wanted))))


def test_forest_and_levels():
    x, y = np.array([0, 1, 0, 3, 2, 4]), np.array([1, 2, 2, 4, 3, 0])
    assert hierarchy.forest(5, x, y).tolist() == [0, 1, 3, 4]
    names, level = hierarchy.cluster_levels([(0, 2, 1.0), (1, 2, 1.0), (2, 4, 3.0), (3, 4, 3.0)])
    assert names.tolist() == [0, 1, 2, 3, 4]
    assert level[0].tolist() == [0, 1, 1, 3, 3] and level[3].tolist() == [3, 3, 3, 0, 3] and level[4, 2] == 3
    assert hierarchy.cluster_levels([])[1].tolist() == [[0]]

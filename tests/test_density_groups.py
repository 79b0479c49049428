"""Density clustering by groups of blocks: exact at the radius, and blocks are sent to groups, not to each block."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from reviewlake.operators import density


def test_balls_are_exact_at_the_radius():
    rng = np.random.default_rng(2)
    for scale in (1.0, 1e-20, 1e20):
        for far in (0.0, 1e6):
            points = rng.integers(-5, 6, (300, 3)) / 10
            points[0, 0] += far
            points *= scale
            radius = 0.5 * scale
            wanted = ((points[:, None] - points[None]) ** 2).sum(-1) <= radius * radius
            assert (density.Balls(points, radius).near(points) == wanted).all()


def test_blocks_are_sent_to_groups(spark, monkeypatch):
    monkeypatch.setattr(density, "BLOCK_POINTS", 8)
    rng = np.random.default_rng(3)
    rows = rng.normal(5, 0.3, (1200, 4)).round(1).tolist()
    df = spark.createDataFrame(list(enumerate(rows)), "id long, v array<double>")
    points = density.distinct_points(df, "id", "v")
    placed = density.with_blocks(points, 20.0, 2).persist()
    met = density._met(placed.withColumn("core", F.lit(False)), 2)
    blocks = placed.select("cell", "block").distinct().count()
    assert met.count() <= blocks * blocks // 3
    for radius in (0.4, 20.0):
        found = {r["node"]: r["nearby"] for r in density.neighbour_counts(placed, radius, 2).collect()}
        v = np.array(rows)
        near = (((v[:, None] - v[None]) ** 2).sum(-1) <= radius * radius).sum(1)
        assert found == {node: near[node] for node in found} and len(found) == points.count()


def test_links_span_what_all_links_do(spark, monkeypatch):
    monkeypatch.setattr(density, "BLOCK_POINTS", 8)
    monkeypatch.setattr(density, "SLICE", 3)
    monkeypatch.setattr(density, "TILE", 5)
    rng = np.random.default_rng(5)
    v = np.vstack([rng.normal(0, 1, (400, 3)), rng.normal(6, 0.5, (200, 3))]).round(2)
    df = spark.createDataFrame(list(enumerate(v.tolist())), "id long, v array<double>")
    near = ((v[:, None] - v[None]) ** 2).sum(-1) <= 0.25
    core = near.sum(1) >= 5
    labels = np.where(core, np.arange(len(v)), len(v))
    while True:
        reached = np.where(near & core[None] & core[:, None], labels[None], len(v)).min(1)
        if (reached == labels).all():
            break
        labels = reached
    labels = np.where(core, labels, np.where(near & core[None], labels[None], len(v)).min(1))
    sizes = {x: int((labels == x).sum()) for x in set(labels.tolist()) if x < len(v)}
    kept = sorted((x for x in sizes if sizes[x] >= 5), key=lambda x: (-sizes[x], x))
    found = density.density_clusters(df, "id", "v", 0.5, 5, 5).collect()
    assert {r["id"]: r["cluster"] for r in found} == {i: kept.index(x) if x in kept else -1 for i, x in enumerate(labels.tolist())}

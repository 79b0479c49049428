"""Nearest centres and silhouettes in blocks against plain loops over pairs."""

from __future__ import annotations

import math
import random

import pytest

from reviewlake.operators import blocks, clusters


def _points(seed: int, n: int, dims: int) -> list[list[float]]:
    rng = random.Random(seed)
    made = [[rng.uniform(-3, 3) for _ in range(dims)] for _ in range(n)]
    return made + made[:5]


def _far(a: list[float], b: list[float]) -> float:
    return math.dist(a, b)


@pytest.mark.parametrize("size", [7, 4096])
def test_nearest_equals_a_loop(spark, monkeypatch, size):
    monkeypatch.setattr(blocks.vector_blocks, "__defaults__", (size,))
    monkeypatch.setattr(blocks, "SLICE", 4)
    points, centres = _points(1, 40, 6), _points(2, 23, 6)  # five centres are there twice
    rows = spark.createDataFrame([(i, v, "x") for i, v in enumerate(points)], "id long, v array<double>, topic string")
    table = spark.createDataFrame([(7 * i % 31, v) for i, v in enumerate(centres)], "topic long, centre array<double>")
    for radius in (None, 2.5):
        found = blocks.nearest(rows, "v", table, radius, "near")
        assert found.columns == ["id", "v", "topic", "near"]
        wanted = {}
        for i, v in enumerate(points):
            d, topic = min((round(_far(v, c), 9), 7 * j % 31) for j, c in enumerate(centres))
            wanted[i] = topic if radius is None or d <= radius else -1
        assert {row["id"]: row["near"] for row in found.collect()} == wanted


def test_nearest_of_odd_vectors_and_names(spark):
    rows = spark.createDataFrame([(1, None), (2, [float("nan")]), (3, [1.0]), (4, [9.0])], "id long, v array<double>")
    table = spark.createDataFrame([("b", [1.0]), ("a", [1.0]), ("c", [4.0])], "topic string, centre array<double>")
    assert {r["id"]: r["topic"] for r in clusters.nearest(rows, "v", table).collect()} == {1: None, 2: None, 3: "a", 4: "c"}
    assert clusters.nearest(rows.limit(0), "v", table).count() == 0
    empty = clusters.nearest(rows, "v", table.limit(0)).collect()
    assert [r["topic"] for r in empty] == [None] * 4


def _silhouette(points: list[list[float]], labels: list[int | None]) -> float:
    held = [i for i, label in enumerate(labels) if label is not None]
    total = 0.0
    for i in held:
        means = {}
        for name in {labels[j] for j in held}:
            others = [_far(points[i], points[j]) for j in held if j != i and labels[j] == name]
            if others:
                means[name] = sum(others) / len(others)
        a = means.pop(labels[i], None)
        if a is not None and means and max(a, min(means.values())) > 0:
            b = min(means.values())
            total += (b - a) / max(a, b)
    return total / len(held)


@pytest.mark.parametrize("size", [9, 4096])
def test_silhouettes_equal_a_loop(spark, monkeypatch, size):
    monkeypatch.setattr(blocks.vector_blocks, "__defaults__", (size,))
    monkeypatch.setattr(blocks, "SLICE", 5)
    rng = random.Random(4)
    points = _points(3, 45, 4)
    labels = [[rng.randrange(k) for _ in points] for k in (2, 6)]
    labels[1][3] = None
    labels[0][0], labels[0][1] = 77, 78  # alone in their clusters
    labels.append([5] * len(points))  # no other cluster
    rows = [(i, v, *[column[i] for column in labels]) for i, v in enumerate(points)]
    rows.append((900, None, 0, 0, 0))
    df = spark.createDataFrame(rows, "id long, v array<double>, a int, b int, c int").repartition(3)
    found = {r["labelling"]: r["silhouette"] for r in blocks.mean_silhouettes(df, "v", ["a", "b", "c"]).collect()}
    for name, column in zip("abc", labels):
        assert math.isclose(found[name], _silhouette(points, column), abs_tol=1e-9)


def test_a_block_is_sent_to_groups_not_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks.vector_blocks, "__defaults__", (6,))
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 18)
    monkeypatch.setattr(blocks, "SLICE", 5)
    sizes = []
    made = blocks.vector_blocks
    monkeypatch.setattr(blocks, "vector_blocks", lambda *given: sizes.append(given[4:]) or made(*given))
    points = _points(9, 49, 4)
    labels = [i % 3 for i in range(len(points))]
    df = spark.createDataFrame([(i, v, labels[i]) for i, v in enumerate(points)], "id long, v array<double>, a int")
    found = blocks.mean_silhouettes(df, "v", ["a"]).first()["silhouette"]
    assert math.isclose(found, _silhouette(points, labels), abs_tol=1e-9)
    assert sizes == [(), (18,)]  # three groups of 18 read nine blocks of 6

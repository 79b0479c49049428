"""Hierarchical density clusters against a plain version that compares all pairs and cuts the tree from the top."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.operators import density, hierarchy


def _distance(a: list[float], b: list[float]) -> float:
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))


def _tree(rows: list[tuple[int, list[float]]], k: int) -> list[tuple[float, int, int]]:
    """Kruskal over all pairs of places, by (length, whether the vectors differ, the vectors' least keys)."""
    k = max(1, min(k, len(rows) - 1))
    name: dict[tuple, int] = {}
    for key, vector in rows:
        name[tuple(vector)] = min(key, name.get(tuple(vector), key))
    far = [[_distance(a, b) for _, b in rows] for _, a in rows]
    core = [sorted(line)[k] for line in far]
    edges = []
    for x in range(len(rows)):
        for y in range(x):
            a, b = sorted((name[tuple(rows[x][1])], name[tuple(rows[y][1])]))
            edges.append((max(core[x], core[y], far[x][y]), a != b, a, b, x, y))
    parent = list(range(len(rows)))

    def root(at: int) -> int:
        while parent[at] != at:
            at = parent[at]
        return at

    out = []
    for w, _, _, _, x, y in sorted(edges):
        if root(x) != root(y):
            parent[root(x)] = root(y)
            out.append((w, x, y))
    return out


def _clusters(rows: list[tuple[int, list[float]]], size: int, k: int, single: bool) -> dict[int, int]:
    """Cluster by key, by the published top-down rules."""
    labels = {key: -1 for key, _ in rows}
    if len(rows) < size:
        return labels
    tree, parts = _tree(rows, k), {i: [i] for i in range(len(rows))}
    made: dict[int, tuple[float, int, int]] = {}  # the dendrogram's inner nodes
    top = {i: i for i in range(len(rows))}
    for w, x, y in tree:
        a, b, new = top[x], top[y], len(rows) + len(made)
        made[new] = (w, a, b)
        parts[new] = parts[a] + parts[b]
        for point in parts[new]:
            top[point] = new
    clusters: list[dict] = []

    def walk(node: int, birth: float, parent: int | None) -> int:
        me = len(clusters)
        clusters.append({"parent": parent, "birth": birth, "all": parts[node], "points": [], "inner": []})
        while True:
            w, a, b = made[node]
            density_now = 1 / max(w, 1e-12)
            big = [side for side in (a, b) if len(parts[side]) >= size]
            if len(big) == 2:
                for side in (a, b):
                    clusters[me]["points"] += [density_now] * len(parts[side])
                    clusters[me]["inner"].append(walk(side, density_now, me))
                return me
            gone = [side for side in (a, b) if side not in big]
            for side in gone:
                clusters[me]["points"] += [density_now] * len(parts[side])
            if not big:
                return me
            node = big[0]

    walk(max(made), 0.0, None)

    def best(me: int) -> tuple[float, list[int]]:
        held = clusters[me]
        own = sum(at - held["birth"] for at in held["points"])
        inner = [best(child) for child in held["inner"]]
        total = sum(value for value, _ in inner)
        if own >= total and (single or held["parent"] is not None):
            return own, [me]
        return total, [name for _, names in inner for name in names]

    chosen = sorted((sorted(rows[p][0] for p in clusters[me]["all"]) for me in best(0)[1]), key=lambda ids: (-len(ids), ids[0]))
    return labels | {key: number for number, ids in enumerate(chosen) for key in ids}


def _blobs(seed: int, dims: int, sizes: list[tuple[int, float]]) -> list[tuple[int, list[float]]]:
    rng = random.Random(seed)
    rows = []
    for count, spread in sizes:
        centre = [rng.uniform(-6, 6) for _ in range(dims)]
        rows += [[c + rng.gauss(0, spread) for c in centre] for _ in range(count)]
    rng.shuffle(rows)
    return [(3 * i + 1, row) for i, row in enumerate(rows)]


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 5) for i, v in rows], "id long, v array<double>, number int").repartition(4)


CASES = [
    (_blobs(1, 2, [(60, 0.1), (90, 1.2), (40, 0.3), (20, 4.0)]), 10, 5, False),
    (_blobs(2, 50, [(80, 0.05), (120, 0.4), (60, 1.0), (40, 2.0)]), 15, 15, False),
    (_blobs(3, 3, [(500, 1.0)]), 12, 4, False),
    (_blobs(3, 3, [(120, 1.0)]), 12, 4, True),
    (_blobs(4, 2, [(30, 0.5)]), 31, 5, False),
]


@pytest.mark.parametrize(("rows", "size", "samples", "single"), CASES)
def test_equals_the_plain_version(spark, monkeypatch, rows, size, samples, single):
    monkeypatch.setattr(hierarchy, "BLOCK_POINTS", 16)
    found = hierarchy.hierarchical_clusters(_table(spark, rows), "id", "v", size, samples, allow_single=single)
    assert found.columns == ["id", "v", "number", "cluster"]
    assert {row["id"]: row["cluster"] for row in found.collect()} == _clusters(rows, size, samples, single)


def test_copies_ties_and_odd_vectors(spark):
    grid = [[float(x), float(y)] for x in range(8) for y in range(8)] + [[20.0 + x, 20.0] for x in range(6)]
    rows = [(i, v) for i, v in enumerate(grid * 2 + [[0.0, 0.0]] * 9 + [[20.0, 20.0]] * 4)]
    odd = [(900, None), (901, [1.0, None]), (902, [float("nan"), 0.0]), (903, [float("inf"), 0.0])]
    found = hierarchy.hierarchical_clusters(_table(spark, rows + odd), "id", "v", 6, 4)
    wanted = _clusters(rows, 6, 4, False) | {i: -1 for i, _ in odd}
    assert {row["id"]: row["cluster"] for row in found.collect()} == wanted


def test_one_radius_cannot_part_what_the_hierarchy_parts(spark):
    rng = random.Random(6)
    # Two dense groups side by side, and a thin one whose points lie further apart than the two groups do.
    dense = [[x + rng.gauss(0, 0.05), rng.gauss(0, 0.05)] for x in (0.0, 0.6) for _ in range(60)]
    thin = [[8 + rng.gauss(0, 1.2), rng.gauss(0, 1.2)] for _ in range(60)]
    rows = list(enumerate(dense + thin))
    table = _table(spark, rows)
    labels = {r["id"]: r["cluster"] for r in hierarchy.hierarchical_clusters(table, "id", "v", 15, 5).collect()}
    groups = [[labels[i] for i in range(60 * g, 60 * g + 60)] for g in range(3)]
    main = [max(set(g), key=g.count) for g in groups]
    assert len(set(main)) == 3 and -1 not in main and all(g.count(m) >= 50 for g, m in zip(groups, main))
    for radius in (0.1, 0.2, 0.3, 0.4, 0.6, 0.9, 1.3):
        flat = {r["id"]: r["cluster"] for r in density.density_clusters(table, "id", "v", radius, 5, 15).collect()}
        held = [[flat[i] for i in range(60 * g, 60 * g + 60)] for g in range(3)]
        common = [max(set(g), key=g.count) for g in held]
        assert len(set(common)) < 3 or -1 in common or any(g.count(m) < 50 for g, m in zip(held, common))


def test_tree_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "BLOCK_POINTS", 20)
    rows = _blobs(8, 4, [(70, 0.2), (90, 0.8)])
    points = hierarchy.numbered_points(_table(spark, rows), "id", "v")
    key = {row["number"]: row["node"] for row in points.collect()}
    wanted = {}
    for w, x, y in _tree(rows, 6):
        wanted[tuple(sorted((rows[x][0], rows[y][0])))] = w
    whole = None
    for chunk in (1 << 20, 40):
        tree, falls, joins = hierarchy.linkage(points, 6, 12, chunk)
        found = {tuple(sorted((key[r["i"]], key[r["j"]]))): r["w"] for r in tree.collect()}
        assert found.keys() == wanted.keys()
        assert all(math.isclose(found[edge], wanted[edge], rel_tol=1e-9) for edge in wanted)
        assert falls.count() == len(rows)
        chosen = hierarchy.stable_clusters(falls, joins).select("cluster", "chosen")
        parts = falls.join(chosen, "cluster").groupBy("chosen").agg(F.sort_array(F.collect_list("number")).alias("ids"))
        parts = sorted((r["ids"] for r in parts.filter("chosen IS NOT NULL").collect()))
        whole = whole or parts
        assert parts == whole


def test_strength_and_empty_tables(spark):
    rows = _blobs(9, 2, [(40, 0.3), (40, 0.3)])
    table = _table(spark, rows)
    found = hierarchy.hierarchical_clusters(table, "id", "v", 8, probability="p").collect()
    assert all((row["p"] == 0) == (row["cluster"] == -1) and 0 <= row["p"] <= 1 for row in found)
    for number in {row["cluster"] for row in found} - {-1}:
        assert max(row["p"] for row in found if row["cluster"] == number) == 1
    assert hierarchy.hierarchical_clusters(table.limit(0), "id", "v").count() == 0
    assert [row["cluster"] for row in hierarchy.hierarchical_clusters(table.limit(1), "id", "v").collect()] == [-1]


def test_block_tree_breaks_ties_by_number():
    rng = np.random.default_rng(3)
    for _ in range(20):
        n = int(rng.integers(2, 12))
        numbers = rng.permutation(50)[:n]
        weights = rng.integers(1, 4, (n, n)).astype(float)
        weights = np.minimum(weights, weights.T)
        edges = sorted(
            (weights[x, y], *sorted((int(numbers[x]), int(numbers[y])))) for x in range(n) for y in range(x)
        )
        group = {int(number): {int(number)} for number in numbers}
        wanted = set()
        for _, a, b in edges:
            if group[a] is not group[b]:
                wanted.add((a, b))
                group[a] |= group[b]
                for member in group[a]:
                    group[member] = group[a]
        found = hierarchy.block_tree(weights, numbers)
        assert {tuple(sorted((int(numbers[x]), int(numbers[y])))) for x, y in found} == wanted


@pytest.mark.parametrize("most", [1, 16])
def test_core_distances_of_groups_of_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(hierarchy, "BLOCK_POINTS", 4)
    monkeypatch.setattr(hierarchy, "GROUP_BLOCKS", most)
    rows = _blobs(5, 3, [(150, 1.0), (150, 4.0)])
    rows.append((9000, rows[0][1]))  # a copy
    points = hierarchy.numbered_points(_table(spark, rows), "id", "v")
    cores = hierarchy.opened_points(hierarchy.core_distances(points, 5)).join(points, "number").select("node", "core").collect()
    wanted = {i: sorted(_distance(v, w) for j, w in rows if j != i)[4] for i, v in rows[:-1]}
    assert {row["node"] for row in cores} == set(wanted)
    assert all(math.isclose(row["core"], wanted[row["node"]], abs_tol=1e-9) for row in cores)

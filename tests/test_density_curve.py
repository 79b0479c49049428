"""The density curve from binned moments against the sum over all values."""

from __future__ import annotations

import math
import random

import pytest

from reviewlake.operators import stats


def _curve(values: list[float], points: int) -> list[float]:
    n, mean = len(values), sum(values) / len(values)
    h = math.sqrt(sum((x - mean) ** 2 for x in values) / (n - 1)) * n**-0.2
    low, width = min(values), max(values) - min(values)
    at = [low - width / 2 + i * 2 * width / (points - 1) for i in range(points)]
    scale = n * h * math.sqrt(2 * math.pi)
    return [math.fsum(math.exp(-0.5 * ((t - x) / h) ** 2) for x in values) / scale for t in at]


@pytest.mark.parametrize("points", [7, 200])
def test_equals_the_sum_over_all_values(spark, points):
    rng = random.Random(3)
    groups = {
        "normal": [rng.gauss(5, 2) for _ in range(300)],
        "outliers": [rng.gauss(0, 1) for _ in range(200)] + [5000.0, -3000.0],
        "hot": [1.0] * 500 + [rng.random() for _ in range(40)],
        "two": [0.0, 1.0],
    }
    rows = [(name, x) for name, values in groups.items() for x in values]
    rows += [("same", 2.0)] * 9 + [("one", 3.0), ("none", None), (None, 1.0), ("normal", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    found: dict[str, list] = {}
    for row in sorted(stats.density(df, "x", "g", points).collect(), key=lambda row: (row["g"], row["point"])):
        found.setdefault(row["g"], []).append(row["density"])
    assert found.keys() == groups.keys()  # groups without a spread have no curve
    for name, values in groups.items():
        wanted = _curve(values, points)
        top = max(wanted)
        assert all(abs(a - b) <= 1e-12 * max(top, 1) for a, b in zip(found[name], wanted)), name


def test_hermite_polynomials():
    terms = stats._hermite(6)
    assert terms[2:] == [[-1, 0, 1], [0, -3, 0, 1], [3, 0, -6, 0, 1], [0, 15, 0, -10, 0, 1]]

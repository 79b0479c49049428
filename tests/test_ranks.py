from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.operators import ranks, stats


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_limits_groups_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    top = ranks.top_n(df, ["g"], [F.desc("id")], 3)
    assert plan(top).count("WindowGroupLimit") == 2
    assert sorted(row["id"] for row in top.collect()) == [994, 995, 996, 997, 998, 999]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {
        "normal": rng.normal(size=501),
        "heavy ties": np.repeat([5.0, 7.0], [400, 3]),
        "wide": np.concatenate([-(10.0 ** rng.uniform(-12, 12, 50)), 10.0 ** rng.uniform(-12, 12, 51), [0.0]]),
        "one": np.array([3.25]),
        "whole": rng.integers(-5, 5, 200).astype(float),
    }
    rows = [(name, float(x)) for name, xs in groups.items() for x in xs] + [("normal", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    levels = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = {row["g"]: row for row in ranks.quantiles(df, ["g"], "x", levels).collect()}
    for name, xs in groups.items():
        got = [found[name][f"q{i}"] for i in range(len(levels))]
        assert got == pytest.approx(list(np.quantile(xs, levels)), rel=1e-12, abs=1e-15)


def test_quantiles_over_everything(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert ranks.quantiles(df, [], "x", [0.5]).first()["q0"] == 2.5


def test_value_bucket_never_falls(spark):
    values = sorted([0.0, -0.0, 1e-300, -1e-300, 1.0, 1.0000001, -1.0, 5e-324, 1e308, -1e308, float("inf"), float("-inf")])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    found = [r["b"] for r in df.select("i", ranks.value_bucket(F.col("x")).alias("b")).orderBy("i").collect()]
    assert found == sorted(found)


def test_running_totals(spark):
    rng = np.random.default_rng(3)
    xs = np.unique(rng.normal(size=300))
    df = spark.createDataFrame([(float(x), int(i % 4)) for i, x in enumerate(xs)], "x double, n long")
    found = ranks.running_totals(df, ranks.value_bucket(F.col("x")), [F.asc("x")], {"n": "to"}).orderBy("x").collect()
    assert [row["to"] for row in found] == list(np.cumsum([i % 4 for i in range(len(xs))]))


def test_numbered_equals_row_number(spark):
    df = spark.range(500).select("id", F.lit("a").alias("g")).withColumn("_order", ranks.seeded_key("id"))
    found = {row["id"]: row["_rank"] for row in ranks.numbered(df, ["g"], "_order", "id").collect()}
    ordered = sorted(df.collect(), key=lambda row: (row["_order"], row["id"]))
    assert [found[row["id"]] for row in ordered] == list(range(500))


def test_histogram_like_numpy(spark):
    rng = np.random.default_rng(4)
    xs = np.concatenate([rng.normal(size=400), [9.0]])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    found = stats.histogram(df, "x", 30).orderBy("bin").collect()
    counts, edges = np.histogram(xs, 30)
    assert [row["count"] for row in found] == list(counts)
    assert [row["low"] for row in found] == pytest.approx(list(edges[:-1]))
    assert [row["high"] for row in found] == pytest.approx(list(edges[1:]))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    found = stats.histogram(df, "x", 4).orderBy("bin").collect()
    assert [row["count"] for row in found] == [0, 0, 2, 0]
    assert (found[0]["low"], found[-1]["high"]) == (1.5, 2.5)


def test_worst_product_without_enough_reviews_is_null(spark):
    rows = [("c1", "p", 1.0)] * 4 + [("c2", "p", 3.0)] * 5 + [("c2", "q", 1.0)] * 4
    df = spark.createDataFrame(rows, "c string, p string, r double")
    found = {row["c"]: row["worst_product"] for row in stats.worst_products(df, "c", "p", "r").collect()}
    assert found == {"c1": None, "c2": "p"}


def test_top_with_others_keeps_all_of_few_values(spark):
    df = spark.createDataFrame([(v,) for v in "aaabbc"], "v string")
    found = {r["v"]: r["count"] for r in stats.top_with_others(df, "v", 1, only_above=3).collect()}
    assert found == {"a": 3, "b": 2, "c": 1}
    found = {r["v"]: r["count"] for r in stats.top_with_others(df, "v", 1, only_above=2).collect()}
    assert found == {"a": 3, "Others": 3}


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(5)
    rows = [("a", float(x)) for x in rng.normal(size=300)] + [("b", float(x)) for x in rng.uniform(size=200)]
    df = spark.createDataFrame(rows, "g string, x double")
    found = stats.density(df, "x", "g", 400).collect()
    for name in "ab":
        curve = sorted((row["x"], row["density"]) for row in found if row["g"] == name)
        xs, ys = zip(*curve)
        assert np.trapezoid(ys, xs) == pytest.approx(1.0, abs=0.01)


def test_nan_is_missing(spark):
    rows = spark.createDataFrame([(1, float("nan")), (1, 1.0), (1, 2.0), (1, 3.0)], "g int, x double")
    assert ranks.quantiles(rows, ["g"], "x", [0.0, 0.5, 1.0]).first()[1:] == (1.0, 2.0, 3.0)
    assert stats.box_stats(rows, "x").first()["median"] == 2.0

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import sampling


def key(seed, value):
    return hashlib.md5(f"{seed}:{value}".encode()).hexdigest()


def labelled(spark, sizes):
    out = None
    start = 0
    for label, size in sizes.items():
        part = spark.range(start, start + size).select("id", F.lit(label).alias("label"))
        out = part if out is None else out.unionByName(part)
        start += size
    return out


def test_split_sizes_of_the_published_run(spark):
    parts = sampling.split(labelled(spark, {0: 27073, 1: 27073}), "label", "id")
    found = {(r["label"], r["split"]): r["count"] for r in parts.groupBy("label", "split").count().collect()}
    for label in (0, 1):
        assert found[label, "train"] == 18951
        assert found[label, "validation"] == 4061
        assert found[label, "test"] == 4061


@pytest.mark.parametrize("sizes", [{0: 1, 1: 3}, {0: 10, 1: 7, 2: 100}])
def test_split_is_the_order_of_the_keys(spark, sizes):
    df = labelled(spark, sizes)
    found = sampling.split(df, "label", "id", {"train": 0.8, "test": 0.2}, seed=7).collect()
    assert len(found) == sum(sizes.values())
    for label, size in sizes.items():
        rows = sorted((r for r in found if r["label"] == label), key=lambda r: key(7, r["id"]))
        parts = [r["split"] for r in rows]
        cut = int(0.8 * size)
        assert parts == ["train"] * cut + ["test"] * (size - cut)


def test_undersample_keeps_the_first_keys_of_every_class(spark):
    df = labelled(spark, {"a": 500, "b": 20, "c": 90})
    found = sampling.undersample(df, "label", "id").collect()
    assert Counter(r["label"] for r in found) == {"a": 20, "b": 20, "c": 20}
    want = sorted(range(500), key=lambda i: key(42, i))[:20]
    assert {r["id"] for r in found if r["label"] == "a"} == set(want)


def test_null_labels_are_not_sampled(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b"), (4, "b")], "id long, label string")
    assert {r["label"] for r in sampling.undersample(df, "label", "id").collect()} == {"a", "b"}


def test_undersample_with_more_classes_than_a_broadcast_takes(spark, monkeypatch):
    monkeypatch.setattr(sampling, "few_values", lambda df, columns: False)
    df = labelled(spark, {"a": 50, "b": 20})
    assert sampling.undersample(df, "label", "id").count() == 40


def test_sampling_does_not_shuffle_the_rows(spark):
    df = labelled(spark, {0: 100, 1: 50}).withColumn("wide", F.lit("text"))
    plan = sampling.split(df, "label", "id")._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "wide" in line]
    assert not wide


@pytest.mark.parametrize("minority_only", [False, True])
def test_oversample(spark, minority_only, monkeypatch):
    monkeypatch.setattr(sampling, "DRAW_BLOCK", 64)
    df = labelled(spark, {"a": 300, "b": 20})
    found = sampling.oversample(df, "label", "id", minority_only=minority_only)
    rows = sampling.repeat_rows(found, "id").collect()
    assert Counter(r["label"] for r in rows) == {"a": 300, "b": 300}
    copies = Counter(r["id"] for r in rows if r["label"] == "a")
    assert (max(copies.values()) == 1) is minority_only


def test_copies_are_numbered_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(sampling, "DRAW_BLOCK", 10)
    df = spark.createDataFrame([(1, 25), (2, 1)], "id long, copies long")
    found = sampling.repeat_rows(df, "id").collect()
    assert sorted(r["copy"] for r in found if r["id"] == 1) == list(range(1, 26))
    assert [r["copy"] for r in found if r["id"] == 2] == [1]


def test_samples_do_not_depend_on_partitioning(spark):
    df = labelled(spark, {"a": 300, "b": 120})
    first = {r["id"] for r in sampling.undersample(df.repartition(1), "label", "id").collect()}
    second = {r["id"] for r in sampling.undersample(df.repartition(7), "label", "id").collect()}
    assert first == second


def test_random_rows_skip_nulls(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(20)], "id long, v string")
    found = sampling.random_rows(df, 5, "id", ["v"]).collect()
    assert len(found) == 5 and all(r["v"] == "x" for r in found)

"""Shapes of plans and whole flows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from reviewlake.functions import text as tx
from reviewlake.operators import profile
from reviewlake.operators.once import compute_once
from reviewlake.plans import preprocessing, review_analysis, summaries, topic_model
from tests.conftest import SMALL

# Queries that write files or fit models do so while they are built, so only lazy ones are looked at.
LAZY = [
    name
    for name in sorted(queries())
    if name.split("_")[0].rstrip("0123456789") in {"flt", "prj", "jn", "agg", "win", "smp", "evl", "asp", "sum", "txt"}
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_costly_columns_are_computed_once(spark, tmp_path):
    spark.createDataFrame([(1, "a b c"), (2, "d")], "id long, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    cleaned = compute_once(df, {"cleaned": tx.clean_text(F.col("text"))}).filter(F.length("cleaned") > 2)
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<[^") == 1
    assert [r["id"] for r in cleaned.collect()] == [1]


def test_clean_and_funnel(spark):
    rows = [
        (1, "a long enough text", "positive"), (1, "a long enough text", "positive"), (2, "  ", "positive"),
        (3, "short", "bad"), (4, "another long text", None), (5, "<b>the last</b> long text", "bad"),
    ]
    df = spark.createDataFrame(rows, "id long, text string, label string")
    found = {r["id"]: r for r in preprocessing.clean(df, "text", "label").collect()}
    assert sorted(found) == [1, 5]
    assert (found[5]["label"], found[5]["review_text_clean"], found[5]["word_count"]) == (0, "the last long text", 4)
    funnel = [r["rows"] for r in profile.cleaning_funnel(df, "text", "label").orderBy("step").collect()]
    assert funnel == [6, 5, 4, 3, 2]
    with pytest.raises(ValueError):
        profile.cleaning_funnel(df, "review", "label")


def test_prepare_is_one_plan(spark):
    rows = [(i, f"a long enough text {i}", "positive" if i % 3 else "bad") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, label string")
    prepared = preprocessing.prepare(df, "text", "label", "id")
    report = {r["stage"]: r["rows"] for r in prepared.report().collect()}
    assert report == {"original": 60, "cleaned": 60, "balanced": 40, "train": 28, "validation": 6, "test": 6}


def test_balance_methods(spark):
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(10)], "id long, label int")
    assert preprocessing.balance(df, "label", "id", "oversample").count() == 14
    assert preprocessing.balance(df, "label", "id", "none").count() == 10


def test_load_reviews(spark):
    df = spark.createDataFrame([("one two three four five",), ("Posted: a b c d e f\nfour words only now",), (None,)], "t string")
    assert topic_model.load_reviews(df, "t").count() == 1


def test_articles(spark):
    rows = [(i, "c", "p1" if i % 2 else "p2", i % 2, f"review {i}", 1.25) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, c string, p string, label int, text string, rating double")
    found = review_analysis.cluster_articles(df, "c", "p", "label", "text", "rating", "id").first()
    assert found["body"].startswith("Top Products in Category_c:\n\n1. p1 (Rating: 1.3/5)\nPositive aspects: review 1 review 3")
    assert found["body"].endswith("\n\nProduct to Avoid: p1")
    assert found["summary"].startswith("# Category_c Product Recommendations\n\n## Top 3 Products\n\n### 1. p1\n**Rating:** 1.3/5")
    assert "### 2. p2\n**Rating:** 1.3/5\n\n**Common Complaints:**\n- review 0...\n\n## Product to Avoid" in found["summary"]


def test_pack_filters_after_sampling(spark):
    rows = [(i, "p", 1, "x" if i % 2 else "long text") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, p string, label int, text string")
    found = summaries.pack(df, "p", "label", "text", "id", n=10).first()
    sampled = sorted(rows, key=lambda r: __import__("hashlib").md5(f"42:{r[0]}".encode()).hexdigest())[:10]
    assert found["pos_text"].split("\n- ") == [r[3] for r in sampled if len(r[3]) > 5]
    assert found["neg_text"] == ""


def test_eligible_counts_the_limit_before_the_gate(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 6 + [("c",)] * 7, "p string")
    assert [r["p"] for r in summaries.eligible(df, "p", limit=2).collect()] == ["b"]


def test_describe(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "n int, t string")
    found = {(r["column"], r["statistic"]): r["value"] for r in profile.describe(df).collect()}
    assert found["n", "mean"] == "2.000000" and found["n", "50%"] == "2.000000"
    assert (found["t", "top"], found["t", "freq"], found["t", "unique"], found["t", "count"]) == ("a", "2", "1", "2")

from __future__ import annotations

import numpy as np
import pytest

from reviewlake.operators import evaluate

# Confusion counts behind the published metrics (TN, FP, FN, TP) and the published numbers in percent:
# accuracy, macro F1 where printed.
RUNS = [
    (267, 23, 94, 616, 88.30),
    (250, 35, 582, 133, 38.30),
    (86, 195, 155, 564, 65.00),
    (0, 289, 0, 711, 71.10),
    (271, 0, 728, 1, 27.20),
    (701, 5, 693, 13, 50.57),
    (69, 622, 105, 586, 47.40),
    (3595, 466, 415, 3646, 89.15),
    (3655, 406, 418, 3643, 89.85),
]


def matrix(spark, tn, fp, fn, tp):
    return spark.createDataFrame(
        [(0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)], "truth long, prediction long, count long"
    )


@pytest.mark.parametrize("tn, fp, fn, tp, accuracy", RUNS)
def test_report(spark, tn, fp, fn, tp, accuracy):
    found = {r["name"]: r for r in evaluate.report(matrix(spark, tn, fp, fn, tp)).collect()}
    assert round(found["accuracy"]["f1"] * 100, 2) == accuracy
    assert found["accuracy"]["support"] == tn + fp + fn + tp
    assert found["1"]["support"] == fn + tp
    assert found["1"]["recall"] == pytest.approx(tp / (fn + tp))
    assert found["weighted avg"]["recall"] == pytest.approx(found["accuracy"]["recall"])


def test_report_with_a_class_never_predicted(spark):
    found = {r["name"]: r for r in evaluate.report(matrix(spark, 0, 289, 0, 711)).collect()}
    shown = {
        name: [round(found[name][m] * 100, 2) for m in ("precision", "recall", "f1")] for name in found
    }
    assert shown["0"] == [0.0, 0.0, 0.0]
    assert shown["1"] == [71.10, 100.0, 83.11]
    assert shown["macro avg"] == [35.55, 50.0, 41.55]
    assert shown["weighted avg"] == [50.55, 71.10, 59.09]


def test_confusion_lists_empty_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "y int, p int")
    found = {(r["truth"], r["prediction"]): r["count"] for r in evaluate.confusion(df, "y", "p").collect()}
    assert found == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(0, 2)), float(rng.integers(0, 20)) / 20 - 0.3) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    assert evaluate.auc(df, "y", "s").first()["auc"] == pytest.approx(brute_auc(rows))
    points = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc(df, "y", "s").collect())
    xs, ys = zip(*points)
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    assert np.trapezoid(ys, xs) == pytest.approx(brute_auc(rows))


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert evaluate.auc(df, "y", "s").first()["auc"] is None

"""Evaluation of binary and multi-class predictions from one aggregate over the scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.operators.ranks import running_totals, value_bucket
from reviewlake.operators.stats import box_stats, histogram


def confusion(
    df: DataFrame, truth: str, prediction: str, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """(truth, prediction, count) for every pair of classes, zeros included."""
    flags = {
        (t, p): F.count_if((F.col(truth) == t) & (F.col(prediction) == p))
        for t in classes
        for p in classes
    }
    wide = df.agg(*[flag.alias(f"_{t}_{p}") for (t, p), flag in flags.items()])
    cells = [
        F.struct(
            F.lit(t).cast("long").alias("truth"),
            F.lit(p).cast("long").alias("prediction"),
            F.col(f"_{t}_{p}").alias("count"),
        )
        for t, p in flags
    ]
    return wide.select(F.inline(F.array(*cells)))


def _ratio(part: Column, whole: Column) -> Column:
    """Zero where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def report(matrix: DataFrame, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """(name, precision, recall, f1, support) per class, then accuracy, macro and weighted averages.

    ``matrix`` is a confusion table (truth, prediction, count). The accuracy row carries the accuracy
    in all three measures.
    """
    n = F.col("count")
    sums = [F.sum(n).alias("_all")]
    for c in classes:
        is_true, is_said = F.col("truth") == c, F.col("prediction") == c
        sums += [
            F.coalesce(F.sum(F.when(is_true & is_said, n)), F.lit(0)).alias(f"_hit_{c}"),
            F.coalesce(F.sum(F.when(is_true, n)), F.lit(0)).alias(f"_true_{c}"),
            F.coalesce(F.sum(F.when(is_said, n)), F.lit(0)).alias(f"_said_{c}"),
        ]
    totals = matrix.agg(*sums)
    names = ("precision", "recall", "f1")
    measures = {}
    for c in classes:
        hit, true, said = F.col(f"_hit_{c}"), F.col(f"_true_{c}"), F.col(f"_said_{c}")
        measures[c] = dict(
            zip(names, (_ratio(hit, said), _ratio(hit, true), _ratio(hit * 2, true + said)))
        )

    def row(name: str, values: dict[str, Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            *[values[m].alias(m) for m in names],
            support.cast("long").alias("support"),
        )

    def total(columns: list[Column]) -> Column:
        out = columns[0]
        for column in columns[1:]:
            out = out + column
        return out

    everything = F.col("_all")
    accuracy = _ratio(total([F.col(f"_hit_{c}") for c in classes]), everything)
    rows = [row(str(c), measures[c], F.col(f"_true_{c}")) for c in classes]
    rows.append(row("accuracy", dict.fromkeys(names, accuracy), everything))
    macro = {m: total([measures[c][m] for c in classes]) / len(classes) for m in names}
    rows.append(row("macro avg", macro, everything))
    weighted = {
        m: _ratio(total([measures[c][m] * F.col(f"_true_{c}") for c in classes]), everything)
        for m in names
    }
    rows.append(row("weighted avg", weighted, everything))
    return totals.select(F.inline(F.array(*rows)))


def _score_counts(df: DataFrame, truth: str, score: str) -> DataFrame:
    return (
        df.filter(F.col(truth).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(
            F.count_if(F.col(truth) == 1).alias("_pos"),
            F.count_if(F.col(truth) != 1).alias("_neg"),
        )
    )


def roc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score, and the origin at infinity."""
    counts = _score_counts(df, truth, score)
    points = running_totals(
        counts,
        -value_bucket(F.col("threshold")),
        [F.desc("threshold")],
        {"_pos": "_tp", "_neg": "_fp"},
    )
    totals = counts.agg(
        F.struct(F.sum("_pos").alias("pos"), F.sum("_neg").alias("neg"))
    ).scalar()
    curve = points.select(
        "threshold",
        F.try_divide(F.col("_fp").cast("double"), totals["neg"].cast("double")).alias("fpr"),
        F.try_divide(F.col("_tp").cast("double"), totals["pos"].cast("double")).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(curve)


def auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """One row with the area under the ROC curve; equal scores count half."""
    counts = _score_counts(df, truth, score)
    below = running_totals(
        counts, value_bucket(F.col("threshold")), [F.asc("threshold")], {"_neg": "_neg_to"}
    )
    wins = F.col("_pos") * (F.col("_neg_to") - F.col("_neg") * 0.5)
    return below.agg(
        F.try_divide(
            F.sum(wins.cast("double")),
            F.sum("_pos").cast("double") * F.sum("_neg").cast("double"),
        ).alias("auc")
    )


def score_histogram(df: DataFrame, truth: str, score: str, bins: int = 30) -> DataFrame:
    """Histogram of the scores of each true class over that class's own range."""
    return histogram(df, score, bins, by=[truth])


def score_box(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Box-plot numbers of the scores of each true class."""
    return box_stats(df, score, by=[truth])

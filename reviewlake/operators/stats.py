"""Counts, cross tables, histograms, box plots and density estimates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.scalars import percent
from reviewlake.functions.text import remove_stop_words, tokens
from reviewlake.operators.joins import few_values, in_top_values
from reviewlake.operators.once import compute_once, present
from reviewlake.operators.ranks import quantiles, top_n


def _join_groups(rows: DataFrame, per_group: DataFrame, df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Puts per-group numbers beside rows; with few groups the rows stay where they are, hot or not."""
    few = few_values(df, by)
    return rows.join(F.broadcast(per_group) if few else per_group, list(by))


def value_counts(
    df: DataFrame, column: str, with_percent: bool = False, top: int | None = None
) -> DataFrame:
    """(value, count[, percent]) from the most frequent value down, ties by value."""
    counts = present(df, [column]).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if with_percent:
        total = counts.agg(F.sum("count")).scalar()
        counts = counts.withColumn("percent", percent(F.col("count"), total))
    ordered = counts.orderBy(F.desc("count"), column)
    return ordered.limit(top) if top else ordered


def top_share(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """The most frequent values with their share of all rows, nulls in the total."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = value_counts(df, column, top=top)
    return counts.withColumn("percent", percent(F.col("count"), total))


def imbalance(df: DataFrame, label: str, limit: float = 1.5) -> DataFrame:
    """Largest and smallest class, their ratio, and whether it is above ``limit``."""
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    ratio = F.col("max_count") / F.col("min_count")
    return sizes.agg(F.max("n").alias("max_count"), F.min("n").alias("min_count")).select(
        "max_count", "min_count", ratio.alias("ratio"), (ratio > limit).alias("imbalanced")
    )


def top_with_others(df: DataFrame, column: str, top: int = 10, only_above: int = 20) -> DataFrame:
    """Counts of the ``top`` values and one row 'Others'; all values if there are few."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    distinct = counts.agg(F.count(F.lit(1))).scalar()
    leading = counts.orderBy(F.desc("n"), column).limit(top)
    # At most `top` rows by the limit above.
    marked = counts.join(
        F.broadcast(leading.select(column, F.lit(True).alias("_leading"))), column, "left"
    )
    keep = F.col("_leading").isNotNull() | (distinct <= only_above)
    return marked.groupBy(
        F.when(keep, F.col(column).cast("string")).otherwise("Others").alias(column)
    ).agg(F.sum("n").alias("count"))


def summary(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, median, sample standard deviation, minimum, maximum."""
    base = df.agg(
        F.avg(column).alias("mean"),
        F.stddev(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    median = quantiles(df, [], column, [0.5]).select("q0").scalar()
    return base.select("mean", median.alias("median"), "std", "min", "max")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, count, percent of all rows) in the order of the values."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("percent", percent(F.col("count"), total)).orderBy(column)


def label_counts(df: DataFrame, by: str, label: str, top: int | None = 30) -> DataFrame:
    """Negative and positive rows per group, total and positive percentage; largest groups first."""
    counts = (
        df.filter(F.col(label).isNotNull() & F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count_if(F.col(label) == 0).alias("negative"),
            F.count_if(F.col(label) == 1).alias("positive"),
        )
        .withColumn("total", F.col("negative") + F.col("positive"))
        .withColumn("positive_pct", percent(F.col("positive"), F.col("total")))
        .orderBy(F.desc("total"), by)
    )
    return counts.limit(top) if top else counts


def label_shares(
    df: DataFrame, by: str, label: str, labels: Sequence[int | str], top: int = 10
) -> DataFrame:
    """Row-normalised cross table in percent over the ``top`` most frequent groups."""
    rows = in_top_values(df, by, top).filter(F.col(label).isNotNull())
    table = rows.groupBy(by).pivot(label, list(labels)).count().fillna(0)
    total = sum((F.col(str(name)) for name in labels), F.lit(0))
    return table.select(
        by, *[percent(F.col(str(name)), total).alias(f"pct_{name}") for name in labels]
    )


def histogram(df: DataFrame, column: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the minimum and the maximum, empty ones included.

    Returns (by, bin, low, high, count) with bins numbered from 0. The last bin is closed. With one
    distinct value the range is value ± 0.5. Values are counted per group first, so the row that
    carries the range is joined to distinct values only.
    """
    x = F.col("_x")
    counted = present(df, [column, *by]).groupBy(*by, F.col(column).cast("double").alias("_x")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranges = counted.groupBy(*by).agg(F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    flat = F.col("_min") == F.col("_max")
    ranges = ranges.select(
        *by,
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_low"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_high"),
    )
    edges = ranges.withColumn(
        "bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")))
    )
    if by:
        ranged = _join_groups(counted, ranges, df, by)
    else:
        bounds = ranges.select(F.struct("_low", "_high")).scalar()
        ranged = counted.withColumn("_low", bounds["_low"]).withColumn("_high", bounds["_high"])
    width = F.col("_high") - F.col("_low")
    place = F.floor((x - F.col("_low")) * bins / width).cast("long")
    filled = (
        ranged.withColumn("bin", F.least(place, F.lit(bins - 1).cast("long")))
        .groupBy(*by, "bin")
        .agg(F.sum("_n").alias("count"))
    )
    step = width / bins
    return edges.join(filled, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("_low") + F.col("bin") * step).alias("low"),
        (F.col("_low") + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("count", F.lit(0).cast("long")).alias("count"),
    )


def box_stats(df: DataFrame, column: str, by: Sequence[str] = (), reach: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers, rows, outliers.

    A whisker ends at the last value within ``reach`` interquartile ranges of the box.
    """
    group = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    counted = (
        present(rows, [column, *group])
        .groupBy(*group, F.col(column).cast("double").alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    box = quantiles(rows, group, column, [0.25, 0.5, 0.75])
    spread = F.col("q2") - F.col("q0")
    inside = (F.col("_x") >= F.col("q0") - spread * reach) & (
        F.col("_x") <= F.col("q2") + spread * reach
    )
    return (
        _join_groups(counted, box, rows, group)
        .groupBy(*group)
        .agg(
            F.max("q0").alias("q1"),
            F.max("q1").alias("median"),
            F.max("q2").alias("q3"),
            # A whisker never ends inside the box.
            F.least(F.min(F.when(inside, F.col("_x"))), F.max("q0")).alias("whisker_low"),
            F.greatest(F.max(F.when(inside, F.col("_x"))), F.max("q2")).alias("whisker_high"),
            F.sum("_n").alias("count"),
            F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
        )
        .select(
            *by, "q1", "median", "q3", "whisker_low", "whisker_high", "count", "outliers"
        )
    )


def top_words(
    df: DataFrame, text: str, by: str, stop_words: Sequence[str], top: int = 100
) -> DataFrame:
    """The most frequent words per group without stop words: (by, word, count, rank)."""
    kept = remove_stop_words(tokens(F.col(text)), stop_words)
    worded = compute_once(present(df.select(by, text), [by]), {"_words": kept})
    words = worded.select(by, F.explode("_words").alias("word"))
    counts = words.groupBy(by, "word").agg(F.count(F.lit(1)).alias("count"))
    return top_n(counts, [by], [F.desc("count"), F.col("word")], top)


def group_stats(df: DataFrame, by: str, column: str) -> DataFrame:
    """Long form (by, statistic, value) of median, mean and maximum per group."""
    simple = df.filter(F.col(column).isNotNull()).groupBy(by).agg(
        F.avg(column).cast("double").alias("mean"), F.max(column).cast("double").alias("max")
    )
    median = quantiles(df, [by], column, [0.5]).withColumnRenamed("q0", "median")
    wide = simple.join(median, by)
    return wide.unpivot([by], ["median", "mean", "max"], "statistic", "value")


def topic_scores(df: DataFrame, topic: str, score: str) -> DataFrame:
    """Rows and mean score per topic."""
    return df.groupBy(topic).agg(
        F.count(F.lit(1)).alias("count"), F.avg(score).alias("mean_score")
    )


def coverage(df: DataFrame, score: Column, thresholds: Sequence[float] = (0.5, 0.6, 0.7)) -> DataFrame:
    """Share of rows whose score reaches each threshold, in one pass."""
    reached = [F.coalesce((score >= t), F.lit(False)).cast("double") for t in thresholds]
    wide = df.agg(*[F.avg(flag).alias(f"_t{i}") for i, flag in enumerate(reached)])
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_t{i}").alias("fraction"))
                    for i, t in enumerate(thresholds)
                ]
            )
        )
    )


def outlier_share(df: DataFrame, outlier: Column) -> DataFrame:
    """(is_outlier, count, fraction)."""
    counts = df.groupBy(outlier.alias("is_outlier")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("fraction", F.col("count") / total)


# Moments of a bin of half a bandwidth: the first one left out is below 1e-14 of a kernel's height.
MOMENTS = 15
# Bandwidths beyond which a kernel is 0 in double precision.
REACH = 39


def _hermite(count: int) -> list[list[int]]:
    """Coefficients of the polynomials He_0, He_1, ... by He_k+1 = u He_k - k He_k-1."""
    out = [[1], [0, 1]]
    for k in range(1, count - 1):
        raised = [0, *out[k]]
        out.append([x - k * (out[k - 1][j] if j < len(out[k - 1]) else 0) for j, x in enumerate(raised)])
    return out[:count]


def density(
    df: DataFrame, column: str, by: str, points: int = 1000
) -> DataFrame:
    """Gaussian kernel density per group with Scott's bandwidth: (by, point, x, density).

    The grid runs half a range beyond both ends. Values are binned once, half a bandwidth to a bin, with the sums of the
    powers of their places in it. With u from a grid point to the middle of the bin and v from there to a value, in
    bandwidths, the kernel is exp(-u u / 2) times the sum of He_k(u) v^k / k!, so a bin is a polynomial in u, exact to
    rounding. A pass over the rows finds the bandwidths, another one the bins; only bins meet grid points, within the
    reach of a kernel.
    """
    rows = present(df, [column, by]).select(by, F.col(column).cast("double").alias("_x"))
    width = F.col("_max") - F.col("_min")
    settings = (
        rows.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_s"),
            F.min("_x").alias("_min"), F.max("_x").alias("_max"),
        )
        .select(
            by, "_n", "_min",
            (F.col("_s") * F.pow(F.col("_n"), F.lit(-0.2))).alias("_h"),
            (F.col("_min") - width * 0.5).alias("_from"),
            (width * 2 / (points - 1)).alias("_step"),
        )
        .filter(F.col("_h") > 0)
    )
    side = F.col("_h") / 2
    bin_ = F.floor((F.col("_x") - F.col("_min")) / side)
    placed = _join_groups(rows, settings, df, [by]).withColumn("_bin", bin_)
    place = (F.col("_x") - F.col("_min") - (F.col("_bin") + 0.5) * side) / F.col("_h")
    powers = [F.sum(F.pow(F.col("_v"), F.lit(k))).alias(f"_m{k}") for k in range(MOMENTS)]
    bins = placed.withColumn("_v", place).groupBy(by, "_bin", "_n", "_min", "_h", "_from", "_step").agg(*powers)
    # The bin's polynomial: every moment over k!, times the coefficients of He_k.
    terms = _hermite(MOMENTS)
    shape = [
        sum((F.col(f"_m{k}") * (terms[k][j] / math.factorial(k)) for k in range(j, MOMENTS) if terms[k][j]), F.lit(0.0)).alias(f"_a{j}")
        for j in range(MOMENTS)
    ]
    middle = F.col("_min") + (F.col("_bin") + 0.5) * F.col("_h") / 2
    shaped = bins.select(by, "_n", "_h", "_from", "_step", middle.alias("_c"), *shape)
    first = F.greatest(F.lit(0), F.ceil((F.col("_c") - REACH * F.col("_h") - F.col("_from")) / F.col("_step")))
    last = F.least(F.lit(points - 1), F.floor((F.col("_c") + REACH * F.col("_h") - F.col("_from")) / F.col("_step")))
    met = shaped.withColumn("point", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    at = F.col("_from") + F.col("point") * F.col("_step")
    met = met.withColumn("_u", (at - F.col("_c")) / F.col("_h"))
    value = F.col(f"_a{MOMENTS - 1}")
    for j in range(MOMENTS - 2, -1, -1):
        value = value * F.col("_u") + F.col(f"_a{j}")
    found = met.select(by, "point", "_n", "_h", (value * F.exp(F.col("_u") * F.col("_u") * -0.5)).alias("_part"))
    sums = found.groupBy(by, "point").agg(F.sum("_part").alias("_sum"))
    # Grid points that no kernel reaches have density 0.
    grid = settings.withColumn("point", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    whole = grid.join(sums, [by, "point"], "left")
    return whole.select(by, "point", at.alias("x"), (F.coalesce("_sum", F.lit(0.0)) / scale).alias("density"))


def review_totals(df: DataFrame, label: str, product: str) -> DataFrame:
    """One row: reviews, positive, negative, distinct products."""
    return df.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.col(label) == 1).alias("positive_reviews"),
        F.count_if(F.col(label) == 0).alias("negative_reviews"),
        F.count_distinct(product).alias("unique_products"),
    )


def product_ratings(df: DataFrame, product: str, rating: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean rating and number of rated reviews per product."""
    return df.groupBy(*by, product).agg(
        F.avg(rating).alias("avg_rating"), F.count(rating).alias("n_ratings")
    )


def worst_products(
    df: DataFrame, cluster: str, product: str, rating: str, min_reviews: int = 5
) -> DataFrame:
    """Per cluster the product with the lowest mean rating among those with enough reviews.

    Every cluster has a row; without a qualifying product the name is null.
    """
    rated = product_ratings(df, product, rating, [cluster])
    enough = F.col("n_ratings") >= min_reviews
    order = F.when(enough, F.struct(F.col("avg_rating"), F.col(product)))
    return rated.groupBy(cluster).agg(
        F.min_by(F.when(enough, F.col(product)), order).alias("worst_product"),
        F.min(F.when(enough, F.col("avg_rating"))).alias("worst_rating"),
    )


def cluster_profile(
    df: DataFrame, cluster: str, category: str, product: str, categories: int = 5, products: int = 3
) -> DataFrame:
    """Per cluster its size and its most frequent categories and products as 'name (count)' lists."""

    def leading(column: str, n: int, out: str) -> DataFrame:
        counts = df.filter(F.col(column).isNotNull()).groupBy(cluster, column).agg(
            F.count(F.lit(1)).alias("_n")
        )
        top = top_n(counts, [cluster], [F.desc("_n"), F.col(column)], n, "_rank")
        entry = F.struct(
            "_rank", F.concat(F.col(column), F.lit(" ("), F.col("_n"), F.lit(")")).alias("_text")
        )
        listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["_text"])
        return top.groupBy(cluster).agg(F.array_join(listed, ", ").alias(out))

    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    return (
        sizes.join(leading(category, categories, "top_categories"), cluster, "left")
        .join(leading(product, products, "top_products"), cluster, "left")
    )

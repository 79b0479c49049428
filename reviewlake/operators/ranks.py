"""Exact ranks and order statistics that no single hot group can pile onto one task.

A window ordered over a whole class puts that class into one task. Here rows fall into ordered
buckets first: a count per (group, bucket) is aggregated map-side, running totals are taken over that
small histogram, and only rows of one bucket are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.operators.once import present

# 4096 buckets per group for hashed order keys, and per doubling of magnitude for numbers.
HASH_DIGITS = 3
STEPS_PER_DOUBLING = 4096


def seeded_key(key: Column | str, seed: int = 42) -> Column:
    """A repeatable pseudo-random order key: the same on every run, partitioning and engine."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")).cast("binary"))


def hash_bucket(order_key: Column) -> Column:
    """Leading hex digits of a seeded key: ordered like the key and evenly filled."""
    return F.substring(order_key, 1, HASH_DIGITS)


def value_bucket(value: Column) -> Column:
    """An integer that never falls when ``value`` grows, fine-grained at every magnitude."""
    x = value.cast("double")
    # log2 of the smallest double is -1074, so the shifted logarithm is positive.
    step = F.floor((F.log2(F.abs(x)) + 1100) * STEPS_PER_DOUBLING).cast("long") + 1
    return (
        F.when(x == 0, F.lit(0).cast("long"))
        .when(x > 0, F.when(x == float("inf"), F.lit(2**40)).otherwise(step))
        .otherwise(F.when(x == float("-inf"), F.lit(-(2**40))).otherwise(-step))
    )


def top_n(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank.

    The row_number filter plans as a window group limit: every map task cuts each group to ``n`` rows
    before the exchange, so a hot group sends ``n`` rows per task and not its whole content.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window))
    return ranked.filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("long"))


def _group_columns(by: Sequence[str]) -> list[str]:
    return list(by) if by else ["_all"]


def _with_group(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by else df.withColumn("_all", F.lit(0))


def _bucket_totals(rows: DataFrame, group: list[str]) -> DataFrame:
    """(group, bucket) -> rows before the bucket, rows in it, rows in the group."""
    histogram = rows.groupBy(*group, "_bucket").agg(F.sum("_weight").alias("_in"))
    ordered = Window.partitionBy(*group).orderBy("_bucket")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return histogram.select(
        *group,
        "_bucket",
        "_in",
        F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"),
        F.sum("_in").over(Window.partitionBy(*group)).alias("_total"),
    )


def rows_at_ranks(
    df: DataFrame,
    by: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    wanted: Callable[[Column], Column],
    weight: Column | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """The rows at given 0-based ranks of each group.

    ``bucket`` must not fall along ``order``; ``wanted`` maps the group size to an array of ranks;
    ``weight`` is the number of equal rows a row stands for. Only rows of the buckets that hold a
    wanted rank are ranked. ``few_groups`` says the caller checked the number of groups: the bucket
    list is then broadcast and only rows of those buckets are shuffled. Returns (by, order columns, _rank, _total), one row per wanted rank.
    """
    group = _group_columns(by)
    rows = _with_group(df, by).select(
        *group,
        *[name for name in order if name not in group],
        bucket.alias("_bucket"),
        (F.lit(1).cast("long") if weight is None else weight.cast("long")).alias("_weight"),
    )
    rows = present(rows, [*group, "_bucket"])
    totals = _bucket_totals(rows, group)
    targets = (
        totals.withColumn("_rank", F.explode(F.array_distinct(wanted(F.col("_total")))))
        .filter(
            (F.col("_rank") >= F.col("_before"))
            & (F.col("_rank") < F.col("_before") + F.col("_in"))
        )
        .groupBy(*group, "_bucket", "_before", "_total")
        .agg(F.collect_set("_rank").alias("_ranks"))
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    running = F.sum("_weight").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ranked = (
        rows.join(F.broadcast(targets) if few_groups else targets, [*group, "_bucket"])
        .withColumn("_to", F.col("_before") + running)
        .withColumn("_rank", F.explode("_ranks"))
        .filter((F.col("_rank") < F.col("_to")) & (F.col("_rank") >= F.col("_to") - F.col("_weight")))
    )
    return ranked.select(*by, *[name for name in order if name not in by], "_rank", "_total")


def running_totals(
    df: DataFrame, bucket: Column, order: Sequence[Column], sums: dict[str, str]
) -> DataFrame:
    """Adds, for each ``{column: new}``, the sum of ``column`` over the rows up to and including this.

    ``bucket`` must not fall along ``order``. The running sum inside a bucket is local; the sums of the
    buckets before it come from a small table.
    """
    rows = present(df.withColumn("_bucket", bucket), ["_bucket"])
    per_bucket = rows.groupBy("_bucket").agg(
        *[F.sum(column).alias(f"_sum_{new}") for column, new in sums.items()]
    )
    # One row per bucket: the number of buckets depends on the value range, not on the row count.
    before = (
        Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_bucket.select(
        "_bucket",
        *[
            F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_before_{new}")
            for new in sums.values()
        ],
    )
    inside = (
        Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = rows.join(offsets, "_bucket")
    for column, new in sums.items():
        joined = joined.withColumn(new, F.col(f"_before_{new}") + F.sum(column).over(inside))
    return joined.drop("_bucket", *[f"_before_{new}" for new in sums.values()])


def numbered(df: DataFrame, by: Sequence[str], order_key: str, key: str) -> DataFrame:
    """(by, key, _rank, _total): the 0-based rank of every row of its group along a seeded key."""
    group = _group_columns(by)
    rows = _with_group(df, by).select(
        *group,
        key,
        order_key,
        hash_bucket(F.col(order_key)).alias("_bucket"),
        F.lit(1).cast("long").alias("_weight"),
    )
    rows = present(rows, [*group, "_bucket"])
    inside = Window.partitionBy(*group, "_bucket").orderBy(order_key, key)
    return rows.join(_bucket_totals(rows, group), [*group, "_bucket"]).select(
        *by,
        key,
        (F.col("_before") + F.row_number().over(inside) - 1).alias("_rank"),
        "_total",
    )


def quantiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], prefix: str = "q"
) -> DataFrame:
    """Exact quantiles with linear interpolation: columns ``q0``, ``q1``, ... in the given order.

    Equal values are counted first, so a value that fills a third of a group is one row.
    """
    counted = (
        present(df, [value, *by])
        .groupBy(*by, F.col(value).cast("double").alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    def position(p: float, total: Column) -> Column:
        return F.lit(float(p)) * (total - 1).cast("double")

    def wanted(total: Column) -> Column:
        ranks = []
        for p in probabilities:
            at = position(p, total)
            ranks += [F.floor(at).cast("long"), F.ceil(at).cast("long")]
        return F.array(*ranks)

    found = rows_at_ranks(counted, by, value_bucket(F.col("_x")), ["_x"], wanted, F.col("_n"))
    outputs = []
    for i, p in enumerate(probabilities):
        at = position(p, F.col("_total"))
        low = F.max(F.when(F.col("_rank") == F.floor(at), F.col("_x")))
        high = F.max(F.when(F.col("_rank") == F.ceil(at), F.col("_x")))
        share = F.max(at - F.floor(at))
        outputs.append((low + (high - low) * share).alias(f"{prefix}{i}"))
    return found.groupBy(*by).agg(*outputs)

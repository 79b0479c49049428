"""Exact, repeatable samples and splits.

Rows are ordered by a seeded hash of their key. A sample of n rows is "the rows up to the n-th", so it
is enough to find that n-th row, the cutoff, in a narrow (class, key) projection; the wide rows are then
filtered where they lie, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.operators.joins import few_values
from reviewlake.operators.ranks import (
    hash_bucket,
    numbered,
    rows_at_ranks,
    seeded_key,
    top_n,
)

# Rows a draw task generates at a time.
DRAW_BLOCK = 65_536


def _cutoffs(
    df: DataFrame,
    label: str,
    key: str,
    seed: int,
    sizes: Callable[[Column], Sequence[Column]],
) -> DataFrame:
    """One row per class with, per wanted size n, the n-th order key as ``_cut{i}``.

    A cutoff is null where n is 0: nothing is taken. The result is broadcast if the number of classes
    allows it, which leaves the rows it is joined to where they are.
    """
    few = few_values(df, [label])
    keyed = df.filter(F.col(label).isNotNull()).select(
        label, F.col(key), seeded_key(key, seed).alias("_order")
    )
    found = rows_at_ranks(
        keyed,
        [label],
        hash_bucket(F.col("_order")),
        ["_order", key],
        lambda total: F.array(*[size - 1 for size in sizes(total)]),
        few_groups=few,
    )
    wanted = sizes(F.col("_total"))
    cutoffs = found.groupBy(label).agg(
        *[
            F.max(F.when(F.col("_rank") == size - 1, F.struct("_order", key))).alias(f"_cut{i}")
            for i, size in enumerate(wanted)
        ]
    )
    return F.broadcast(cutoffs) if few else cutoffs


def random_rows(
    df: DataFrame, n: int, key: str, not_null: Sequence[str] = (), seed: int = 42
) -> DataFrame:
    """A uniform sample of ``n`` rows."""
    rows = df.dropna(subset=list(not_null)) if not_null else df
    return rows.orderBy(seeded_key(key, seed), key).limit(n)


def random_per_group(
    df: DataFrame, by: Sequence[str], n: int, key: str, seed: int = 42, rank: str = "rank"
) -> DataFrame:
    """At most ``n`` random rows of each group."""
    return top_n(df, by, [seeded_key(key, seed), F.col(key)], n, rank)


def shuffle_rows(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in a repeatable random order (a range-partitioned sort)."""
    return df.orderBy(seeded_key(key, seed), key)


def undersample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """As many rows of every class as the smallest class has, without replacement."""
    smallest = df.filter(F.col(label).isNotNull()).groupBy(label).count().agg(F.min("count")).scalar()
    cutoffs = _cutoffs(df, label, key, seed, lambda total: [F.least(total, smallest)])
    order = F.struct(seeded_key(key, seed).alias("_order"), F.col(key))
    return df.join(cutoffs, label).filter(order <= F.col("_cut0")).select(*df.columns)


def oversample(
    df: DataFrame, label: str, key: str, seed: int = 42, minority_only: bool = False
) -> DataFrame:
    """Every class drawn with replacement to the size of the largest, the largest included.

    Adds ``copies``, how often the row was drawn. ``minority_only`` keeps the largest class as it is.
    Use :func:`repeat_rows` for one row per draw.
    """
    keyed = df.filter(F.col(label).isNotNull()).select(
        label, key, seeded_key(key, seed).alias("_order")
    )
    ranks = numbered(keyed, [label], "_order", key)
    sizes = keyed.groupBy(label).agg(F.count(F.lit(1)).alias("_total"))
    largest = sizes.agg(F.max("_total")).scalar()
    # Draws are generated in blocks spread over the cluster, so a class of any size is never
    # unfolded from one row in one task.
    blocks = sizes.select(
        label,
        "_total",
        largest.alias("_largest"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((largest - 1) / DRAW_BLOCK))).alias("_block"),
    ).repartition(F.col("_block"))
    first = F.col("_block") * DRAW_BLOCK
    last = F.least(first + DRAW_BLOCK, F.col("_largest")) - 1
    draws = blocks.select(label, "_total", F.explode(F.sequence(first, last)).alias("_draw"))
    picks = (
        draws.select(label, draw_rank(F.col(label), F.col("_draw"), F.col("_total"), seed).alias("_rank"))
        .groupBy(label, "_rank")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    copies = ranks.join(picks, [label, "_rank"]).select(label, key, "_total", "copies")
    if minority_only:
        kept = ranks.filter(F.col("_total") == largest).select(
            label, key, "_total", F.lit(1).cast("long").alias("copies")
        )
        copies = copies.filter(F.col("_total") < largest).unionByName(kept)
    return df.join(copies.select(key, "copies"), key).select(*df.columns, "copies")


def draw_rank(label: Column, draw: Column, total: Column, seed: int = 42) -> Column:
    """The rank (from 0) the ``draw``-th draw of a class picks."""
    text = F.concat(
        F.lit(f"{seed}:draw:"), label.cast("string"), F.lit(":"), draw.cast("string")
    )
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return F.pmod(number, total)


def repeat_rows(df: DataFrame, key: str, copies: str = "copies") -> DataFrame:
    """One row per copy, numbered from 1 in ``copy``.

    A row of a tiny class may stand for a large part of the output, so copies are made in blocks that
    are spread over the tasks.
    """
    count = F.col(copies)
    blocks = df.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / DRAW_BLOCK)))
    ).repartition(F.col(key), F.col("_block"))
    first = F.col("_block") * DRAW_BLOCK + 1
    last = F.least(first + (DRAW_BLOCK - 1), count)
    return blocks.withColumn("copy", F.explode(F.sequence(first, last))).drop(copies, "_block")


def split(
    df: DataFrame,
    label: str,
    key: str,
    fractions: dict[str, float] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Stratified split, exact in every class: adds the column ``split``.

    The first part takes ``floor(fraction * n)`` rows of a class of n; each next part takes its share
    of what is left by the same rule; the last part takes the rest. Rows without a class are dropped.
    """
    fractions = fractions or {"train": 0.7, "validation": 0.15, "test": 0.15}
    names = list(fractions)

    def bounds(total: Column) -> list[Column]:
        out: list[Column] = []
        taken: Column = F.lit(0).cast("long")
        for i, name in enumerate(names[:-1]):
            # Rounded, so that 0.15 of 0.15 + 0.15 is a half and not a little less.
            share = round(fractions[name] / sum(fractions[other] for other in names[i:]), 12)
            part = F.floor(F.lit(share) * (total - taken).cast("double")).cast("long")
            taken = taken + part
            out.append(taken)
        return out

    cutoffs = _cutoffs(df, label, key, seed, lambda total: [*bounds(total), total])
    order = F.struct(seeded_key(key, seed).alias("_order"), F.col(key))
    part: Column = F.lit(names[-1])
    for i in reversed(range(len(names) - 1)):
        part = F.when(order <= F.col(f"_cut{i}"), F.lit(names[i])).otherwise(part)
    return df.join(cutoffs, label).withColumn("split", part).select(*df.columns, "split")

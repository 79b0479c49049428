"""Grids over the leading coordinates of vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_GRID_DIMENSIONS = 4


def grid_cells(df: DataFrame, vector: str, side: float, dimensions: int) -> DataFrame:
    """Adds ``cell``: the grid cell of the first ``dimensions`` coordinates; absent ones count as 0."""
    if not 1 <= dimensions <= MAX_GRID_DIMENSIONS:
        raise ValueError(f"between 1 and {MAX_GRID_DIMENSIONS} dimensions, project the vectors first")
    places = [
        F.floor(F.coalesce(F.get(F.col(vector), F.lit(i)).cast("double"), F.lit(0.0)) / side).cast("long")
        for i in range(dimensions)
    ]
    return df.withColumn("cell", F.array(*places))


def neighbour_offsets(dimensions: int) -> Column:
    """Offsets of a cell and all cells that touch it, as one array literal."""
    offsets: list[list[int]] = [[]]
    for _ in range(dimensions):
        offsets = [head + [step] for head in offsets for step in (-1, 0, 1)]
    return F.array(*[F.array(*[F.lit(x).cast("long") for x in offset]) for offset in offsets])


def cell_densities(cells: DataFrame, dimensions: int) -> DataFrame:
    """(cell, points, nearby) per occupied cell; ``nearby`` counts the points of it and the cells it touches.

    Points are counted per cell before anything is paired, and each cell sends its count to a fixed
    number of neighbours, so a crowded cell costs no more than an empty one.
    """
    counts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("points"))
    sent = counts.withColumn("_to", F.explode(neighbour_offsets(dimensions))).select(
        F.zip_with("cell", "_to", lambda a, b: a + b).alias("cell"), F.col("points").alias("_points")
    )
    received = sent.groupBy("cell").agg(F.sum("_points").alias("nearby"))
    return counts.join(received, "cell")

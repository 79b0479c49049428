"""Density clustering by exact distance over all coordinates.

A grid on the leading coordinates only proposes candidates: a projection never lengthens a distance, so points
within the radius lie in the same or in touching cells. Each candidate is then tested by its full distance.
Cells are cut into blocks of bounded size and blocks are sent to groups of blocks, so a crowded cell is spread over
many tasks, and what leaves a group is its counts and a spanning forest, never its pairs of points.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.operators.components import connected_components
from reviewlake.operators.grid import grid_cells, neighbour_offsets
from reviewlake.session import cut_lineage

# Points of a block, on average, and points of a group of blocks, at most.
BLOCK_POINTS, GROUP_POINTS = 2048, 32768
# Pairs of blocks that meet in one part of a group, about.
PART_PAIRS = 256
# Rows and balls that meet at a time: their distances stay in a core's cache.
SLICE, TILE = 128, 4096
# Parts a crowded cell or a frequent vector is salted into.
SALTS = 16


def _vector_name(vector: str) -> Column:
    """Equal vectors have equal names; null vectors and vectors with null or non-finite numbers have none."""
    numbers = F.col(vector).cast("array<double>")
    # -0.0 equals 0.0 but is written otherwise.
    plain = F.transform(numbers, lambda x: x + F.lit(0.0))
    odd = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.md5(F.to_json(plain)))


def distinct_points(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(node, name, n, v): one row per distinct vector, its smallest key and its number of copies."""
    named = df.select(F.col(key).alias("node"), _vector_name(vector).alias("name"), F.col(vector).alias("v"))
    return (
        named.filter(F.col("name").isNotNull())
        .groupBy("name")
        .agg(
            F.min("node").alias("node"),
            F.count(F.lit(1)).alias("n"),
            F.first("v").cast("array<double>").alias("v"),
        )
    )


def of_rows(df: DataFrame, key: str, vector: str, found: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of ``df``, copies of a vector included, with the other columns of ``found`` (name, ...), one row per distinct vector."""
    # One vector may be that of a third of all rows: what was found for it is handed out under every salt.
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    handed = found.withColumn("_salt", salts).withColumnRenamed("name", "_name")
    rows = df.withColumns({"_name": _vector_name(vector), "_salt": F.pmod(F.xxhash64(key), F.lit(SALTS))})
    return rows.join(handed, ["_name", "_salt"], how).drop("_name", "_salt")


def with_blocks(points: DataFrame, radius: float, dimensions: int) -> DataFrame:
    """Points with their ``cell`` and their ``block`` of about BLOCK_POINTS points in it."""
    placed = grid_cells(points, "v", radius, dimensions).withColumn(
        "_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS))
    )
    blocks = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_POINTS).alias("_blocks"))
    salted = blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn(
        "_salt", F.col("_salt").cast("long")
    )
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("_blocks"))
    return placed.join(salted, ["cell", "_salt"]).withColumn("block", block).drop("_salt", "_blocks")


def _met(points: DataFrame, dimensions: int) -> DataFrame:
    """(grp, part, own, seq, last, nodes, counts, cores, vectors): blocks as sent to groups of blocks of one cell.

    A group meets each block of its own and of touching cells once, in parts of about PART_PAIRS pairs of blocks: its own
    (``own``) come first in every part and meet in part 0, the others in one part each. Blocks are numbered (``seq``) by cell,
    and ``last`` is the number of the group's own last one.
    """
    entry = F.struct("node", "n", "core", "v")
    gathered = points.groupBy("cell", "block").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    flat = gathered.select(
        "cell", "block", F.col("e.node").alias("nodes"), F.col("e.n").alias("counts"),
        F.col("e.core").alias("cores"), F.flatten("e.v").alias("vectors"),
    )

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, kind in (("counts", np.int64), ("cores", bool), ("vectors", float)):
                frame[name] = [np.asarray(values, dtype=kind).tobytes() for values in frame[name]]
            yield frame

    kinds = {"counts": T.BinaryType(), "cores": T.BinaryType(), "vectors": T.BinaryType()}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in flat.schema.fields])
    blocks = cut_lineage(flat.mapInPandas(packed, schema))
    # Groups as large as leave work for all cores.
    spread = 3 * points.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(GROUP_POINTS // BLOCK_POINTS, blocks.count() // spread))
    # Only the names of blocks are put in one order.
    place = F.row_number().over(Window.partitionBy("cell").orderBy("block")) - 1
    names = blocks.select("cell", "block", F.floor(place / size).alias("_part"))
    names = cut_lineage(
        names.select(
            "cell", "block", F.row_number().over(Window.orderBy("cell", "block")).alias("seq"),
            (F.dense_rank().over(Window.orderBy("cell", "_part")) - 1).alias("grp"),
        )
    )
    groups = names.groupBy("cell", "grp").agg(F.max("seq").alias("last"))
    sent = names.select(
        F.col("cell").alias("_from"), "block", "seq", F.col("grp").alias("_grp"), F.explode(neighbour_offsets(dimensions)).alias("_step")
    )
    sent = sent.withColumn("cell", F.zip_with("_from", "_step", lambda a, b: a + b)).join(groups, "cell").select(
        F.col("_from").alias("cell"), "block", "seq", "grp", "last", (F.col("_grp") == F.col("grp")).alias("own")
    )
    # Only names are put in order and counted here as well; a group of one cell is met by those of touching cells alone.
    share = max(1, PART_PAIRS // size)
    other = F.row_number().over(Window.partitionBy("grp", "own").orderBy("seq")) - 1
    placed = sent.withColumn("part", F.when(F.col("own"), F.lit(0)).otherwise(F.floor(other / share)).cast("int"))
    parts_of = placed.groupBy("grp").agg(F.max("part").alias("_top"))
    sent = placed.join(parts_of, "grp").withColumn(
        "part", F.explode(F.when(F.col("own"), F.sequence(F.lit(0), "_top")).otherwise(F.array("part")))
    ).drop("_top")
    sent = cut_lineage(sent)
    # Parts are numbered, so that they are dealt evenly; a task holds about as many pairs whatever their number.
    units = sent.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("_rows"))
    units = cut_lineage(units.withColumn("unit", F.row_number().over(Window.orderBy("grp", "part")) - 1))
    count, rows = units.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    parts = max(1, min(count, max(16 * spread, (rows or 0) // share)))
    dealt = sent.join(units.drop("_rows"), ["grp", "part"]).join(blocks, ["cell", "block"]).drop("cell", "block")
    return dealt.repartitionById(parts, F.pmod("unit", F.lit(parts)).cast("int")).sortWithinPartitions(
        "grp", "part", F.col("own").cast("int").desc(), "seq"
    ).drop("unit")


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, Iterator]]:
    """For each part of a group of ``_met`` the group's own blocks, and the blocks they meet in it."""
    rows = (row for frame in frames for row in frame.itertuples(index=False))
    for (_, part), members in groupby(rows, key=lambda row: (row.grp, row.part)):
        held, first = [], []
        for row in members:
            if not row.own:
                first.append(row)
                break
            held.append(row)
        yield held, chain([] if part else held, first, members)


def _vectors(rows: list) -> np.ndarray:
    return np.concatenate([np.frombuffer(row.vectors).reshape(len(row.nodes), -1) for row in rows])


def within(a: np.ndarray, b: np.ndarray, radius: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` lie within the radius; doubtful ones are measured by differences."""
    lengths = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    squared = lengths - 2 * (a @ b.T)
    limit = radius * radius
    doubt = 1e-9 * (lengths + limit)
    near = squared < limit - doubt
    for i in range(len(a)):
        unsure = np.nonzero(np.abs(squared[i] - limit) <= doubt[i])[0]
        if len(unsure):
            near[i, unsure] = ((b[unsure] - a[i]) ** 2).sum(1) <= limit
    return near


class Balls:
    """Balls of one radius around fixed centres: one product per slice of rows, and differences where that is in doubt."""

    def __init__(self, centres: np.ndarray, radius: float) -> None:
        self.centres, self.radius, self.limit = centres, radius, radius * radius
        lengths = (centres * centres).sum(1)
        self.top = lengths.max(initial=0.0)
        # Short numbers where none of them overflows or vanishes; the bound on their rounding is in ``doubt``.
        short = max(self.top, self.limit) < 1e30 and self.limit > 1e-30
        self.kind = np.float32 if short else np.float64
        ones = np.ones((len(centres), 1))
        self.side = np.concatenate([-2 * centres, ones, (lengths - self.limit)[:, None]], axis=1).T.astype(self.kind, order="C")

    def near(self, rows: np.ndarray) -> np.ndarray:
        """Which rows lie in which balls."""
        lengths = (rows * rows).sum(1)
        top = lengths.max(initial=0.0)
        if self.kind is np.float32 and top >= 1e30:
            return within(rows, self.centres, self.radius)
        beyond = np.concatenate([rows, lengths[:, None], np.ones((len(rows), 1))], axis=1).astype(self.kind) @ self.side
        doubt = (rows.shape[1] + 8) * np.finfo(self.kind).eps * (2 * (top + self.top) + self.limit)
        found, maybe = beyond < -doubt, beyond <= doubt
        unsure = np.count_nonzero(maybe) - np.count_nonzero(found)
        if unsure > beyond.size // 100 + 1000:
            return within(rows, self.centres, self.radius)
        if unsure:
            at = np.flatnonzero(maybe & ~found)
            for part in np.array_split(at, 1 + len(at) // (1 << 14)):
                i, j = np.divmod(part, len(self.centres))
                apart = self.centres[j] - rows[i]
                found.ravel()[part] = (apart * apart).sum(1) <= self.limit
        return found


def _slices(vectors: np.ndarray) -> Iterator[slice]:
    for at in range(0, len(vectors), SLICE):
        yield slice(at, at + SLICE)


def _balls(centres: np.ndarray, radius: float) -> list[Balls]:
    return [Balls(centres[at : at + TILE], radius) for at in range(0, len(centres), TILE)]


def _near_places(rows: np.ndarray, balls: list[Balls]) -> tuple[np.ndarray, np.ndarray]:
    """(row, ball) of all rows in balls, by row."""
    found = [np.divmod(np.flatnonzero(ball.near(rows)), len(ball.centres)) for ball in balls]
    row = np.concatenate([np.zeros(0, np.int64), *(j for j, _ in found)])
    ball = np.concatenate([np.zeros(0, np.int64), *(i + at * TILE for at, (_, i) in enumerate(found))])
    order = np.argsort(row, kind="stable")
    return row[order], ball[order]


def neighbour_counts(points: DataFrame, radius: float, dimensions: int) -> DataFrame:
    """(node, nearby): points within the radius, copies and the point itself counted."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held, met in _groups(frames):
            balls = _balls(_vectors(held), radius)
            seen = [np.zeros(len(ball.centres), np.int64) for ball in balls]
            for row in met:
                vectors, counts = _vectors([row]), np.frombuffer(row.counts, np.int64)
                # Sums of whole numbers are exact below the first one that the kind does not have.
                kind = np.float32 if counts.sum() < 1 << 24 else np.float64
                for part in _slices(vectors):
                    for ball, sums in zip(balls, seen):
                        sums += (counts[part].astype(kind) @ ball.near(vectors[part]).astype(kind)).astype(np.int64)
            yield pd.DataFrame({"node": [node for row in held for node in row.nodes], "nearby": np.concatenate(seen)})

    kind = points.schema["node"].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("nearby", T.LongType())])
    parts = _met(points.withColumn("core", F.lit(False)), dimensions).mapInPandas(counted, schema)
    return parts.groupBy("node").agg(F.sum("nearby").alias("nearby"))


def _hooked(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the places ``a`` and ``b`` are joined; a label is the smallest place with it."""
    while True:
        apart = labels[a] != labels[b]
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        parent = np.arange(len(labels))
        np.minimum.at(parent, np.maximum(labels[a], labels[b]), np.minimum(labels[a], labels[b]))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        labels = parent[labels]


def _links(points: DataFrame, radius: float, dimensions: int) -> DataFrame:
    """(src, dst, inner): links that join dense points as all their links would (inner), and the links of
    other points to dense ones, of which each has fewer than the samples a dense point needs.

    A part of a group joins the group's own points, and each dense point of a block before its last to one of them.
    """

    def linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held, met in _groups(frames):
            vectors = _vectors(held)
            nodes = np.concatenate([np.asarray(row.nodes) for row in held])
            core = np.concatenate([np.frombuffer(row.cores, bool) for row in held])
            dense, thin = nodes[core], nodes[~core]
            balls, thin_balls = _balls(vectors[core], radius), _balls(vectors[~core], radius)
            labels = np.arange(len(dense))
            for row in met:
                inside = np.frombuffer(row.cores, bool)
                others, names = _vectors([row])[inside], np.asarray(row.nodes)[inside]
                for part in _slices(others):
                    if len(thin):
                        j, i = _near_places(others[part], thin_balls)
                        yield pd.DataFrame({"src": thin[i], "dst": names[part][j], "inner": False})
                    if row.seq > row.last or not len(dense):
                        continue
                    j, i = _near_places(others[part], balls)
                    starts = np.flatnonzero(np.diff(j, prepend=-1))
                    first = i[starts]
                    labels = _hooked(labels, i, np.repeat(first, np.diff(starts, append=len(j))))
                    if not row.own:
                        yield pd.DataFrame({"src": names[part][j[starts]], "dst": dense[first], "inner": True})
            moved = labels != np.arange(len(labels))
            yield pd.DataFrame({"src": dense[moved], "dst": dense[labels[moved]], "inner": True})

    kind = points.schema["node"].dataType
    schema = T.StructType(
        [T.StructField("src", kind), T.StructField("dst", kind), T.StructField("inner", T.BooleanType())]
    )
    return _met(points, dimensions).mapInPandas(linked, schema)


def _numbered(sizes: DataFrame) -> DataFrame:
    """(component, cluster): numbers from 0 by falling size, ties by component.

    Only distinct sizes are put in one order; there are fewer than the square root of twice the rows.
    """
    per_size = sizes.groupBy("size").agg(F.count(F.lit(1)).alias("_n"))
    larger = Window.partitionBy(F.lit(0)).orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_size.select("size", F.coalesce(F.sum("_n").over(larger), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("size").orderBy("component")) - 1
    return sizes.withColumn("_place", place).join(starts, "size").select(
        "component", (F.col("_start") + F.col("_place")).cast("int").alias("cluster")
    )


def density_clusters(
    df: DataFrame,
    key: str,
    vector: str,
    radius: float,
    min_samples: int = 10,
    min_cluster_size: int = 15,
    output: str = "cluster",
    dimensions: int = 2,
) -> DataFrame:
    """Density clustering with noise = -1, by Euclidean distance over all coordinates.

    A point is dense if ``min_samples`` points, itself counted, lie within ``radius``. Dense points within
    the radius of each other form a cluster; another point joins the cluster with the smallest id of those
    it touches (the id is the smallest key of a dense point). Clusters with fewer than ``min_cluster_size``
    points are noise. Clusters are numbered from 0 by falling size. Copies of a vector are counted, not
    compared. ``dimensions`` is the number of leading coordinates of the candidate grid and does not change
    the result. Vectors that are null or hold null or non-finite numbers are noise.
    """
    points = cut_lineage(with_blocks(distinct_points(df, key, vector), radius, dimensions))
    nearby = neighbour_counts(points, radius, dimensions)
    marked = cut_lineage(points.join(nearby, "node").withColumn("core", F.col("nearby") >= min_samples))
    links = cut_lineage(_links(marked, radius, dimensions))
    inner = links.filter("inner").select("src", "dst")
    parts = connected_components(marked.filter("core").select("node"), inner)
    # Border links number fewer than min_samples per point; the dense end may be a hot one.
    border = links.filter(~F.col("inner")).select(F.col("src").alias("_border"), F.col("dst").alias("node"))
    touched = border.join(parts, "node").groupBy(F.col("_border").alias("node")).agg(
        F.min("component").alias("component")
    )
    member = cut_lineage(parts.select("node", "component").unionByName(touched))
    sized = member.join(marked.select("node", "name", "n"), "node")
    sizes = sized.groupBy("component").agg(F.sum("n").alias("size")).filter(F.col("size") >= min_cluster_size)
    clustered = sized.join(_numbered(sizes), "component").select("name", F.col("cluster").alias(output))
    placed = of_rows(df, key, vector, clustered, "left")
    return placed.withColumn(output, F.coalesce(F.col(output), F.lit(-1))).select(*df.columns, output)

"""Hierarchical density clustering: clusters of different densities, chosen by their stability.

The distance of two points is their mutual reachability, the largest of their Euclidean distance and both core distances
(to the ``min_samples``-th other point). The minimum spanning tree of all points under it, cut from its longest edge on,
is the hierarchy; a part with fewer than ``min_cluster_size`` points is not a cluster but falls out of one.

Distinct vectors lie in blocks of similar ones. A few pivots give every block intervals of distances, and by the triangle
inequality these bound the distance of two blocks in any number of dimensions. Core distances read the blocks that
may hold a near point, in the order of their bounds. The trees of the blocks, the shortest edges of a chain of blocks and
the edges to near points span everything; their hierarchy says from when on two points are surely together, and no edge
between them that is longer is one of the spanning tree. So pairs of blocks only propose edges that are no longer: a few
per point. The proposed edges are then joined in the order of their length, a
bounded number at a time, and that order is the hierarchy: each join of two clusters and each point falling into
one is a row, never a tree in memory. Only the table of clusters, of which there are at most twice the points over
``min_cluster_size``, is walked in one task. Vectors without structure give no bound and are compared in all pairs of blocks,
by short products; only pairs that pass are measured in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.operators.density import SALTS, _hooked, _numbered, _vector_name, distinct_points
from reviewlake.session import cut_lineage

# Points of a block, pivots, block summaries that are compared at a time, and edges joined in one task.
BLOCK_POINTS = 1024
PIVOTS = 16
SUMMARIES = 512
CHUNK_EDGES = 1 << 20
# Rows of a block that meet another one at a time: their distances stay in a core's cache.
SLICE = 128
# Blocks that one task compares with others together, at most: a block is sent to each such group once.
GROUP_BLOCKS = 16
# Edges to near points, of each point, among those that span everything; clusters of these edges' hierarchy, about half at most.
NEAR_EDGES = 4
KNOWN_CLUSTERS = 500
# The density of points that coincide.
LEAST_DISTANCE = 1e-12

_BLOCK = "block long, numbers binary, counts binary, vectors binary, low array<double>, high array<double>"


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` and ``b``; short ones are taken from differences."""
    lengths = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    squared = lengths - 2 * (a @ b.T)
    short_a, short_b = np.nonzero(squared < 1e-4 * lengths)
    for at in range(0, len(short_a), 1 << 14):
        i, j = short_a[at : at + (1 << 14)], short_b[at : at + (1 << 14)]
        squared[i, j] = ((a[i] - b[j]) ** 2).sum(1)
    return np.sqrt(np.maximum(squared, 0))


class Side:
    """Vectors of a block as one side of a product that gives squared distances."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors, self.lengths = vectors, (vectors * vectors).sum(1)
        self.top = float(self.lengths.max(initial=0.0))
        self.made: dict[tuple, np.ndarray] = {}

    def left(self, kind: type) -> np.ndarray:
        if ("left", kind) not in self.made:
            ones = np.ones((len(self.vectors), 1))
            whole = np.concatenate([self.vectors, self.lengths[:, None], ones], axis=1)
            self.made["left", kind] = whole.astype(kind)
        return self.made["left", kind]

    def right(self, kind: type) -> np.ndarray:
        if ("right", kind) not in self.made:
            ones = np.ones((len(self.vectors), 1))
            whole = np.concatenate([-2 * self.vectors, ones, self.lengths[:, None]], axis=1)
            self.made["right", kind] = whole.T.astype(kind, order="C")
        return self.made["right", kind]


def apart(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the rows ``i`` of ``a`` and ``j`` of ``b``, from differences."""
    far = np.empty(len(i))
    for at in range(0, len(i), 1 << 14):
        part = slice(at, at + (1 << 14))
        far[part] = np.sqrt(((a[i[part]] - b[j[part]]) ** 2).sum(1))
    return far


def _true(marks: np.ndarray) -> np.ndarray:
    """Places of the few true ones: eight are looked at together."""
    marks = marks.ravel()
    whole = len(marks) // 8 * 8
    eights = np.flatnonzero(marks[:whole].view(np.uint64))
    at = (8 * eights[:, None] + np.arange(8)).ravel()
    return np.concatenate([at[marks[at]], whole + np.flatnonzero(marks[whole:])])


def close_pairs(
    a: Side, b: Side, rows: np.ndarray, columns: np.ndarray | None = None, both: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """(i, j, distance) of the pairs no further apart than ``rows`` at i, ``columns`` at j, or ``both`` at i and j.

    A short product leaves out what is surely further apart; all others are measured by differences.
    """
    top = a.top + b.top
    for kind in (np.float32, np.float64):
        # Short numbers where none of them overflows or vanishes.
        if kind is np.float32 and not 1e-30 < top < 1e30:
            continue
        eps = float(np.finfo(kind).eps)
        doubt = (a.vectors.shape[1] + 8) * eps * 2 * top
        def reach(limit: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore"):
                return (limit * limit * (1 + 4 * eps) + doubt).astype(kind)

        left, right = a.left(kind), b.right(kind)
        by_row, by_column = reach(rows)[:, None], None if columns is None else reach(columns)
        found = []
        for start in range(0, len(left), SLICE):
            part = slice(start, start + SLICE)
            squared = left[part] @ right
            near = squared <= by_row[part]
            if by_column is not None:
                near |= squared <= by_column
            if both is not None:
                near |= squared <= reach(both[part])
            found.append(_true(near) + start * len(b.vectors))
        at = np.concatenate(found) if found else np.zeros(0, np.int64)
        if len(at) <= len(a.vectors) * len(b.vectors) // 32:
            break
    i, j = np.divmod(at, max(1, len(b.vectors)))
    far = apart(a.vectors, b.vectors, i, j)
    limit = rows[i]
    if columns is not None:
        limit = np.maximum(limit, columns[j])
    if both is not None:
        limit = np.maximum(limit, both[i, j])
    near = far <= limit
    return i[near], j[near], far[near]


def numbered_points(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(number, name, node, n, v): the distinct vectors, numbered in the order of their smallest keys."""
    points = distinct_points(df, key, vector).orderBy("node")
    return cut_lineage(points.select(F.monotonically_increasing_id().alias("number"), "name", "node", "n", "v"))


def point_blocks(points: DataFrame, pivots: int, size: int) -> DataFrame:
    """Blocks of about ``size`` points with one nearest pivot and similar distances to it, and their distances to all pivots."""
    rows = points.orderBy(F.md5(F.col("number").cast("string")), "number").limit(pivots).select("v").collect()
    if not rows:
        return points.sparkSession.createDataFrame([], _BLOCK)
    fixed = np.array([row["v"] for row in rows], dtype=float)

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                far = distances(np.stack(frame["v"].to_numpy()), fixed)
                cell = far.argmin(1)
                yield frame.assign(cell=cell, reach=far[np.arange(len(far)), cell], far=list(far))

    def gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held = TaskContext.get().partitionId() << 32, None

        def packed(frame: pd.DataFrame, number: int) -> pd.DataFrame:
            far = np.stack(frame["far"].to_numpy())
            return pd.DataFrame(
                {
                    "block": [number],
                    "numbers": [frame["number"].to_numpy(np.int64).tobytes()],
                    "counts": [frame["n"].to_numpy(np.int64).tobytes()],
                    "vectors": [np.stack(frame["v"].to_numpy()).astype(float).tobytes()],
                    "low": [far.min(0)],
                    "high": [far.max(0)],
                }
            )

        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            while len(held) >= size:
                yield packed(held.iloc[:size], block)
                block, held = block + 1, held.iloc[size:]
        if held is not None and len(held):
            yield packed(held, block)

    count = points.count()
    schema = "number long, n long, v array<double>, cell long, reach double, far array<double>"
    spread = points.select("number", "n", "v").mapInPandas(placed, schema)
    # Whole blocks in a partition; a few partitions more than needed, so that all cores take part.
    parts = max(1, -(-count // (4 * size)))
    ranged = spread.repartitionByRange(parts, "cell", "reach", "number")
    return cut_lineage(ranged.sortWithinPartitions("cell", "reach", "number").mapInPandas(gathered, _BLOCK))


def _opened(row, suffix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    numbers = np.frombuffer(getattr(row, f"numbers{suffix}"), np.int64)
    counts = np.frombuffer(getattr(row, f"counts{suffix}"), np.int64)
    return numbers, counts, np.frombuffer(getattr(row, f"vectors{suffix}")).reshape(len(numbers), -1)


def near_blocks(summaries: DataFrame) -> DataFrame:
    """(a, b, lower): pairs of blocks that may be as near as ``limit`` of a; ``lower`` bounds their distance.

    ``summaries`` is (block, low, high, floor, limit); no point of a block has a distance below ``floor``.
    """
    groups = max(1, -(-summaries.count() // SUMMARIES))
    entry = F.struct("block", "low", "high", "floor", "limit")
    grouped = summaries.groupBy(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("grp")).agg(
        F.collect_list(entry).alias("rows")
    )
    sent = grouped.select(
        F.col("rows").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp")
    )

    def columns(rows) -> tuple[np.ndarray, ...]:
        return tuple(np.array([row[name] for row in rows]) for name in ("block", "low", "high", "floor", "limit"))

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rows_a, rows_b in zip(frame["a"], frame["rows"]):
                a, low_a, high_a, floor_a, limit = columns(rows_a)
                b, low_b, high_b, floor_b, _ = columns(rows_b)
                for i in range(len(a)):
                    apart = np.maximum(low_a[i] - high_b, low_b - high_a[i]).max(1)
                    lower = np.maximum(np.maximum(apart, 0), np.maximum(floor_a[i], floor_b))
                    # A little room for rounding in the distances to the pivots.
                    near = np.nonzero(lower * (1 - 1e-9) <= limit[i])[0]
                    yield pd.DataFrame({"a": a[i], "b": b[near], "lower": lower[near]})

    return sent.join(grouped, "grp").mapInPandas(compared, "a long, b long, lower double")


def _kth(far: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The distance within which each row has ``k`` points; columns are in rising order."""
    enough = np.cumsum(counts, axis=1) >= k
    first = enough.argmax(1)
    found = far[np.arange(len(far)), first]
    return np.where(enough.any(1), found, np.inf)


class Nearest:
    """The least distances of a block's points that make ``k`` points, their counts and numbers, in rising order."""

    def __init__(self, row, k: int) -> None:
        self.k, (numbers, counts, vectors) = k, _opened(row)
        self.side = Side(vectors)
        far, n = distances(vectors, vectors), len(numbers)
        seen = np.tile(counts, (n, 1))
        own = np.arange(n)
        seen[own, own] -= 1  # of a point itself its other copies are near
        far[own, own] = np.where(counts > 1, 0.0, np.inf)
        part = np.argpartition(far, k - 1, axis=1)[:, :k] if n > k else np.tile(own, (n, 1))
        i, j = np.repeat(own, part.shape[1]), part.ravel()
        measured = np.where(i == j, far[i, j], apart(vectors, vectors, i, j))
        self.far = np.full((n, k), np.inf)
        self.counts, self.numbers = np.zeros((n, k), np.int64), np.full((n, k), -1)
        self._keep(i, measured, seen[i, j], numbers[j])

    def _keep(self, i: np.ndarray, far: np.ndarray, counts: np.ndarray, numbers: np.ndarray) -> None:
        order = np.lexsort((far, i))
        i, far, counts, numbers = i[order], far[order], counts[order], numbers[order]
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        place = np.arange(len(i)) - np.repeat(starts, np.diff(starts, append=len(i)))
        first = place < self.k
        at = i[first], place[first]
        self.far[at], self.counts[at], self.numbers[at] = far[first], counts[first], numbers[first]

    def reach(self) -> np.ndarray:
        return _kth(self.far, self.counts, self.k)

    def meet(self, other: Side, counts: np.ndarray, numbers: np.ndarray) -> None:
        i, j, far = close_pairs(self.side, other, self.reach())
        if len(i):
            rows = np.unique(i)
            self._keep(
                np.concatenate([np.repeat(rows, self.k), i]), np.concatenate([self.far[rows].ravel(), far]),
                np.concatenate([self.counts[rows].ravel(), counts[j]]),
                np.concatenate([self.numbers[rows].ravel(), numbers[j]]),
            )


def _block_groups(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(block, grp) and how many: neighbouring blocks make a group; groups as large as leave work for all cores."""
    cores_held, count = blocks.sparkSession.sparkContext.defaultParallelism, blocks.count()
    size = max(1, min(GROUP_BLOCKS, count // (3 * cores_held)))
    place = F.row_number().over(Window.orderBy("block")) - 1  # blocks are few; only their names are ordered
    return cut_lineage(blocks.select("block", F.floor(place / size).alias("grp"))), -(-count // size)


def _dealt(rows: DataFrame, groups: int) -> DataFrame:
    """Each group in a partition, as far as there are not too many."""
    parts = max(1, min(groups, 48 * rows.sparkSession.sparkContext.defaultParallelism))
    return rows.repartitionById(parts, F.pmod("grp", F.lit(parts)).cast("int"))


def with_core_distances(blocks: DataFrame, k: int) -> DataFrame:
    """Blocks with ``cores``, the distance of each point to its ``k``-th other one, copies counted, and the least of them.

    ``near`` are numbers of up to NEAR_EDGES near points of each point, -1 for none, and ``far`` their distances.
    """

    def bounded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                limit = float(Nearest(row, k).reach().max())
                yield pd.DataFrame({"block": [row.block], "floor": [0.0], "limit": [limit]})

    limits = blocks.mapInPandas(bounded, "block long, floor double, limit double")
    pairs = near_blocks(blocks.select("block", "low", "high").join(limits, "block"))
    groups, count = _block_groups(blocks)
    wanted = pairs.join(groups.withColumnRenamed("block", "a"), "a").groupBy("grp", "b").agg(
        F.collect_list("a").alias("a"), F.collect_list("lower").alias("lower"), F.min("lower").alias("_first"),
        F.bool_or(F.col("a") == F.col("b")).alias("own"),
    )
    sides = wanted.join(blocks.select(F.col("block").alias("b"), "numbers", "counts", "vectors"), "b")
    spread = _dealt(sides, count).sortWithinPartitions("grp", F.col("own").cast("int").desc(), "_first", "b")

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, best, waiting = None, {}, []

        def done() -> pd.DataFrame:
            cores = [held.reach() for held in best.values()]
            near = min(k, NEAR_EDGES)
            return pd.DataFrame(
                {
                    "block": list(best), "cores": [x.tobytes() for x in cores], "floor": [x.min() for x in cores],
                    "near": [held.numbers[:, :near].tobytes() for held in best.values()],
                    "far": [held.far[:, :near].tobytes() for held in best.values()],
                }
            )

        def met(row) -> None:
            numbers, counts, vectors = _opened(row)
            other = best[row.b].side if row.b in best else Side(vectors)
            for a, lower in zip(row.a, row.lower):
                if a != row.b and lower <= best[a].reach().max():
                    best[a].meet(other, counts, numbers)

        def met_own() -> None:
            for row in waiting:
                met(row)
            waiting.clear()

        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.grp != group:
                    if group is not None:
                        met_own()
                        yield done()
                    group, best = row.grp, {}
                if row.own:  # the group's own blocks come first, each with its own pair
                    best[row.b] = Nearest(row, k)
                    waiting.append(row)
                else:
                    met_own()
                    met(row)
        if group is not None:
            met_own()
            yield done()

    cores = spread.mapInPandas(measured, "block long, cores binary, floor double, near binary, far binary")
    return cut_lineage(blocks.join(cores, "block"))


def block_tree(weights: np.ndarray, numbers: np.ndarray) -> list[tuple[int, int]]:
    """The minimum spanning tree of a symmetric matrix, as places; equal weights go by the lesser number, then the greater."""
    n = len(numbers)
    if n < 2:
        return []
    outside = np.ones(n, bool)
    outside[0] = False
    best, source = weights[0].copy(), np.zeros(n, np.int64)
    low, high = np.minimum(numbers, numbers[0]), np.maximum(numbers, numbers[0])
    edges = []
    for _ in range(n - 1):
        least = np.where(outside, best, np.inf).min()
        ties = np.flatnonzero(outside & (best == least))
        new = int(ties[np.lexsort((high[ties], low[ties]))[0]]) if len(ties) > 1 else int(ties[0])
        edges.append((int(source[new]), new))
        outside[new] = False
        row, a, b = weights[new], np.minimum(numbers, numbers[new]), np.maximum(numbers, numbers[new])
        nearer = outside & ((row < best) | ((row == best) & ((a < low) | ((a == low) & (b < high)))))
        best[nearer], source[nearer], low[nearer], high[nearer] = row[nearer], new, a[nearer], b[nearer]
    return edges


def _proposed(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(a, b, w, i, j): for each pair of blocks the edges between them in the spanning tree of both, i < j."""
    columns = ("numbers", "counts", "vectors", "cores")
    side_a = blocks.select(F.col("block").alias("a"), *[F.col(name).alias(f"{name}_a") for name in columns])
    side_b = blocks.select(F.col("block").alias("b"), *[F.col(name).alias(f"{name}_b") for name in columns])

    def spanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                numbers, _, vectors = _opened(row, "_a")
                cores, own = np.frombuffer(row.cores_a), len(numbers)
                if row.a != row.b:
                    more, _, others = _opened(row, "_b")
                    numbers, vectors = np.concatenate([numbers, more]), np.concatenate([vectors, others])
                    cores = np.concatenate([cores, np.frombuffer(row.cores_b)])
                weights = distances(vectors, vectors)
                least = np.maximum(cores[:, None], cores[None, :])
                # A product differs from a core distance, measured by differences, in the last digits.
                weights = np.where(weights <= least * (1 + 1e-12), least, weights)
                weights = np.minimum(weights, weights.T)  # the same in both directions, also in the last digit
                edges = block_tree(weights, numbers)
                if row.a != row.b:
                    edges = [(x, y) for x, y in edges if (x < own) != (y < own)]
                if edges:
                    x, y = np.array(edges).T
                    yield pd.DataFrame(
                        {
                            "a": row.a, "b": row.b, "w": weights[x, y],
                            "i": np.minimum(numbers[x], numbers[y]), "j": np.maximum(numbers[x], numbers[y]),
                        }
                    )

    return pairs.join(side_a, "a").join(side_b, "b").mapInPandas(spanned, "a long, b long, w double, i long, j long")


def opened_points(blocks: DataFrame) -> DataFrame:
    """(number, n, core) of every point of blocks with core distances."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                numbers, counts, _ = _opened(row)
                yield pd.DataFrame({"number": numbers, "n": counts, "core": np.frombuffer(row.cores)})

    return blocks.mapInPandas(run, "number long, n long, core double")


def near_edges(blocks: DataFrame) -> DataFrame:
    """(w, i, j): the edges from every point to its ``near`` ones."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                numbers = _opened(row)[0]
                near = np.frombuffer(row.near, np.int64).reshape(len(numbers), -1)
                at, place = np.nonzero((near >= 0) & (near != numbers[:, None]))
                far = np.maximum(np.frombuffer(row.far).reshape(near.shape)[at, place], np.frombuffer(row.cores)[at])
                yield pd.DataFrame({"number": near[at, place], "other": numbers[at], "w": far})

    ends = blocks.mapInPandas(run, "number long, other long, w double")
    edges = ends.join(opened_points(blocks).select("number", "core"), "number").select(
        F.greatest("w", "core").alias("w"), F.least("number", "other").alias("i"), F.greatest("number", "other").alias("j")
    )
    return edges.dropDuplicates(["i", "j"])


def cluster_levels(joins: list[tuple[int, int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """(clusters, level): from when on two clusters are in one. ``joins`` are (cluster, the one it joins, w)."""
    names = np.array(sorted({name for i, into, _ in joins for name in (i, into)}), np.int64)
    place = {int(name): at for at, name in enumerate(names)}
    level, held = np.zeros((max(1, len(names)),) * 2), {}
    for i, into, w in sorted(joins, key=lambda join: join[1]):
        own, new = [*held.pop(i, []), place[i]], held.setdefault(into, [])
        for one, two in ((own, [*new, place[into]]), ([*new, place[into]], own)):
            level[np.ix_(one, two)] = w
        new += own
    return names, level


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the edges (x, y) between ``n`` places, in their order, join what those before them do not."""
    labels, kept, at = np.arange(n), np.zeros(len(x), bool), np.arange(len(x))
    while True:
        at = at[labels[x[at]] != labels[y[at]]]
        if not len(at):
            return np.flatnonzero(kept)
        first = np.full(n, len(x))
        np.minimum.at(first, labels[x[at]], at)
        np.minimum.at(first, labels[y[at]], at)
        chosen = np.unique(first[first < len(x)])
        kept[chosen] = True
        labels = _hooked(labels, x[chosen], y[chosen])


class Bounded:
    """A block with the level from which on each point is in its cluster."""

    def __init__(self, row, names: np.ndarray) -> None:
        self.numbers, _, vectors = _opened(row)
        self.side, self.cores, self.levels = Side(vectors), np.frombuffer(row.cores), np.frombuffer(row.levels)
        clusters = np.frombuffer(row.clusters, np.int64)
        self.places = np.minimum(np.searchsorted(names, clusters), max(0, len(names) - 1))

    def crossing(self, other: Bounded, level: np.ndarray, lower: float) -> pd.DataFrame | None:
        """Edges to another block that are no longer than needed to have both ends together."""
        own, others = np.unique(self.places), np.unique(other.places)
        between = level[np.ix_(own, others)]
        top = max(between.max(), self.levels.max(), other.levels.max())
        if lower * (1 - 1e-9) > top:
            return None
        # A little room, since distances by products and by differences are not the same in the last digits.
        room = 1 + 1e-9
        rows, columns, both = self.levels * room, other.levels * room, None
        if between.min() == between.max():
            rows = np.maximum(rows, between[0, 0] * room)
        else:
            both = level[np.ix_(self.places, other.places)] * room
        i, j, far = close_pairs(self.side, other.side, rows, columns, both)
        w = np.maximum(far, np.maximum(self.cores[i], other.cores[j]))
        near = w <= np.maximum(np.maximum(rows[i], columns[j]), 0.0 if both is None else both[i, j])
        i, j, w = i[near], j[near], w[near]
        low, high = np.minimum(self.numbers[i], other.numbers[j]), np.maximum(self.numbers[i], other.numbers[j])
        if len(w) > len(self.numbers) + len(other.numbers):
            order = np.lexsort((high, low, w))
            kept = order[forest(len(self.numbers) + len(other.numbers), i[order], len(self.numbers) + j[order])]
            low, high, w = low[kept], high[kept], w[kept]
        return pd.DataFrame({"w": w, "i": low, "j": high}) if len(w) else None


def _levelled(blocks: DataFrame, falls: DataFrame, highest: float) -> DataFrame:
    """Blocks with ``levels`` and ``clusters``: when each point falls into which cluster; ``highest`` and -1 if into none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                numbers = _opened(row)[0]
                yield pd.DataFrame({"block": row.block, "place": np.arange(len(numbers)), "number": numbers})

    named = blocks.mapInPandas(run, "block long, place long, number long")
    entry = F.struct("place", F.coalesce("w", F.lit(highest)).alias("w"), F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    listed = named.join(falls.select("number", "cluster", "w"), "number", "left").groupBy("block").agg(
        F.sort_array(F.collect_list(entry)).alias("e")
    )

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                {
                    "block": frame["block"],
                    "levels": [np.asarray(x, float).tobytes() for x in frame["w"]],
                    "clusters": [np.asarray(x, np.int64).tobytes() for x in frame["cluster"]],
                }
            )

    flat = listed.select("block", F.col("e.w").alias("w"), F.col("e.cluster").alias("cluster"))
    return blocks.join(flat.mapInPandas(packed, "block long, levels binary, clusters binary"), "block")


def candidate_edges(points: DataFrame, blocks: DataFrame, chunk: int = CHUNK_EDGES) -> DataFrame:
    """(w, i, j): edges among which all of the minimum spanning tree are. ``blocks`` of ``points`` have core distances."""
    order = Window.orderBy("block")  # blocks are few; only their names are ordered
    chain = blocks.select(F.col("block").alias("a"), F.lead("block").over(order).alias("b"))
    chain = cut_lineage(chain)
    first = chain.select("a", F.col("a").alias("b")).unionByName(chain.filter("b IS NOT NULL"))
    # Blocks' own trees and those of the chain span everything.
    spanning = _proposed(first, blocks).select("w", "i", "j").unionByName(near_edges(blocks))
    total = points.agg(F.sum("n")).first()[0] or 0
    tree, falls, joined = _linked(points, blocks, cut_lineage(spanning), max(2, -(-total // KNOWN_CLUSTERS)), chunk)
    known = cut_lineage(tree.select("w", "i", "j"))
    longest = known.agg(F.max("w")).first()[0] or 0.0
    names, level = cluster_levels([tuple(row) for row in joined.select("i", "cluster", "w").collect()])
    bounded = cut_lineage(_levelled(blocks, falls, float(longest)))

    summaries = blocks.select("block", "low", "high", "floor").withColumn("limit", F.lit(float(longest)))
    groups, count = _block_groups(blocks)
    grp_a = groups.select(F.col("block").alias("a"), "grp")
    grp_b = groups.select(F.col("block").alias("b"), F.col("grp").alias("_grp"))
    # Two groups meet in one of them, which is the lower one as often as the upper one.
    here = (F.col("grp") < F.col("_grp")) == ((F.col("grp") + F.col("_grp")) % 2 == 0)
    met = F.when(F.col("grp") == F.col("_grp"), F.col("a") <= F.col("b")).otherwise(here)
    others = near_blocks(summaries).join(chain.filter("b IS NOT NULL"), ["a", "b"], "left_anti")
    wanted = others.join(grp_a, "a").join(grp_b, "b").filter(met).groupBy("grp", "b").agg(
        F.collect_list("a").alias("a"), F.collect_list("lower").alias("lower"),
        F.bool_or(F.col("grp") == F.col("_grp")).alias("own"),
    )
    columns = ("numbers", "counts", "vectors", "cores", "levels", "clusters")
    sides = wanted.join(bounded.select(F.col("block").alias("b"), *columns), "b")
    spread = _dealt(sides, count).sortWithinPartitions("grp", F.col("own").cast("int").desc(), "b")

    def crossed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held = None, {}
        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.grp != group:
                    group, held = row.grp, {}
                other = Bounded(row, names)
                if row.own:  # the group's own blocks come first, by their names
                    held[row.b] = other
                for a, lower in zip(row.a, row.lower):
                    found = held[a].crossing(other, level, lower) if a != row.b else None
                    if found is not None:
                        yield found

    return known.unionByName(spread.mapInPandas(crossed, "w double, i long, j long"))


_ROWS = "kind int, i long, j long, size long, cluster long, w double"
_EDGE, _FALL, _JOIN, _LABEL = range(4)


def join_edges(rows: pd.DataFrame, min_cluster_size: int, first_cluster: int) -> pd.DataFrame:
    """Joins components along edges in the order of their length.

    ``rows`` are edges (w, i, j) with the component, size and cluster (-1: still too small) of both ends; an edge from a
    point to itself says from when on its copies are together. The result has the edges of the tree (i, j, w), components
    that fall into a cluster (i, cluster, w), clusters that a new one takes in (i, cluster, size, w), and what every
    component has become part of (i, j, size, cluster).
    """
    order = np.lexsort((rows["j"], rows["i"], rows["i"] != rows["j"], rows["w"]))
    parent: dict[int, int] = {}
    size: dict[int, int] = {}
    cluster: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    for side in "ij":
        for at, held, known in zip(rows[f"comp_{side}"].tolist(), rows[f"size_{side}"].tolist(), rows[f"cluster_{side}"].tolist()):
            if at not in parent:
                parent[at], size[at], cluster[at], members[at] = at, held, known, [at] if known < 0 else []
    out: list[tuple] = []

    def root(at: int) -> int:
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    def fall(at: int, into: int, w: float) -> None:
        out.extend((_FALL, member, None, None, into, w) for member in members.pop(at, ()))

    columns = [rows[name].to_numpy()[order].tolist() for name in ("w", "i", "j", "comp_i", "comp_j")]
    for w, i, j, comp_i, comp_j in zip(*columns):
        x, y = root(comp_i), root(comp_j)
        if i == j:
            if cluster[x] < 0:
                cluster[x] = first_cluster
                first_cluster += 1
                fall(x, cluster[x], w)
            continue
        if x == y:
            continue
        out.append((_EDGE, i, j, None, None, w))
        if size[x] < size[y]:
            x, y = y, x
        if cluster[x] >= 0 and cluster[y] >= 0:
            out.extend((_JOIN, cluster[side], None, size[side], first_cluster, w) for side in (x, y))
            cluster[x] = first_cluster
            first_cluster += 1
        elif cluster[x] >= 0 or cluster[y] >= 0 or size[x] + size[y] >= min_cluster_size:
            into = max(cluster[x], cluster[y])
            if into < 0:
                into, first_cluster = first_cluster, first_cluster + 1
            for side in (x, y):
                fall(side, into, w)
            cluster[x] = into
        else:
            members[x] += members.pop(y)
        parent[y] = x
        size[x] += size[y]
    for at in parent:
        top = root(at)
        out.append((_LABEL, at, top, size[top], cluster[top], None))
    names = ["kind", "i", "j", "size", "cluster", "w"]
    frame = pd.DataFrame(out, columns=names)
    return frame.astype({"kind": "int32", "i": "Int64", "j": "Int64", "size": "Int64", "cluster": "Int64", "w": "float64"})


def _joined(min_cluster_size: int, first_cluster: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return join_edges(rows, min_cluster_size, first_cluster)

    return run


def _chunked(edges: DataFrame, chunk: int) -> tuple[DataFrame, int]:
    """Edges with the number of their ``chunk`` in the order of their length, and how many there are."""
    count = edges.count()
    parts = max(1, -(-count // chunk))
    place = F.struct("w", (F.col("i") != F.col("j")).alias("apart"), "i", "j")
    if parts == 1:
        return edges.withColumn("chunk", F.lit(0)), 1
    # Cuts from a sample of a fixed share: sixty-four edges of each chunk.
    share = F.pmod(F.xxhash64("i", "j"), F.lit(max(1, count // (64 * parts)))) == 0
    sample = sorted(tuple(row[0]) for row in edges.filter(share).select(place).collect())
    cuts = [sample[len(sample) * at // parts] for at in range(1, parts)] if sample else []
    kinds = ("double", "boolean", "long", "long")
    bounds = [F.struct(*[F.lit(x).cast(kind) for x, kind in zip(cut, kinds)]) for cut in sorted(set(cuts))]
    number = sum(((place >= bound).cast("int") for bound in bounds), F.lit(0))
    return edges.withColumn("chunk", number), len(bounds) + 1


def core_distances(points: DataFrame, min_samples: int) -> DataFrame:
    """The blocks of ``numbered_points`` with the distance of each point to its ``min_samples``-th other one.

    With fewer other points than that it is the distance to the furthest.
    """
    rows = points.agg(F.sum("n")).first()[0] or 0
    return with_core_distances(point_blocks(points, PIVOTS, BLOCK_POINTS), max(1, min(min_samples, rows - 1)))


def linkage(
    points: DataFrame, min_samples: int, min_cluster_size: int, chunk: int = CHUNK_EDGES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tree, falls, joins) of ``numbered_points``.

    The minimum spanning tree (i, j, w), by numbers; at which distance each point falls into which cluster (number, n,
    cluster, w); and which clusters a new one takes in (i, cluster, size, w). A cluster's number is above those it took in.
    """
    blocks = core_distances(points, min_samples)
    return _linked(points, blocks, candidate_edges(points, blocks, chunk), min_cluster_size, chunk)


def _linked(
    points: DataFrame, blocks: DataFrame, edges: DataFrame, min_cluster_size: int, chunk: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tree, falls, joins) of the hierarchy that ``edges`` make."""
    many = opened_points(blocks).filter(F.col("n") >= min_cluster_size)
    heavy = many.select(F.col("core").alias("w"), F.col("number").alias("i"), F.col("number").alias("j"))
    dealt, chunks = _chunked(cut_lineage(edges.unionByName(heavy)), chunk)
    labels = points.select("number", F.col("number").alias("comp"), F.col("n").alias("size"), F.lit(-1).cast("long").alias("cluster"))
    done: list[DataFrame] = []
    falls: list[DataFrame] = []
    for at in range(chunks):
        sides = [
            labels.select(F.col("number").alias(end), *[F.col(name).alias(f"{name}_{end}") for name in ("comp", "size", "cluster")])
            for end in "ij"
        ]
        part = dealt.filter(F.col("chunk") == at).drop("chunk").join(sides[0], "i").join(sides[1], "j")
        part = part.filter((F.col("comp_i") != F.col("comp_j")) | (F.col("i") == F.col("j")))
        # The chunk is one group, of bounded size.
        found = cut_lineage(part.groupBy(F.lit(at).alias("at")).applyInPandas(_joined(min_cluster_size, at << 40), _ROWS))
        done.append(found.filter(F.col("kind") != _LABEL))
        fallen = found.filter(F.col("kind") == _FALL).select(F.col("i").alias("comp"), F.col("cluster").alias("_into"), "w")
        falls.append(labels.join(fallen, "comp").select("number", F.col("_into").alias("cluster"), "w"))
        moved = found.filter(F.col("kind") == _LABEL).select(
            F.col("i").alias("comp"), F.col("j").alias("_comp"), F.col("size").alias("_size"), F.col("cluster").alias("_cluster")
        )
        following = labels.join(moved, "comp", "left").select(
            "number", F.coalesce("_comp", "comp").alias("comp"), F.coalesce("_size", "size").alias("size"),
            F.coalesce("_cluster", "cluster").alias("cluster"),
        )
        labels = cut_lineage(following) if at + 1 < chunks else following
    rows, fell = done[0], falls[0]
    for other, more in zip(done[1:], falls[1:]):
        rows, fell = rows.unionByName(other), fell.unionByName(more)
    tree = rows.filter(F.col("kind") == _EDGE).select("i", "j", "w")
    joins = rows.filter(F.col("kind") == _JOIN).select("i", "cluster", "size", "w")
    return tree, cut_lineage(fell.join(points.select("number", "n"), "number")), joins


def stable_clusters(falls: DataFrame, joins: DataFrame, allow_single: bool = False) -> DataFrame:
    """(cluster, chosen, death): the chosen cluster each one belongs to, or null, and the density where it ends.

    A cluster's stability is how long, in density, its points stay in it. It is chosen if that is no less than the sum of
    the stabilities of what is chosen within it; the whole is only chosen if ``allow_single``.
    """
    density = 1 / F.greatest("w", F.lit(LEAST_DISTANCE))
    leaving = falls.select("cluster", F.col("n").alias("size"), density.alias("density"))
    splitting = joins.select("cluster", "size", density.alias("density"))
    held = leaving.unionByName(splitting).groupBy("cluster").agg(
        F.sum(F.col("size") * F.col("density")).alias("total"), F.sum("size").alias("size"), F.max("density").alias("death")
    )
    above = joins.select(F.col("i").alias("cluster"), F.col("cluster").alias("parent"), density.alias("birth"))
    table = held.join(above, "cluster", "left").select(
        "cluster", "parent", "death", (F.col("total") - F.col("size") * F.coalesce("birth", F.lit(0.0))).alias("stability")
    )

    def chosen(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cluster", ignore_index=True)
        names = rows["cluster"].tolist()
        parents = [None if pd.isna(x) else int(x) for x in rows["parent"]]
        own, inner = dict(zip(names, rows["stability"].tolist())), dict.fromkeys(names, 0.0)
        best = {}
        for name, parent in zip(names, parents):  # what a cluster took in comes before it
            best[name] = own[name] >= inner[name] and (allow_single or parent is not None)
            if parent is not None:
                inner[parent] += own[name] if best[name] else inner[name]
        label: dict[int, int | None] = {}
        for name, parent in zip(reversed(names), reversed(parents)):
            outer = None if parent is None else label[parent]
            label[name] = outer if outer is not None else (name if best[name] else None)
        result = pd.DataFrame({"cluster": names, "chosen": pd.array([label[name] for name in names], "Int64")})
        return result.assign(death=rows["death"])

    return table.groupBy(F.lit(0).alias("one")).applyInPandas(chosen, "cluster long, chosen long, death double")


def hierarchical_clusters(
    df: DataFrame,
    key: str,
    vector: str,
    min_cluster_size: int = 15,
    min_samples: int | None = None,
    output: str = "cluster",
    probability: str | None = None,
    allow_single: bool = False,
) -> DataFrame:
    """Density clusters of any densities, noise = -1, by Euclidean distance over all coordinates.

    ``min_samples`` (default ``min_cluster_size``) is the number of other points that a core distance reaches. Clusters are
    those of the greatest stability, numbered from 0 by falling size. ``probability`` names a column for how early, in
    density, a row fell out of its cluster, 0 for noise. Edges of equal length are joined in the order of their smaller, then
    their greater key. Copies of a vector are counted, not compared. Vectors that are null or hold null or non-finite
    numbers are noise; all others have one length. Fewer than ``min_cluster_size`` rows are noise.
    """
    points = numbered_points(df, key, vector)
    _, falls, joins = linkage(points, min_samples or min_cluster_size, min_cluster_size)
    clusters = cut_lineage(stable_clusters(falls, joins, allow_single))
    ends = clusters.select(F.col("cluster").alias("chosen"), F.col("death").alias("_end"))
    # A cluster may hold a third of all points: what is joined to them is handed out under every salt.
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    into = clusters.filter("chosen IS NOT NULL").select("cluster", "chosen").join(ends, "chosen").withColumn("_salt", copies)
    salted = falls.withColumn("_salt", F.pmod(F.xxhash64("number"), F.lit(SALTS)))
    placed = salted.join(into, ["cluster", "_salt"]).select(
        "number", "n", "chosen", F.least(1 / F.greatest("w", F.lit(LEAST_DISTANCE)), F.col("_end")).alias("_at"), "_end"
    )
    placed = cut_lineage(placed.withColumn("_strength", F.col("_at") / F.col("_end")))
    sizes = placed.groupBy("chosen").agg(F.sum("n").alias("size"), F.min("number").alias("component"))
    numbers = sizes.select("chosen", "component").join(_numbered(sizes.select("component", "size")), "component")
    numbers = numbers.select("chosen", F.col("cluster").alias(output)).withColumn("_salt", copies)
    member = placed.withColumn("_salt", F.pmod(F.xxhash64("number"), F.lit(SALTS))).join(numbers, ["chosen", "_salt"])
    named = member.join(points.select("number", "name"), "number").select(
        F.col("name").alias("_name"), output, "_strength"
    )
    labels = named.withColumn("_salt", copies)
    rows = df.withColumns({"_name": _vector_name(vector), "_salt": F.pmod(F.xxhash64(key), F.lit(SALTS))})
    found = rows.join(labels, ["_name", "_salt"], "left").withColumn(output, F.coalesce(F.col(output), F.lit(-1)))
    if probability is None:
        return found.select(*df.columns, output)
    return found.withColumn(probability, F.coalesce("_strength", F.lit(0.0))).select(*df.columns, output, probability)

"""Removal of word windows that an earlier document has, by compaction of a De Bruijn graph.

The graph's edges are the windows of WINDOW words, its nodes the runs of one word less that windows share. Texts lie in
buckets of shards, which never move again. Only windows that other documents can have become edges: equal windows have
equal anchors, the least hash of their RUN-word runs, and the anchors' marks are counted over all shards.

A shard compacts first what it sees itself: a path goes on through a node as long as every visit comes from one node and goes
on to one node. Equal paths of all shards become one, and a join by node finds where any of them branches, begins or ends.
There the paths are cut, so that each piece, a compacted nonbranching path, is walked as a whole wherever one of its windows
occurs. At its source coordinates a piece is read again and named by the digest of its words, so that no hash decides
what is equal; the least document of each digest goes back to the shards, which drop the words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import bucketed, document_shards, opened, salted_join, shuffle_parts, written

WINDOW, RUN = 50, 16
SHARD = 4 << 20
#: Bytes of texts whose anchors one task counts.
BUCKET = 256 << 20
#: Paths that become rows at a time, in nodes.
NODES = 1 << 18
_LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15


def _mixed(values: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(31))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words, by doubling the runs along the binary digits of ``length``."""
    made = words.copy()
    size = 1
    for digit in bin(length)[3:]:
        n = max(0, len(made) - size)
        made = made[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + made[size : size + n]
        size *= 2
        if digit == "1":
            n = max(0, len(made) - 1)
            made = made[:n] * np.uint64(_BASE) + words[size : size + n]
            size += 1
    return made


def least_of(values: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` values in a row."""
    reach, n = 1, max(0, len(values) - span + 1)
    while 2 * reach <= span:
        values, reach = np.minimum(values[: len(values) - reach], values[reach:]), 2 * reach
    return np.minimum(values[:n], values[span - reach :][:n])


class _Texts:
    """A shard's documents as words, and where its windows begin."""

    def __init__(self, row: dict, window: int) -> None:
        lengths = np.array(row["lengths"], np.int64)
        data, ends = opened(row["data"], lengths)
        whole = data.tobytes()
        self.window = window
        self.ids = [None if i is None or i != i else int(i) for i in row["ids"]]
        self.words: list[bytes] = []
        sizes = []
        for a, b in zip((ends - lengths).tolist(), ends.tolist()):
            found = whole[a:b].split()
            sizes.append(len(found))
            self.words += found
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.owners = np.array([_LAST if i is None else i for i in self.ids], np.int64)
        self.document = np.repeat(np.arange(len(sizes)), self.sizes)
        at = np.arange(max(0, len(self.words) - window + 1))
        self.at = at[at + window <= self.ends[self.document[at]]]

    def hashes(self) -> np.ndarray:
        number: dict[bytes, int] = {}
        flat = np.fromiter((number.setdefault(word, len(number)) for word in self.words), np.int32, len(self.words))
        return np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))[flat]

    def anchors(self, hashes: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, anchor) of every run of windows of one document with one anchor, as places in ``at``."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        run = min(run, self.window)
        anchor = least_of(_mixed(run_hashes(hashes, run)), self.window - run + 1)[self.at]
        document = self.document[self.at]
        begins = np.ones(len(anchor), bool)
        begins[1:] = (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])
        first = np.flatnonzero(begins)
        return first, anchor[first]


def _marks(shards: DataFrame, parts: int, window: int, run: int) -> DataFrame:
    """(bucket, shard, marks): a shard's anchors as 32 bits each, twice if two of its documents have one."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = _Texts(row, window)
                first, anchor = texts.anchors(texts.hashes(), run)
                pairs = np.unique(np.stack([anchor, texts.document[texts.at[first]].astype(np.uint64)], axis=1), axis=0)
                names, counts = np.unique(pairs[:, 0], return_counts=True)
                names = np.sort(np.concatenate([names, names[counts > 1]]))
                bucket = (names % np.uint64(parts)).astype(np.int64)
                names = (names >> np.uint64(32)).astype("<u4")[np.argsort(bucket, kind="stable")]
                present, begin = np.unique(np.sort(bucket), return_index=True)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(present, pa.int32()),
                    "shard": pa.array([row["shard"]] * len(present), pa.int64()),
                    "marks": pa.array([m.tobytes() for m in np.split(names, begin[1:])] if len(present) else [], pa.binary()),
                })

    return shards.select("shard", "ids", "lengths", "data").mapInArrow(deal, "bucket int, shard long, marks binary")


def _shared(marks: DataFrame, parts: int) -> DataFrame:
    """(shard, bucket, marks): those of a shard's marks that its bucket has twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        for batch in batches:
            for bucket, shard, own in zip(*(column.to_pylist() for column in batch.columns)):
                held.setdefault(bucket, []).append((shard, np.frombuffer(own, "<u4")))
        for bucket, rows in held.items():
            _, place, counts = np.unique(np.concatenate([own for _, own in rows]), return_inverse=True, return_counts=True)
            several, at = counts[place] > 1, 0
            for shard, own in rows:
                found = own[several[at : at + len(own)]]
                at += len(own)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int64()), "bucket": pa.array([bucket], pa.int32()),
                    "marks": pa.array([found.tobytes()], pa.binary()),
                })

    return marks.repartitionById(parts, "bucket").mapInArrow(run, "shard long, bucket int, marks binary")


def local_paths(at: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of the paths that the windows beginning at the words ``at`` walk, cut where these branch or end.

    ``nodes`` has the node that begins at every word; the window at a word leads from its node to the next one's.
    """
    if not len(at):
        return at, at
    source, target = nodes[at], nodes[at + 1]
    on = np.append(at[1:] == at[:-1] + 1, False)  # the walk goes on to the next window
    inner = np.flatnonzero(on)
    visits = np.stack([target[inner], source[inner], target[inner + 1]], axis=1)
    visits = np.unique(visits, axis=0)  # (node, before, after)
    several = visits[1:, 0][visits[1:, 0] == visits[:-1, 0]]
    begins = np.append(True, ~on[:-1])
    cut = np.unique(np.concatenate([several, source[begins], target[~on]]))
    begins |= np.isin(source, cut)
    first = np.flatnonzero(begins)
    return first, np.diff(np.append(first, len(at)))


_PATHS = "shard long, low long, high long, nodes binary, places binary"


def _paths(shards: DataFrame, shared: DataFrame, parts: int, window: int, run: int) -> DataFrame:
    """A shard's distinct paths: their name, the nodes in order, and at which of the shard's words they begin."""

    def walk(key: tuple, rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        out = {name.split()[0]: [] for name in _PATHS.split(", ")}
        if len(rows) and len(marks):
            texts = _Texts(rows.iloc[0].to_dict(), window)
            hashes = texts.hashes()
            first, anchor = texts.anchors(hashes, run)
            wanted = np.concatenate([
                np.frombuffer(own, "<u4").astype(np.uint64) | np.uint64(bucket) << np.uint64(32)
                for bucket, own in zip(marks["bucket"], marks["marks"])
            ])
            name = anchor >> np.uint64(32) | (anchor % np.uint64(parts)) << np.uint64(32)
            counts = np.diff(np.append(first, len(texts.at)))
            at = texts.at[np.repeat(np.isin(name, wanted), counts)]
            nodes = _mixed(run_hashes(hashes, window - 1))
            first, length = local_paths(at, nodes)
            # Within a shard a path is known by its first window.
            _, place, number = np.unique(
                np.stack([nodes[at[first]], nodes[at[first] + 1]], axis=1), axis=0, return_index=True, return_inverse=True
            )
            order = np.argsort(number, kind="stable")
            groups = np.split(at[first][order], np.cumsum(np.bincount(number))[:-1]) if len(first) else []
            for begin, size, words in zip(at[first][place].tolist(), length[place].tolist(), groups):
                walked = nodes[begin : begin + size + 1].tobytes()
                low, high = np.frombuffer(xxhash.xxh3_128_digest(walked), "<i8").tolist()
                for column, value in zip(out.values(), (key[0], low, high, walked, words.astype("<i8").tobytes())):
                    column.append(value)
        return pd.DataFrame(out)

    return shards.groupBy("shard").cogroup(shared.groupBy("shard")).applyInPandas(walk, _PATHS)


def _visits(paths: DataFrame) -> DataFrame:
    """(node, link, low, high): every visit of a path to a node; ``link`` names the nodes before and after, if it has both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(group: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            sizes = np.array([len(nodes) for _, _, nodes in group])
            node = np.concatenate([nodes for _, _, nodes in group])
            ends = np.cumsum(sizes)
            outer = np.zeros(len(node), bool)
            outer[ends - 1] = outer[ends - sizes] = True
            link = np.zeros(len(node), np.uint64)
            link[1:-1] = _mixed(node[:-2] * np.uint64(3) + _mixed(node[2:]))
            return pa.RecordBatch.from_pydict({
                "node": pa.array(node.view(np.int64)),
                "link": pa.array(link.view(np.int64), mask=outer),
                "low": pa.array(np.repeat([low for low, _, _ in group], sizes)),
                "high": pa.array(np.repeat([high for _, high, _ in group], sizes)),
            })

        group, held = [], 0
        for batch in batches:
            for low, high, nodes in zip(*(column.to_pylist() for column in batch.columns)):
                group.append((low, high, np.frombuffer(nodes, "<u8")))
                held += len(group[-1][2])
                if held >= NODES:
                    yield rows(group)
                    group, held = [], 0
        if group:
            yield rows(group)

    return paths.select("low", "high", "nodes").mapInArrow(run, "node long, link long, low long, high long")


def _cuts(paths: DataFrame) -> DataFrame:
    """(low, high, cuts): the inner nodes at which a path is not the only way through.

    A node is passed by one way alone if no path begins or ends there and all have the same node before and after.
    """
    distinct = paths.select("low", "high", "nodes").dropDuplicates(["low", "high"])
    node = Window.partitionBy("node")
    visits = _visits(distinct).select(
        "link", "low", "high", "node", F.min("link").over(node).alias("least"), F.max("link").over(node).alias("most"),
        (F.count("link").over(node) < F.count(F.lit(1)).over(node)).alias("outer"),
    )
    branching = visits.filter(F.col("link").isNotNull() & (F.col("outer") | (F.col("least") != F.col("most"))))
    return branching.groupBy("low", "high").agg(F.collect_set("node").alias("cuts"))


_PIECES = "shard long, digest binary, least long, most long, places binary, windows int"


def _pieces(shards: DataFrame, paths: DataFrame, window: int) -> DataFrame:
    """A shard's distinct pieces: the digest of their words, their least and last document, and where they are."""

    def run(key: tuple, rows: pd.DataFrame, walked: pd.DataFrame) -> pd.DataFrame:
        out = {name.split()[0]: [] for name in _PIECES.split(", ")}
        if len(rows) and len(walked):
            texts = _Texts(rows.iloc[0].to_dict(), window)
            found: dict[bytes, tuple[int, list[int]]] = {}
            for nodes, cuts, places in zip(walked["nodes"], walked["cuts"], walked["places"]):
                node = np.frombuffer(nodes, "<i8")
                inner = np.isin(node[1:-1], cuts) if cuts is not None else np.zeros(len(node) - 2, bool)
                edges = np.concatenate([[0], np.flatnonzero(inner) + 1, [len(node) - 1]]).tolist()
                for place in np.frombuffer(places, "<i8").tolist():
                    for a, b in zip(edges, edges[1:]):
                        words = texts.words[place + a : place + b + window - 1]
                        digest = hashlib.sha256(b" ".join(words)).digest()
                        found.setdefault(digest, (b - a, []))[1].append(place + a)
            for digest, (size, places) in found.items():
                at = np.array(places, "<i8")
                owner = texts.owners[texts.document[at]]
                values = key[0], digest, int(owner.min()), int(owner.max()), at.tobytes(), size
                for column, value in zip(out.values(), values):
                    column.append(value)
        return pd.DataFrame(out)

    return shards.groupBy("shard").cogroup(paths.groupBy("shard")).applyInPandas(run, _PIECES)


def remove_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row's words, joined by one space, without those that earlier documents have.

    A word goes if a window of ``window`` words (two at least) over it also starts in a document with a smaller doc_id. Words
    are parted by ASCII white space. Null and empty texts have none. Documents without doc_id come after all others and
    don't remove each other's words, nor do rows with one doc_id. Rows stay as many as they are; an empty table gives an
    empty table, and no other columns are read. Two different words of one 64-bit hash could hide a repeat, never make one.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    parts = shuffle_parts(docs.sparkSession)
    shards = bucketed(document_shards(docs, shard).select("shard", "ids", "lengths", "data"), "shard", parts, "texts")
    size = shards.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x)).alias("size")).first()["size"]
    buckets = max(parts, -(-(size or 0) // BUCKET))
    shared = _shared(_marks(shards, buckets, window, run), buckets)
    paths = written(_paths(shards, shared, buckets, window, run), "paths")
    cut = salted_join(paths, _cuts(paths), ["low", "high"], "shard", how="left")
    pieces = written(_pieces(shards, cut.select("shard", "nodes", "cuts", "places"), window), "pieces")
    least = pieces.groupBy("digest").agg(F.min("least").alias("first"))
    late = salted_join(pieces, least, ["digest"], "shard").filter(F.col("most") > F.col("first"))

    def drop(_: tuple, rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        texts = _Texts(rows.iloc[0].to_dict(), window)
        change = np.zeros(len(texts.words) + 1, np.int64)
        for places, windows, first in zip(found["places"], found["windows"], found["first"]):
            at = np.frombuffer(places, "<i8")
            at = at[texts.owners[texts.document[at]] > first]
            np.add.at(change, at, 1)
            np.add.at(change, at + int(windows) + window - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        starts = texts.ends - texts.sizes
        n_removed = removed[texts.ends] - removed[starts]
        kept = []
        for a, b, n in zip(starts.tolist(), texts.ends.tolist(), n_removed.tolist()):
            words = texts.words[a:b]
            if n:
                words = [word for word, out in zip(words, gone[a:b].tolist()) if not out]
            kept.append(b" ".join(words))
        return pd.DataFrame(
            {"doc_id": pd.array(texts.ids, "Int64"), "n_words": texts.sizes, "n_removed": n_removed, "kept": kept}
        )

    schema = "doc_id long, n_words long, n_removed long, kept binary"
    return shards.groupBy("shard").cogroup(late.select("shard", "places", "windows", "first").groupBy("shard")).applyInPandas(drop, schema)

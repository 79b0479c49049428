"""Document fingerprints from closed syncmers.

A run of WIDTH bytes is a closed syncmer if the least hash of its inner runs of INNER bytes is that of the first or of
the last one. That depends on the run alone, so the same passage gives the same anchors in every text, and there is
one in every WIDTH - INNER + 1 neighbouring runs. A fingerprint keeps all of a text's closed syncmers, each with its
place; two fingerprints are alike as far as the anchors of both together are in both and in one order.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import by_size, identifier, range_cuts, shuffle_parts, utf8

INNER, WIDTH = 8, 16
_BASE = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1
#: Anchors and the bytes they start at, by anchor. An anchor is 32 bits of hash, and how often the text had it before.
Sketch = tuple[np.ndarray, np.ndarray]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def _doubled(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of runs of ``2 * length`` from those of ``length``."""
    return values[:-length] * np.uint64(pow(_BASE, length, 1 << 64)) + values[length:]


def _sketch(hashes: np.ndarray, places: np.ndarray) -> Sketch:
    """The sketch of a text's hashes, which come by place."""
    order = np.argsort(hashes, kind="stable")
    hashes, number = hashes[order], np.arange(len(hashes))
    begins = np.ones(len(hashes), bool)
    begins[1:] = hashes[1:] != hashes[:-1]
    earlier = number - np.maximum.accumulate(np.where(begins, number, 0))
    return hashes << np.uint64(32) | earlier.astype(np.uint64), places[order]


def sketches(texts: list[bytes]) -> list[Sketch]:
    """The sketch of each text. A text without a syncmer has itself as its only anchor, an empty one none."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(text) for text in texts])
    at, chosen = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) >= WIDTH:
        runs, length = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE), 1
        while length < INNER:
            runs, length = _doubled(runs, length), 2 * length
        inner, whole = _mixed(runs), _doubled(runs, INNER)
        edges, reach, least = WIDTH - INNER, 1, inner
        while 2 * reach <= edges + 1:
            least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
        if reach < edges + 1:
            least = np.minimum(least[: len(whole)], least[edges + 1 - reach :][: len(whole)])
        anchor = (inner[: len(whole)] == least) | (inner[edges:] == least)
        at = np.flatnonzero(anchor)
        chosen = _mixed(whole[at]) >> np.uint64(32)
    out, start = [], 0
    for text, end in zip(texts, ends.tolist()):
        a, b = np.searchsorted(at, (start, max(start, end - WIDTH + 1)))
        hashes, places = chosen[a:b], at[a:b] - start
        if not len(hashes) and text:
            hashes, places = np.array([xxhash.xxh32_intdigest(text)], np.uint64), np.zeros(1, np.int64)
        out.append(_sketch(hashes, places))
        start = end
    return out


def printed(sketch: Sketch) -> str:
    """The anchors in their order in the text, in base 64: four bytes of each hash, then a byte for each way from the place before.

    No way is longer than WIDTH - INNER + 1 bytes, as there is an anchor in so many neighbouring runs.
    """
    order = np.argsort(sketch[1], kind="stable")
    hashes, ways = sketch[0][order] >> np.uint64(32), np.diff(sketch[1][order], prepend=0)
    return base64.b64encode(hashes.astype("<u4").tobytes() + ways.astype(np.uint8).tobytes()).decode("ascii")


def parsed(fingerprint: str) -> Sketch:
    data = base64.b64decode(fingerprint)
    n = len(data) // 5
    places = np.cumsum(np.frombuffer(data, np.uint8, offset=4 * n).astype(np.int64)) if n else np.zeros(0, np.int64)
    return _sketch(np.frombuffer(data, "<u4", n).astype(np.uint64), places)


def likeness(a: Sketch, b: Sketch) -> float:
    """0 to 1: the share of the anchors of both that are in both texts, in the same order. Empty texts are alike.

    Where a text has one hash several times, its first anchor is held against the other text's first, and so on.
    """
    if not len(a[0]) and not len(b[0]):
        return 1.0
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = np.flatnonzero(b[0][at] == a[0])
    places = b[1][at[both]][np.argsort(a[1][both], kind="stable")]
    tails: list[int] = []  # longest run of anchors that come in the same order in both
    last = -1
    for place in places.tolist():
        if place > last:
            tails.append(place)
            last = place
        else:
            tails[bisect_left(tails, place)] = place
            last = tails[-1]
    return len(tails) / (len(a[0]) + len(b[0]) - len(both))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row's whole text; null and empty texts have the empty fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, 1, 1 << 20):
            found = [printed(sketch) for sketch in sketches(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(identifier().alias("doc_id"), utf8().alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``following``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def with_next(docs: DataFrame) -> DataFrame:
    """The fingerprints of all ``docs`` (doc_id, text), of their edited texts, and their likeness to both neighbours.

    (doc_id, n_chars, edited text, fingerprint, edited_fingerprint, near_edited, near_next), one row per row. The next
    document is the one with the next smaller doc_id, after the last the first; rows without doc_id come last, and rows
    with one doc_id by their text. Null texts are empty. A single document is its own next. An empty table gives an
    empty table.

    The rows are dealt to ranges of doc_ids. The first document of a range is also sent to the range before it.
    """
    spark = docs.sparkSession
    rows = docs.select(identifier().alias("doc_id"), utf8().alias("text")).withColumn(
        "place", F.coalesce("doc_id", F.lit(-(1 << 63)))
    )
    cuts = range_cuts(rows.select("place"), "place", shuffle_parts(spark))
    starts = F.array(*[F.lit(cut).cast("long") for cut in cuts])
    part = F.aggregate(starts, F.lit(0), lambda n, cut: n + (cut <= F.col("place")).cast("int")) if cuts else F.lit(0)
    # One number per shuffle partition.
    heads = {row["part"]: row["head"] for row in rows.groupBy(part.alias("part")).agg(F.max("place").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    sent = [(heads[p], order[i - 1]) for i, p in enumerate(order)]  # the first range's head goes to the last range
    pairs = [F.lit(x).cast(kind) for head, to in sent for x, kind in ((head, "long"), (to, "int"))]
    also = F.create_map(*pairs).cast("map<bigint,int>")
    dealt = rows.select(
        "doc_id", "text", "place", F.inline(F.array(
            F.struct(part.alias("part"), F.lit(False).alias("extra")),
            F.struct(also[F.col("place")].alias("part"), F.lit(True).alias("extra")),
        )),
    ).filter("part IS NOT NULL")
    ordered = dealt.select("part", "extra", "place", "doc_id", "text").repartitionById(len(cuts) + 1, "part")
    ordered = ordered.sortWithinPartitions("part", "extra", F.col("place").desc(), "text")
    schema = (
        "doc_id long, n_chars long, edited binary, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # the last own row and its sketch, still without its next
        closed = None
        for batch in by_size(batches, 4, 1 << 20):
            held = []
            texts = batch.column(4).to_pylist()
            found = sketches(texts)
            for part, extra, doc_id, text, sketch in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), texts, found
            ):
                if part == closed:
                    continue  # a second row with the head's doc_id
                row = (doc_id, text.decode("utf-8", "replace"), sketch)
                if before is not None:
                    held.append((before, row))
                before, closed = (None, part) if extra else (row, closed)
            if held:
                changed = [edited(a[1], b[1]).encode("utf-8") for a, b in held]
                after = sketches(changed)
                columns = [
                    pa.array([a[0] for a, _ in held], pa.int64()),
                    pa.array([len(a[1]) for a, _ in held], pa.int64()),
                    pa.array(changed, pa.binary()),
                    pa.array([printed(a[2]) for a, _ in held]),
                    pa.array([printed(s) for s in after]),
                    pa.array([likeness(a[2], s) for (a, _), s in zip(held, after)]),
                    pa.array([likeness(a[2], b[2]) for a, b in held]),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns,
                    names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return ordered.mapInArrow(run, schema)

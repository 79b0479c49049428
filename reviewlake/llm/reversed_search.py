"""Ranked lexical search with the roles reversed: the items are indexed, the documents are streamed through the index.

Items are taken in blocks of bounded size. The inverted index of a block's terms is broadcast, and a task counts a document's
terms and keeps those that the index has. These counts, written once, give the corpus statistics and then the scores: every
task streams its documents through the posting lists and keeps, for each item, a heap of the K best documents so far. A
document enters only above the heap's least one. The heaps are merged by item, in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import by_size, identifier, utf8, written

K = 10
#: Bytes of item texts in a block, one item at least.
BLOCK = 16 << 20
#: Bytes of texts in a row of term counts, and of a text that is split into words at a time.
BATCH, PIECE = 1 << 20, 4 << 20
#: Cells of the table of scores, and postings that are added to it at a time; one document at least.
CELLS = 1 << 20
#: Parts of an item's heaps that are merged first.
SALTS = 64
_LAST = (1 << 63) - 1
_COUNTS = "docs long, total long, ids binary, known binary, lengths binary, pairs binary, terms binary, freqs binary"


def _table() -> bytes:
    """What a byte becomes: A-Z a small letter, other ASCII but digits and a-z a space."""
    return bytes(
        byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in range(256)
    )


TABLE = _table()


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a bounded piece of it at a time."""
    spaced, at = text.translate(TABLE), 0
    while len(spaced) - at > PIECE:
        cut = spaced.rfind(b" ", at, at + PIECE)
        cut = cut if cut > at else spaced.find(b" ", at + PIECE)
        if cut < 0:
            break
        yield spaced[at:cut].split()
        at = cut
    yield spaced[at:].split()


@dataclass
class Index:
    """A block's items, its terms' numbers, and for each term the places of the items that have it."""

    items: list[int | None]
    numbers: dict[bytes, int]
    starts: np.ndarray
    postings: np.ndarray

    @classmethod
    def of(cls, rows: list[Row]) -> Index:
        numbers: dict[bytes, int] = {}
        lists: list[list[int]] = []
        for place, row in enumerate(rows):
            for term in dict.fromkeys(word for piece in terms(bytes(row["text"])) for word in piece):
                number = numbers.setdefault(term, len(numbers))
                if number == len(lists):
                    lists.append([])
                lists[number].append(place)
        starts = np.concatenate([[0], np.cumsum([len(places) for places in lists], dtype=np.int64)]).astype(np.int64)
        postings = np.array([place for places in lists for place in places], np.int64)
        return cls([row["item_id"] for row in rows], numbers, starts, postings)


def _blocks(items: DataFrame, size: int) -> Iterator[list[Row]]:
    """The items in blocks of about ``size`` bytes; they pass through the driver a partition at a time."""
    block: list[Row] = []
    held = 0
    for row in items.select(identifier("item_id").alias("item_id"), utf8().alias("text")).toLocalIterator():
        if block and held + len(row["text"]) > size:
            yield block
            block, held = [], 0
        block.append(row)
        held += len(row["text"])
    if block:
        yield block


def _counts(docs: DataFrame, index) -> DataFrame:
    """Rows of many documents: how many have terms, all their terms, and each one's counts of terms that ``index`` has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value.numbers.get
        for batch in by_size(batches, 1, BATCH):
            ids, known, lengths, pairs, found, freqs = [], [], [], [], [], []
            some = total = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts: Counter = Counter()
                n = 0
                for words in terms(text.as_py()):
                    n += len(words)
                    counts.update(map(number, words))
                counts.pop(None, None)
                some, total = some + (n > 0), total + n
                if counts:
                    ids.append(_LAST if doc_id is None else doc_id)
                    known.append(doc_id is not None)
                    lengths.append(n)
                    pairs.append(len(counts))
                    found.extend(counts)
                    freqs.extend(counts.values())
            packed = {
                "ids": np.array(ids, "<i8"), "known": np.array(known, np.uint8), "lengths": np.array(lengths, "<i8"),
                "pairs": np.array(pairs, "<i4"), "terms": np.array(found, "<i4"), "freqs": np.array(freqs, "<i4"),
            }
            yield pa.RecordBatch.from_pydict(
                {"docs": pa.array([some], pa.int64()), "total": pa.array([total], pa.int64())}
                | {name: pa.array([values.tobytes()], pa.binary()) for name, values in packed.items()}
            )

    return docs.select(identifier().alias("doc_id"), utf8().alias("text")).mapInArrow(run, _COUNTS)


def _frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """How many documents have each of the ``size`` terms of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in batches:
            for found in batch.column(0).to_pylist():
                sums += np.bincount(np.frombuffer(found, "<i4"), minlength=size)
        present = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"term": pa.array(present, pa.int64()), "df": pa.array(sums[present], pa.int64())})

    out = np.zeros(size, np.int64)
    for row in counts.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


class Heaps:
    """For every item its ``k`` best documents so far: by score, then by least doc_id, those without one last."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.known = np.zeros(0, bool)
        self.least = np.ones(items, np.int64)

    def update(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        """Candidates of at least their item's ``least``."""
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        doc, known = np.concatenate([self.doc, doc]), np.concatenate([self.known, known])
        order = np.lexsort((doc, ~known, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[rank < self.k]
        last = order[rank == self.k - 1]
        self.item, self.score, self.doc, self.known = item[rank < self.k], score[kept], doc[kept], known[kept]
        self.least[item[rank == self.k - 1]] = score[last]


def _searched(counts: DataFrame, index, weights: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """(salt, place, item_id, score, doc_id): every task's heaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = index.value
        starts, postings, items = held.starts, held.postings, len(held.items)
        heaps = Heaps(items, k)
        for batch in batches:
            for row in batch.to_pylist():
                kinds = ("ids", "<i8"), ("known", np.uint8), ("lengths", "<i8"), ("pairs", "<i4"), ("terms", "<i4"), ("freqs", "<i4")
                ids, known, lengths, pairs, term, freq = (np.frombuffer(row[name], kind) for name, kind in kinds)
                if not len(ids):
                    continue
                # Python's own numbers: the product may exceed 64 bits before it is divided.
                norm = np.array([10 + 90 * n * documents // total for n in lengths.tolist()], np.int64)
                document, freq = np.repeat(np.arange(len(ids)), pairs), freq.astype(np.int64)
                value = weights[term] * ((1_000_000_000 * freq) // (1000 * freq + 8 * norm[document]))
                listed = starts[term + 1] - starts[term]
                ends = np.cumsum(pairs)
                work = np.cumsum(listed)[ends - 1]
                a = 0
                while a < len(ids):
                    before = work[a - 1] if a else 0
                    b = min(a + max(1, CELLS // items), int(np.searchsorted(work, before + CELLS, side="right")))
                    b = max(b, a + 1)
                    of = slice(ends[a - 1] if a else 0, ends[b - 1])
                    reps = listed[of]
                    first = np.cumsum(reps) - reps
                    at = np.arange(int(reps.sum())) + np.repeat(starts[term[of]] - first, reps)
                    cells = np.repeat((document[of] - a) * items, reps) + postings[at]
                    scores = np.zeros((b - a) * items, np.int64)
                    np.add.at(scores, cells, np.repeat(value[of], reps))
                    good = np.flatnonzero(scores >= np.tile(heaps.least, b - a))
                    doc, item = a + good // items, good % items
                    heaps.update(item, scores[good], ids[doc], known[doc] > 0)
                    a = b
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_pydict({
            "salt": pa.array([salt] * len(heaps.item), pa.int32()),
            "place": pa.array(heaps.item, pa.int64()),
            "item_id": pa.array([held.items[i] for i in heaps.item.tolist()], pa.int64()),
            "score": pa.array(heaps.score, pa.int64()),
            "doc_id": pa.array(heaps.doc, pa.int64(), mask=~heaps.known),
        })

    return counts.mapInArrow(run, "salt int, place long, item_id long, score long, doc_id long")


def _merged(found: DataFrame, k: int) -> DataFrame:
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = found.withColumn("rank", F.row_number().over(Window.partitionBy("place", "salt").orderBy(*best)))
    part = part.filter(F.col("rank") <= k)
    whole = part.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*best)))
    return whole.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of the highest scores above 0, ties by ascending doc_id.

    Null texts have no terms; an item without terms, or whose terms no document has, has no rows. Every row of ``items`` is an
    item, also those that repeat another one's item_id or have none. Every row of ``docs`` is a document, so repeated rows
    rank beside each other; those without doc_id come last among equal scores. Empty tables give an empty table. No other
    columns are read.
    """
    spark = docs.sparkSession
    results = []
    for rows in _blocks(items, block):
        index = spark.sparkContext.broadcast(Index.of(rows))
        counts = written(_counts(docs, index), "term-counts")
        sums = counts.agg(F.sum("docs").alias("docs"), F.sum("total").alias("total")).first()
        documents, total = sums["docs"] or 0, sums["total"] or 0
        df = _frequencies(counts, len(index.value.numbers))
        weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64
        )
        results.append(written(_merged(_searched(counts, index, weights, documents, total, k), k), "ranked"))
        index.unpersist()
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, results)

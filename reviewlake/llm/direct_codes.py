"""Token ids in directly addressable codes, as files ordered by doc_id.

An id is cut into chunks of eight bits, the lowest first. Level l holds the chunk l of every id that has one, and a
bitmap that says which of them go on at level l + 1; the place there is the number of set bits before, which a rank
directory (counts before every 512th bit) and one short popcount give. So any token is read without decoding others.

A segment holds whole documents and is a file image of its own:

    4 bytes "DAC1" | u32 documents | u64 ids | u64 ids before it in its part | u32 levels
    documents x (u8 1 if it has a doc_id, i64 doc_id, u64 first id)
    per level: u64 chunks | chunks x u8 | u32 words | words x u64 bitmap | u32 counts | counts x u64 ranks

All numbers are little-endian. A part is a range of doc_ids; parts and their segments are in ascending order.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import by_size, give_back, identifier, range_cuts, scratch, shuffle_parts, utf8
from reviewlake.llm.library_tokens import encoder

MAGIC = b"DAC1"
SEGMENT = 1 << 20
_HEAD = struct.Struct("<4sIQQI")
_DOC = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("first", "<u8")])
_RANK_WORDS = 8


def pack_levels(ids: np.ndarray) -> list[bytes]:
    """The levels of 32-bit ids."""
    out, rest = [], np.asarray(ids, "<u4")
    while True:
        further = rest > 0xFF
        bits = np.zeros(-(-len(rest) // 64) * 64, np.uint8)
        bits[: len(rest)] = further
        words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(words).astype(np.uint64)
        before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(counts)])[:-1][::_RANK_WORDS].astype("<u8")
        out.append(
            struct.pack("<Q", len(rest)) + (rest & 0xFF).astype("u1").tobytes()
            + struct.pack("<I", len(words)) + words.tobytes() + struct.pack("<I", len(before)) + before.tobytes()
        )
        if not further.any():
            return out
        rest = rest[further] >> 8


class Segment:
    """A segment's image, opened for reading."""

    def __init__(self, data: bytes) -> None:
        magic, documents, self.ids, self.base, levels = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at = _HEAD.size
        self.documents = np.frombuffer(data, _DOC, documents, at)
        at += documents * _DOC.itemsize
        self.levels = []
        for _ in range(levels):
            (chunks,) = struct.unpack_from("<Q", data, at)
            values = np.frombuffer(data, "u1", chunks, at + 8)
            at += 8 + chunks
            (n,) = struct.unpack_from("<I", data, at)
            words = np.frombuffer(data, "<u8", n, at + 4)
            at += 4 + 8 * n
            (n,) = struct.unpack_from("<I", data, at)
            ranks = np.frombuffer(data, "<u8", n, at + 4)
            at += 4 + 8 * n
            self.levels.append((values, words, ranks))

    def rank(self, depth: int, place: int) -> int:
        """How many chunks of a level go on before ``place``: a count of the directory, and few words."""
        _, words, ranks = self.levels[depth]
        word, bit = divmod(place, 64)
        block = min(word // _RANK_WORDS, len(ranks) - 1)
        inside = int(np.bitwise_count(words[block * _RANK_WORDS : word]).sum())
        return int(ranks[block]) + inside + ((int(words[word]) & ((1 << bit) - 1)).bit_count() if bit else 0)

    def __getitem__(self, place: int) -> int:
        """One id, by a chunk and a rank per level."""
        if not 0 <= place < self.ids:
            raise IndexError(place)
        value = 0
        for depth, (values, words, _) in enumerate(self.levels):
            value |= int(values[place]) << 8 * depth
            if not int(words[place // 64]) >> place % 64 & 1:
                break
            place = self.rank(depth, place)
        return value

    def between(self, first: int, last: int, depth: int = 0) -> np.ndarray:
        """The ids from ``first`` to before ``last``: the ranks of both ends say which chunks of the next level they have."""
        values, words, _ = self.levels[depth]
        value = values[first:last].astype("<u4")
        if first < last and depth + 1 < len(self.levels):
            start, stop = self.rank(depth, first), self.rank(depth, last)
            if start < stop:
                bits = np.unpackbits(words[first // 64 : -(-last // 64)].view("u1"), bitorder="little")
                further = bits[first % 64 : first % 64 + last - first].astype(bool)
                value[further] |= self.between(start, stop, depth + 1) << np.uint32(8)
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level from the last."""
        higher = np.zeros(0, "<u4")
        for values, words, _ in reversed(self.levels):
            value = values.astype("<u4")
            further = np.unpackbits(words.view("u1"), bitorder="little")[: len(values)].astype(bool)
            value[further] |= higher << 8
            higher = value
        return higher


def _segment(documents: list[tuple[int | None, np.ndarray]], base: int) -> bytes:
    table = np.zeros(len(documents), _DOC)
    ids = np.concatenate([found for _, found in documents])
    sizes = np.array([len(found) for _, found in documents])
    table["known"] = [doc_id is not None for doc_id, _ in documents]
    table["doc_id"] = [doc_id or 0 for doc_id, _ in documents]
    table["first"] = np.cumsum(sizes) - sizes
    levels = pack_levels(ids)
    return _HEAD.pack(MAGIC, len(table), len(ids), base, len(levels)) + table.tobytes() + b"".join(levels)


def token_ids(docs: DataFrame, vocabulary: str, end: int, cuts: list[int]) -> DataFrame:
    """(part, doc_id, n_tokens, ids): every row's ids and ``end``, as 16-bit numbers if all fit, else as 32-bit ones.

    ``part`` is the number of ``cuts`` up to the doc_id, 0 without one.
    """
    splits = np.array(cuts, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, last = encoder(vocabulary), np.array([end], "<u4").tobytes()
        for batch in by_size(batches, 1, 1 << 23):
            texts = [text.as_py().decode("utf-8", "replace") for text in batch.column(1)]
            ids = [np.frombuffer(found + last, "<u4") for found in library.by_words(texts)]
            narrow = [found.astype("<u2") if found.max() <= 0xFFFF else found for found in ids]
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            part = np.searchsorted(splits, batch.column(0).fill_null(0).to_numpy(), side="right") * known
            sizes = pa.array([len(f) for f in ids], pa.int64())
            raw = pa.array([f.tobytes() for f in narrow], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), batch.column(0), sizes, raw], names=["part", "doc_id", "n_tokens", "ids"]
            )
        library.forget()
        give_back()

    return docs.select(identifier().alias("doc_id"), utf8().alias("text")).mapInArrow(
        run, "part int, doc_id long, n_tokens long, ids binary"
    )


def write_codes(docs: DataFrame, path: str, vocabulary: str, end: int, segment: int = SEGMENT) -> None:
    """Writes the ids of all ``docs`` (doc_id, text) to ``path`` in ascending doc_id order, null doc_ids first.

    Rows (part, segment, n_ids, data); data is the segment's image. The parts are ranges of doc_ids, as many as
    shuffle partitions, so rows with one doc_id are in one part; a document is in one segment. Null and empty
    texts have the end id only. Repeated doc_ids are in the order of their ids. An empty table gives no segment.
    """
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    cuts = range_cuts(docs.select(identifier().alias("doc_id")), "doc_id", parts)
    ids = token_ids(docs, vocabulary, end, cuts)
    ordered = ids.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("part", "doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, np.ndarray]] = []
        size = base = number = 0
        current = None

        def image() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": [current], "segment": [number], "n_ids": [size], "data": [_segment(held, base)]},
                schema=pa.schema([("part", pa.int32()), ("segment", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())]),
            )

        for batch in batches:
            for at, doc_id, n, raw in zip(*(column.to_pylist() for column in batch.columns)):
                if held and (at != current or size >= segment):
                    yield image()
                    number, base = (0, 0) if at != current else (number + 1, base + size)
                    held, size = [], 0
                current = at
                held.append((doc_id, np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")))
                size += n
        if held:
            yield image()

    ordered.mapInArrow(run, "part int, segment long, n_ids long, data binary").write.parquet(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files: ``start`` counts the ids before, ``ids`` are 32-bit numbers.

    Every document is read by itself, through the rank directories.
    """
    schema = "part int, segment long, n_ids long, data binary"
    files = spark.read.schema(schema).parquet(path)
    # One row per part, so that this window is as small as the number of shuffle partitions.
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Segment(data.as_py())
                docs = found.documents
                firsts = docs["first"].astype(np.int64)
                lasts = np.append(firsts[1:], found.ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(docs), part, np.int32)),
                        pa.array(docs["doc_id"], mask=docs["known"] == 0),
                        pa.array(firsts + found.base),
                        pa.array(lasts - firsts),
                        pa.array([found.between(a, b).tobytes() for a, b in zip(firsts.tolist(), lasts.tolist())], pa.binary()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids"],
                )

    docs = files.select("part", "data").mapInArrow(
        run, "part int, doc_id long, start long, n_tokens long, ids binary"
    )
    return docs.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("start") + F.col("part_base")).alias("start"), "n_tokens", "ids"
    )


def write_and_read(docs: DataFrame, vocabulary: str, end: int) -> DataFrame:
    spark = docs.sparkSession
    path = scratch(spark, "codes")
    write_codes(docs, path, vocabulary, end)
    return read_codes(spark, path)

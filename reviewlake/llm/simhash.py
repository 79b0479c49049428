"""SimHash near-duplicates found through the perfect Golay code.

The 64 bits of a fingerprint are three segments of 21, 21 and 22 bits. A segment, padded to the 23 bits of the
code, lies within three bits of exactly one codeword, and two segments that differ in one bit always meet: the
codeword nearest to the one lies within four bits of the other. So a fingerprint is stored under the nearest
codeword of a segment (one key) and looked up under every codeword within four bits (one or six keys).

Three differing bits leave two ways (pigeonhole): one bit in each segment, or a segment without any and another
with one at most. The first is searched by the codewords of the first two segments, the second by the exact
segment and the codeword of another, for the six ordered choices of both. Whatever meets under a key is verified by
its Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.operators.components import connected_components
from reviewlake.session import cut_lineage

SEGMENTS = ((0, 21), (21, 21), (42, 22))
MAX_BITS = 3
#: Fixed value: the generator polynomial of the binary Golay code of length 23.
GOLAY_GENERATOR = 0xC75
_SEED = 42


def fingerprint_of(text: bytes, width: int = 3) -> int:
    """The SimHash of one text as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        hashes = [digest(b" ".join(words), _SEED)]
    else:
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        first = (ends - lengths)[: len(words) - width + 1].tolist()
        last = ends[width - 1 :].tolist()
        hashes = [digest(joined[a:b], _SEED) for a, b in zip(first, last)]
    total = np.zeros(64, np.int64)
    step = 1 << 16
    for start in range(0, len(hashes), step):
        values = np.array(hashes[start : start + step], dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(values, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row's whole text. Null texts count as empty, fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint_of(text.as_py(), width) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], names=["doc_id", "fp"]
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )
    return texts.mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and by syndrome the error patterns of up to four bits and their number."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY_GENERATOR << (bit - 11)
        return word

    low = np.array([remainder(word) for word in range(1 << 12)], np.int64)
    high = np.array([remainder(word << 12) for word in range(1 << 11)], np.int64)
    patterns: list[list[int]] = [[] for _ in range(1 << 11)]
    single = [remainder(1 << bit) for bit in range(23)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= single[bit]
            patterns[syndrome].append(sum(1 << bit for bit in bits))
    number = np.array([len(found) for found in patterns], np.int64)
    table = np.array([(found * 6)[:6] for found in patterns], np.int64)
    return low, high, table, number


def nearby_codewords(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) indices of the codewords within four bits, the nearest first, and how many of the six count."""
    low, high, table, number = _golay()
    syndrome = low[segment & 0xFFF] ^ high[segment >> 12]
    return (segment[:, None] ^ table[syndrome]) >> 11, number[syndrome]


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    values = fps.view(np.uint64)
    return [((values >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]


def stored_keys(fps: np.ndarray) -> np.ndarray:
    """(n, 7): the keys a fingerprint is stored under."""
    parts = _segments(fps)
    nearest = [nearby_codewords(part)[0][:, 0] for part in parts]
    keys = [
        (tag << 40) | (parts[i] << 12) | nearest[j]
        for tag, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j)
    ]
    keys.append((6 << 40) | (nearest[0] << 12) | nearest[1])
    return np.stack(keys, axis=1)


def looked_up_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys the fingerprints are looked up under."""
    parts = _segments(fps)
    near = [nearby_codewords(part) for part in parts]
    six = np.arange(6)
    rows, keys = [], []
    pairs = [(i, j) for i in range(3) for j in range(3) if i != j]
    for tag, (i, j) in enumerate(pairs):
        row, which = np.nonzero(six[None, :] < near[j][1][:, None])
        rows.append(row)
        keys.append((tag << 40) | (parts[i][row] << 12) | near[j][0][row, which])
    both = (six[None, :, None] < near[0][1][:, None, None]) & (six[None, None, :] < near[1][1][:, None, None])
    row, a, b = np.nonzero(both)
    rows.append(row)
    keys.append((6 << 40) | (near[0][0][row, a] << 12) | near[1][0][row, b])
    return np.concatenate(rows), np.concatenate(keys)


def _keys_frame(fps: DataFrame, stored: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                values = batch.column(0).slice(start, 4096).to_numpy(zero_copy_only=False)
                if stored:
                    keys = stored_keys(values)
                    key, fp = keys.ravel(), np.repeat(values, keys.shape[1])
                else:
                    row, key = looked_up_keys(values)
                    fp = values[row]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(src, dst), src < dst: all pairs of distinct fingerprints ``fp`` that differ in at most ``max_bits`` bits.

    ``max_bits`` can be 0 to 3; the segments find nothing beyond. Each fingerprint is there once, so copies
    make no pairs. A key that many different fingerprints share is a skewed join key, which adaptive execution splits.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    stored = _keys_frame(fps, True).withColumnRenamed("fp", "src")
    looked = _keys_frame(fps, False).withColumnRenamed("fp", "dst")
    return (
        looked.join(stored, "key")
        .filter(F.col("src") < F.col("dst"))
        .filter(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits)
        .select("src", "dst")
        .distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    component_id is the smallest doc_id that can be reached over links of at most ``max_bits`` bits, the row's own
    included. Null and empty texts and texts of white space have fingerprint zero and are linked like any others.
    Repeated rows stay; rows without doc_id come back with their group's smallest doc_id, or null if it has none. An
    empty table gives an empty table.
    """
    rows = cut_lineage(fingerprints(docs, width))
    owners = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("owner")))
    edges = cut_lineage(links(owners, max_bits))
    linked = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    groups = connected_components(linked, edges).select(F.col("node").alias("fp"), F.col("component").alias("group"))
    placed = owners.join(groups, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    smallest = placed.groupBy("group").agg(F.min("owner").alias("component_id"))
    found = placed.join(smallest, "group").select("fp", "component_id")
    return rows.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, width: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near duplicates: the one with the smallest doc_id.

    Rows without doc_id belong to no group and stay, and rows that repeat the kept doc_id stay with it.
    """
    found = near_duplicates(docs, width, max_bits)
    dropped = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)

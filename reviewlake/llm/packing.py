"""Best-fit packing of token pieces into sequences, by rounds over ever fewer partitions.

Every partition packs its pieces best-fit, the longest first. Nearly full bins are done. All others are items of the next
round, dealt anew to as many partitions as they need, until one partition is left, or a round has saved next to none of the
bins that it could have saved at best. Only ids and sizes are shuffled. Bins move whole, which is the
method's price beside packing all pieces at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import by_size, give_back, identifier, utf8, written
from reviewlake.llm.library_tokens import encoder
from reviewlake.session import cut_lineage

CAPACITY = 2048
#: Items of a partition on average, and the share of the bins more than its items need that a round must save for another one.
ITEMS, LEAST_GAIN = 50_000, 0.05
#: Text pieces whose ids a task keeps.
PIECES = 250_000
#: A bin this full is done.
NEARLY_FULL = 0.995


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, the longest placed first, each in the bin it leaves the least room in."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # bit r of rooms: some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, place, used = capacity, used, used + 1
        bins[i], offsets[i] = place, capacity - room
        if room > size:
            if not by_room[room - size]:
                rooms |= 1 << (room - size)
            by_room[room - size].append(place)
    return bins, offsets


def _round(items: DataFrame, number: int, capacity: int, last: bool) -> DataFrame:
    """(item, bin, offset, size of the item, fill of the bin, open) for (grp, item, size)."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        sizes = rows["size"].to_numpy()
        bins, offsets = best_fit(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        still = np.zeros(len(fill), bool) if last else fill < NEARLY_FULL * capacity
        name = (number << 56) | (int(key[0]) << 32) | bins
        return pd.DataFrame(
            {"item": rows["item"], "bin": name, "offset": offsets, "fill": fill[bins], "open": still[bins]}
        )

    return items.groupBy("grp").applyInPandas(run, "item long, bin long, offset long, fill long, open boolean")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, bin, offset) for ``items`` (item long, unique; size, 1 to ``capacity``). Bins are gapless from 0.

    An empty table gives an empty table.
    """
    groups = max(1, -(-items.count() // ITEMS))
    dealt = items.select(F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"), "item", F.col("size").cast("long"))
    placed = cut_lineage(_round(dealt, 0, capacity, groups == 1))
    levels, current, number, before, least = [], placed, 0, None, 0
    while groups > 1:
        left = current.filter(F.col("open") & (F.col("offset") == 0))
        made, fill, done = current.filter(F.col("offset") == 0).agg(
            F.count_if("open"), F.sum(F.when(F.col("open"), F.col("fill"))), F.count_if(~F.col("open"))
        ).first()
        if not made or (before is not None and before - made - done < LEAST_GAIN * (before - least)):
            break
        number, before, least = number + 1, made, -(-fill // capacity)
        groups = max(1, -(-made // ITEMS))
        # Another hash in every round, so that other bins meet.
        bins = left.select(
            F.pmod(F.xxhash64("bin", F.lit(number)), F.lit(groups)).alias("grp"),
            F.col("bin").alias("item"), F.col("fill").alias("size"),
        )
        current = cut_lineage(_round(bins, number, capacity, groups == 1))
        levels.append(current)
    out = placed.select("item", "bin", "offset")
    for level in levels:
        above = level.select(F.col("item").alias("bin"), F.col("bin").alias("_bin"), F.col("offset").alias("_offset"))
        out = out.join(above, "bin", "left").select(
            "item",
            F.coalesce("_bin", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("_offset", F.lit(0))).alias("offset"),
        )
    return out


def pieces(docs: DataFrame, vocabulary: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32) of every row's ids and ``end``; ids are 32-bit numbers.

    A document of up to ``capacity`` ids is one piece, a longer one is cut so that all but the first piece are full.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, last = encoder(vocabulary, PIECES), np.array([end], "<u4").tobytes()
        for batch in by_size(batches, 1, 1 << 21):
            texts = [text.as_py().decode("utf-8", "replace") for text in batch.column(1)]
            columns: list[list] = [[], [], [], [], [], []]
            for doc_id, found in zip(batch.column(0).to_pylist(), library.by_pieces(texts)):
                found += last
                n = len(found) // 4
                count = -(-n // capacity)
                first = n - (count - 1) * capacity
                for number in range(count):
                    start = first + (number - 1) * capacity if number else 0
                    stop = first + number * capacity
                    ids = found[4 * start : 4 * stop]
                    for column, value in zip(columns, (doc_id, number, start, stop - start, ids, zlib.crc32(ids))):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types)],
                names=["doc_id", "piece", "start", "length", "ids", "ids_crc32"],
            )
        library.forget()
        give_back()

    return docs.select(identifier().alias("doc_id"), utf8().alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"
    )


def pack_documents(docs: DataFrame, vocabulary: str, end: int, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(pieces, places): the written pieces with an ``item`` number, and (item, bin, offset) of each.

    Null and empty texts have the end id only. Null and repeated doc_ids are packed like any others.
    """
    cut = pieces(docs, vocabulary, end, capacity).withColumn("item", F.monotonically_increasing_id())
    stored = written(cut, "pieces")
    return stored, pack(stored.select("item", F.col("length").alias("size")), capacity)


def placements(docs: DataFrame, vocabulary: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    stored, places = pack_documents(docs, vocabulary, end, capacity)
    return (
        stored.drop("ids")
        .join(places, "item")
        .select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
    )


def sequences(docs: DataFrame, vocabulary: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed sequences' ids, 32-bit numbers one after another."""
    stored, places = pack_documents(docs, vocabulary, end, capacity)
    parts = stored.select("item", "ids").join(places, "item")
    held = parts.groupBy(F.col("bin").alias("sequence_id")).agg(
        F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("parts")
    )
    return held.select("sequence_id", F.unhex(F.array_join(F.col("parts.ids"), "")).alias("ids"))

"""Byte-level BPE encoding and decoding with a given rank file."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reviewlake.llm.common import TwoGenerations, by_size, identifier, utf8
from reviewlake.llm.pretokens import token_slices

CACHE = 250_000
CHUNK = 1 << 21
_LONG = 48


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged, the leftmost first, until none has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > _LONG:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    get, none = ranks.get, len(ranks) + (1 << 40)
    pairs = [get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[part] for part in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap of pairs over a linked list, for pre-tokens of any length."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts here, 0 once it is merged into another
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (rank := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if (left := before[i]) >= 0 and (rank := ranks.get(piece[left:stop])) is not None:
            heapq.heappush(heap, (rank, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Ids of texts by cached merging of their pre-tokens. Ids are kept as little-endian 32-bit bytes."""

    def __init__(self, path: str, cache: int = CACHE) -> None:
        ranks = load_ranks(path)
        self.ids = TwoGenerations(lambda piece: np.array(merge_piece(piece, ranks), "<i4").tobytes(), cache)

    def encode(self, texts: list[str]) -> list[bytes]:
        data, bounds, firsts = token_slices(texts)
        at, ids = bounds.tolist(), self.ids
        found = [ids[data[a:b]] for a, b in zip(at, at[1:])]
        return [b"".join(found[a:b]) for a, b in zip(firsts.tolist(), firsts[1:].tolist())]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> tuple[dict[int, bytes], np.ndarray]:
    tokens = {rank: token for token, rank in load_ranks(path).items()}
    lengths = np.zeros(max(tokens) + 1, np.int64)
    lengths[list(tokens)] = [len(token) for token in tokens.values()]
    return tokens, lengths


def _int_lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(value) for value in values])]).astype(np.int32)
    flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids array<int>, offsets array<int>) for every row of ``docs`` (doc_id, text; others are ignored).

    ``offsets`` holds the byte of the text at which each token starts. Null and empty texts have no ids. Null and
    repeated doc_ids stay as they are. An empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = _encoder(ranks_path), _vocabulary(ranks_path)[1]
        for batch in by_size(batches, 1, CHUNK):
            texts = [text.as_py().decode("utf-8", "replace") for text in batch.column(1)]
            ids = [np.frombuffer(found, "<i4") for found in encoder.encode(texts)]
            starts = [np.cumsum(lengths[found]) - lengths[found] for found in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _int_lists(ids), _int_lists(starts)], names=["doc_id", "ids", "offsets"]
            )

    return docs.select(identifier().alias("doc_id"), utf8().alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, offsets array<int>"
    )


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ids stand for. Null ids and ids without a token are an error."""
    kept = [field for field in encoded.schema.fields if field.name != "decoded"]
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept)
    encoded = encoded.select([field.name for field in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _vocabulary(ranks_path)[0].__getitem__
        for whole in batches:
            where = whole.schema.get_field_index("ids")
            step = 256
            for batch in (whole.slice(i, step) for i in range(0, whole.num_rows, step)):
                bounds = batch.column(where).offsets.to_numpy()
                ids = batch.column(where).values.to_numpy()
                found = [b"".join(map(token, ids[a:b].tolist())) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, "decoded"]
                )

    return encoded.mapInArrow(run, f"{schema}, decoded binary")

"""Removal of byte strings that an earlier document has, through merged Burrows-Wheeler transforms.

Every window of WIDTH bytes has an anchor, the least hash of its KMER-byte runs, so equal windows have equal anchors.
Texts are stored in shards of a few megabytes. The shards' anchors are dealt to buckets, which tell each shard the ones
that another document has too; around those, runs of windows with one anchor become strings. A bucket gets the distinct
strings of a shard with the least document of each, and answers in the order they came, so where a string stands is known to
its shard alone. A string that can't share a window with another one of its anchor is repeated as a whole. All others are indexed: the strings of
a shard, or of several that send little, have a Burrows-Wheeler transform, and the transforms are merged by refining their interleaving, one more
character of context in each round, without sorting suffixes again. The rounds also part the interleaving where common
prefixes end, so after WIDTH rounds its intervals are the repeated windows, and the least document of each is known.

An anchor with more than about HOT distinct strings is not indexed in one task: each of its windows has the hash of the
whole window as its anchor instead, which equal windows share too. The new anchors are dealt to buckets as the others are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import bucketed, document_shards, give_back, opened, shuffle_parts, written

WIDTH, KMER = 50, 16
SHARD = 4 << 20
#: Windows of one string at most, suffixes indexed at a time, and suffixes of one transform at least.
WINDOWS, INDEXED, TRANSFORMED = 64, 1 << 18, 1 << 16
#: Bytes of texts whose strings make a bucket, and whose buckets make a partition. Each shard sends a row to each bucket.
BUCKET, PARTITION = 16 << 20, 64 << 20
#: Places hashed at a time: their numbers stay in a core's cache.
PIECE = 1 << 14
#: Distinct strings of an anchor from which its windows are parted, counted from one of ONE_IN.
HOT, ONE_IN = 1 << 14, 64
_LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15


def _mixed(values: np.ndarray) -> np.ndarray:
    """The values mixed, in their own array."""
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(32)
    return values


def _runs(data: np.ndarray, length: int) -> np.ndarray:
    """A polynomial hash of every run of ``length`` bytes."""

    def joined(a: np.ndarray, b: np.ndarray, of_a: int, of_b: int) -> np.ndarray:
        n = max(0, len(data) - of_a - of_b + 1)
        out = a[:n] * np.uint64(pow(_BASE, of_b, 1 << 64))
        out += b[of_a : of_a + n]
        return out

    power, size = data.astype(np.uint64), 1
    power += np.uint64(1)
    power *= np.uint64(_BASE)
    made, done = None, 0
    while done < length:
        if length & size:
            made, done = (power, size) if made is None else (joined(made, power, done, size), done + size)
        if done < length:
            power, size = joined(power, power, size, size), 2 * size
    return made


def _by_piece(data: np.ndarray, reach: int, made: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """What ``made`` has for every run of ``reach`` bytes, a piece of the data at a time."""
    out = np.empty(max(0, len(data) - reach + 1), np.uint64)
    for at in range(0, len(out), PIECE):
        part = data[at : at + PIECE + reach - 1]
        out[at : at + PIECE] = made(part)
    return out


def _whole(data: np.ndarray, length: int) -> np.ndarray:
    """The mixed hash of every run of ``length`` bytes."""
    return _by_piece(data, length, lambda part: _mixed(_runs(part, length)))


def anchored(
    data: np.ndarray, ends: np.ndarray, width: int = WIDTH, kmer: int = KMER, hot: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """(document, start, windows, anchor) of every run of windows with one anchor within one document, in order.

    ``data`` holds the documents one after another, ``ends`` where each ends; starts are places in ``data``. Windows with
    an anchor in ``hot`` have the hash of the whole window instead.
    """
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none, none, none, np.zeros(0, np.uint64)
    span = width - kmer + 1

    def made(part: np.ndarray) -> np.ndarray:
        least, reach = _mixed(_runs(part, kmer)), 1
        while 2 * reach <= span:
            least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
        n = len(part) - width + 1
        return np.minimum(least[:n], least[span - reach :][:n])

    least = _by_piece(data, width, made)
    n = len(least)
    if hot is not None and len(hot):
        parted = np.isin(least, hot)
        if parted.any():
            least = np.where(parted, _whole(data, width), least)
    begins = np.ones(n, bool)
    np.not_equal(least[1:], least[:-1], out=begins[1:])
    begins[ends[ends < n]] = True
    starts = np.flatnonzero(begins)
    document = np.searchsorted(ends, starts, side="right").astype(np.int32)
    counts = np.minimum(np.append(starts[1:], n), ends[document] - width + 1) - starts
    inside = counts > 0
    starts, counts, document = starts[inside], counts[inside], document[inside]
    pieces = -(-counts // WINDOWS)  # long runs, of periodic texts, are cut
    first = np.repeat(starts, pieces)
    number = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = first + number * WINDOWS
    windows = np.minimum(WINDOWS, np.repeat(counts, pieces) - number * WINDOWS)
    return np.repeat(document, pieces), first, windows, least[first]


def transform(strings: list[np.ndarray], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bwt, string, place): the transform of strings of symbols above 0, each ended by its own 0, and what each row is.

    Suffixes are ordered by ``width`` symbols at least, and those equal so far by the number of their string.
    """
    lengths = np.array([len(s) + 1 for s in strings], np.int32)
    text = np.zeros(int(lengths.sum()), np.uint8)
    lasts = np.cumsum(lengths, dtype=np.int32) - 1
    body = np.ones(len(text), bool)
    body[lasts] = False
    text[body] = np.concatenate(strings)
    string = np.repeat(np.arange(len(strings), dtype=np.int32), lengths)
    left = lasts[string] + 1 - np.arange(len(text), dtype=np.int32)  # symbols to the end, the 0 included
    packed = np.zeros(len(text), np.uint64)
    for i in range(8):
        packed <<= np.uint64(8)
        packed[: len(text) - i] |= np.where(left[: len(text) - i] > i, text[i:], np.uint8(0)).astype(np.uint64)
    rank = np.unique(packed, return_inverse=True)[1].astype(np.int32)
    reach = 8
    while reach < width:
        pair = rank * np.int64(len(text) + 2)
        pair[:-reach] += np.where(left[:-reach] > reach, rank[reach:] + 1, 0)
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int32)
        reach *= 2
    order = np.argsort(rank, kind="stable").astype(np.int32)  # equal suffixes stay in the order of their strings
    string, place = string[order], lengths[string[order]] - left[order]
    before = np.where(place > 0, text[order - 1], 0).astype(np.uint8)
    return before, string, place


def merge(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, interval): the rows whose first ``rounds`` symbols repeat, interleaved in order, and their interval's number.

    Rows are numbered through all transforms. A round takes the interleaving so far and deals each row to the place of the
    symbol before it, so the order by h symbols becomes one by h + 1; rows of one transform never change their order.
    Intervals are split where the new first symbol, or the interval that the rest came from, differs. A row alone in its
    interval stays alone whatever is put before it, and an ended suffix has no h symbols: both leave the interleaving.
    """
    symbols = np.concatenate(transforms)
    kind = np.int32 if len(symbols) < 1 << 31 else np.int64
    before = np.zeros(len(symbols), kind)  # the row of the suffix that begins one symbol earlier
    start = 0
    for t in transforms:
        found = np.flatnonzero(t)
        before[start + found[np.argsort(t[found], kind="stable")]] = start + np.arange(len(t) - len(found), len(t))
        start += len(t)
    rows, interval = np.arange(len(symbols), dtype=kind), np.zeros(len(symbols), kind)
    for _ in range(rounds):
        first = symbols[rows]
        found = np.flatnonzero(first)
        found = found[np.argsort(first[found], kind="stable")]
        first, rest = first[found], interval[found]
        split = np.ones(len(found), bool)
        split[1:] = (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])
        alone = split & np.append(split[1:], True)
        found, split = found[~alone], split[~alone]
        rows, interval = before[rows[found]], np.cumsum(split, dtype=kind)
    return rows, interval


def least_documents(
    shards: list[list[bytes]], documents: list[np.ndarray], width: int = WIDTH
) -> list[list[np.ndarray]]:
    """For each string of each shard, the least document that has the window, for each of its windows in order."""
    symbols = [[np.minimum(np.frombuffer(s, np.uint8), 254) + np.uint8(1) for s in strings] for strings in shards]
    made = [transform(strings, width) for strings in symbols]
    rows, interval = merge([m[0] for m in made], width)
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in shards])])[:-1]
    number = np.concatenate([m[1] + first for m, first in zip(made, firsts)])[rows]
    place = np.concatenate([m[2] for m in made])[rows]
    owner = np.concatenate(documents)
    least = np.full(interval.max(initial=0) + 1, _LAST, np.int64)
    np.minimum.at(least, interval, owner[number])
    windows = np.array([len(s) - width + 1 for strings in shards for s in strings])
    starts = np.cumsum(windows) - windows
    flat = np.repeat(owner, windows)  # a window that doesn't repeat is its own string's
    flat[starts[number] + place] = least[interval]
    parts = np.split(flat, starts[1:])
    return [parts[a : a + len(s)] for a, s in zip(firsts.tolist(), shards)]


def _order_of(ids: list) -> np.ndarray:
    """doc_ids as numbers to compare; documents without one come last."""
    return np.array([_LAST if i is None or i != i else int(i) for i in ids], np.int64)


def _sampled(data: np.ndarray, first: np.ndarray, windows: np.ndarray, anchor: np.ndarray, one_in: int) -> np.ndarray:
    """(anchor, hash) of one of ``one_in`` distinct strings, the same ones in every shard."""
    if not len(first):
        return np.zeros((0, 2), np.uint64)
    whole = _whole(data, WIDTH)
    name = whole[first] + np.uint64(3) * whole[first + windows // 2] + np.uint64(5) * whole[first + windows - 1]
    name = _mixed(name + windows.astype(np.uint64))
    chosen = name % np.uint64(one_in) == 0
    return np.unique(np.stack([anchor[chosen], name[chosen]], axis=1), axis=0)


def _anchor_rows(shards: DataFrame, buckets: int, one_in: int, hot: np.ndarray | None = None) -> DataFrame:
    """(bucket, shard, marks): the anchors of a shard as 32 bits each, twice if two of its documents have it.

    Without ``hot`` bucket -1 has the shard's ``_sampled`` strings, one pair after another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, ends = opened(row["data"], np.array(row["lengths"], np.int64))
                document, first, windows, anchor = anchored(data, ends, hot=hot)
                sampled = [] if hot is not None else [_sampled(data, first, windows, anchor, one_in).tobytes()]
                order = np.lexsort((document, anchor))
                anchor, document = anchor[order], document[order]
                new = np.ones(len(anchor), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])
                names, counts = np.unique(anchor[new], return_counts=True)
                names = np.sort(np.concatenate([names, names[counts > 1]]))
                bucket = (names % np.uint64(buckets)).astype(np.int64)
                mark = (names >> np.uint64(32)).astype("<u4")[np.argsort(bucket, kind="stable")]
                present, size = np.unique(bucket, return_counts=True)
                marks = np.split(mark, np.cumsum(size)[:-1]) if len(present) else []
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([-1] * len(sampled) + present.tolist(), pa.int32()),
                    "shard": pa.array([row["shard"]] * (len(sampled) + len(present)), pa.int64()),
                    "marks": pa.array(sampled + [m.tobytes() for m in marks], pa.binary()),
                })
        give_back()

    return shards.select("shard", "lengths", "data").mapInArrow(run, "bucket int, shard long, marks binary")


def _hot_anchors(dealt: DataFrame, hot: int, one_in: int) -> np.ndarray:
    """The anchors with more than about ``hot`` distinct strings; there is at most one in so many strings of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs in batch.column(0).to_pylist():
                anchor, name = np.frombuffer(pairs, np.int64).reshape(-1, 2).T
                yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor), "name": pa.array(name)})

    sampled = dealt.filter("bucket = -1").select("marks").mapInArrow(run, "anchor long, name long").distinct()
    found = sampled.groupBy("anchor").count().filter(F.col("count") > hot // one_in).select("anchor").collect()
    return np.sort(np.array([row["anchor"] for row in found], np.int64).view(np.uint64))


def _by_bucket(rows: DataFrame, parts: int, resolve: Callable[[list[dict]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``resolve`` makes of the rows of each bucket; a task holds one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield from resolve(held)
                    held = []
                held.append(row)
        if held:
            yield from resolve(held)
        give_back()

    # There are few buckets in a partition: they are dealt evenly.
    dealt = rows.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int"))
    return dealt.sortWithinPartitions("bucket", "shard").mapInArrow(run, schema)


def _shared_marks(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    """(shard, bucket, marks): those of a shard's marks that are there twice or more in the bucket, in rising order."""
    marks = np.concatenate([np.frombuffer(row["marks"], "<u4") for row in rows])
    _, place, counts = np.unique(marks, return_inverse=True, return_counts=True)
    several = counts[place] > 1
    at = 0
    for row in rows:
        own = slice(at, at + len(row["marks"]) // 4)
        at = own.stop
        found = marks[own][several[own]]
        found = found[np.append(True, found[1:] != found[:-1])] if len(found) else found  # a shard's marks are sorted
        if len(found):
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([row["shard"]], pa.int64()), "bucket": pa.array([row["bucket"]], pa.int32()),
                "marks": pa.array([found.tobytes()], pa.binary()),
            })


class _Strings:
    """A shard's strings around shared anchors, bucket by bucket and in one order whenever they are made."""

    def __init__(self, row: dict, marks: dict[int, bytes], buckets: int, hot: np.ndarray) -> None:
        lengths = np.array(row["lengths"], np.int64)
        self.data, self.ends = opened(row["data"], lengths)
        self.base = self.ends - lengths
        self.owners = _order_of(list(row["ids"]))
        self.document, self.first, self.windows, self.anchor = anchored(self.data, self.ends, hot=hot)
        names = (self.anchor % np.uint64(buckets)) << np.uint64(32) | self.anchor >> np.uint64(32)
        wanted = [np.frombuffer(m, "<u4").astype(np.uint64) | np.uint64(b) << np.uint64(32) for b, m in marks.items()]
        chosen = np.flatnonzero(np.isin(names, np.concatenate(wanted))) if wanted else np.zeros(0, np.int64)
        bucket = (self.anchor[chosen] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        self.buckets, size = np.unique(bucket, return_counts=True)
        self.runs = np.split(chosen[order], np.cumsum(size)[:-1]) if len(self.buckets) else []

    def of_buckets(self) -> Iterator[tuple[int, np.ndarray, list[bytes], np.ndarray]]:
        """(bucket, runs, distinct strings, the number of each run's string)."""
        whole = self.data.tobytes()
        for bucket, at in zip(self.buckets.tolist(), self.runs):
            number: dict[bytes, int] = {}
            spans = zip(self.first[at].tolist(), (self.first[at] + self.windows[at] + WIDTH - 1).tolist())
            string = np.array([number.setdefault(whole[x:y], len(number)) for x, y in spans], np.int32)
            yield bucket, at, list(number), string


_STRINGS = "bucket int, shard long, marks binary, anchors binary, lengths binary, chars binary, least binary"


def _string_rows(shards: DataFrame, shared: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """Per bucket, a shard's distinct strings around shared anchors and the least document of each."""

    def run(key: tuple, texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        out = {name.split()[0]: [] for name in _STRINGS.split(", ")}
        if len(texts) and len(marks):
            asked = dict(zip(marks["bucket"].tolist(), marks["marks"]))
            held = _Strings(texts.iloc[0].to_dict(), asked, buckets, hot)
            for bucket, at, strings, string in held.of_buckets():
                least = np.full(len(strings), _LAST, np.int64)
                np.minimum.at(least, string, held.owners[held.document[at]])
                name = np.zeros(len(strings), np.uint64)
                name[string] = held.anchor[at]
                lengths = np.array([len(s) for s in strings], np.int32)
                # The bucket stands for the rest of an anchor's name.
                values = (
                    bucket, key[0], asked[bucket], (name >> np.uint64(32)).astype("<u4").tobytes(),
                    zstandard.compress(lengths.tobytes()), zstandard.compress(b"".join(strings)), zstandard.compress(least.tobytes()),
                )
                for column, value in zip(out.values(), values):
                    column.append(value)
        return pd.DataFrame(out)

    return shards.groupBy("shard").cogroup(shared.groupBy("shard")).applyInPandas(run, _STRINGS)


def _may_share(texts: list[bytes], anchor: np.ndarray, width: int = WIDTH, kmer: int = KMER) -> np.ndarray:
    """Whether a string can have a window of another one with its anchor.

    Such a window has half of its other bytes on the left of the anchor's run or on the right of it, so the run extended
    that far is in both strings. A string that has the run more than once may always share, as may one whose anchor, known by
    its upper half, is the hash of a whole window.
    """
    wing = -(-(width - kmer) // 2)
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(text) for text in texts])
    ends = np.cumsum(lengths)
    hashes, long = _whole(data, kmer), _by_piece(data, kmer + wing, lambda part: _runs(part, kmer + wing))
    at = np.flatnonzero((hashes >> np.uint64(32)).astype(np.uint32) == np.repeat(anchor, lengths)[: len(hashes)])
    string = np.searchsorted(ends, at, side="right")
    inside = at + kmer <= ends[string]
    at, string = at[inside], string[inside]
    may = np.bincount(string, minlength=len(texts)) != 1
    starts = ends - lengths
    for fits, first in ((at - wing >= starts[string], at - wing), (at + kmer + wing <= ends[string], at)):
        _, place, counts = np.unique(long[first[fits]], return_inverse=True, return_counts=True)
        may[string[fits][counts[place] > 1]] = True
    return may


def _transformed(batch: list[int], shard: np.ndarray, sizes: list[int]) -> list[list[int]]:
    """The members of a batch by transform: those of a shard, and of more shards until there are enough suffixes.

    What many shards send to a batch is little each, and their transforms are as many as the shards.
    """
    place = np.argsort(shard, kind="stable")
    total = np.cumsum(np.array(sizes)[place])
    owner = shard[place]
    ends = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))  # a shard's last member
    out, start, done = [], 0, 0
    for end in ends.tolist():
        if total[end] - done >= TRANSFORMED or end + 1 == len(place):
            out.append([batch[i] for i in place[start : end + 1].tolist()])
            start, done = end + 1, total[end]
    return out


def _window_owners(
    strings: dict[bytes, int], least: np.ndarray, anchor: np.ndarray, shard: np.ndarray
) -> dict[int, np.ndarray]:
    """For every string that may share a window with another, the least document of each of its windows."""
    _, group, counts = np.unique(anchor, return_inverse=True, return_counts=True)
    several = np.flatnonzero(counts[group] > 1)
    texts = list(strings)
    out: dict[int, np.ndarray] = {}
    if not len(several):
        return out
    several = several[_may_share([texts[i] for i in several.tolist()], anchor[several])]
    several = several[np.lexsort((shard[several], group[several]))]
    batch: list[int] = []
    size = 0
    for i, number in enumerate(several.tolist()):
        batch.append(number)
        size += len(texts[number]) + 1
        last = i + 1 == len(several)
        if last or (size >= INDEXED and group[several[i + 1]] != group[number]):
            members = _transformed(batch, shard[batch], [len(texts[member]) + 1 for member in batch])
            found = least_documents([[texts[m] for m in ms] for ms in members], [least[ms] for ms in members])
            for ms, arrays in zip(members, found):
                out.update(zip(ms, arrays))
            batch, size = [], 0
    return out


_ANSWERS = "shard long, bucket int, marks binary, least binary, mixed binary, inner binary"


def _answers(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    """For every string of a shard, in its order, the least document that has all of its windows, and where there is none.

    For such strings ``inner`` has the least document of each of their windows, string by string.
    """
    number: dict[bytes, int] = {}
    lengths = [np.frombuffer(zstandard.decompress(row["lengths"]), np.int32) for row in rows]
    total = sum(map(len, lengths))
    leasts, anchor, shard = np.full(total, _LAST, np.int64), np.zeros(total, np.uint32), np.zeros(total, np.int64)
    mine = []
    for row, own in zip(rows, lengths):
        chars, stops = zstandard.decompress(row["chars"]), np.cumsum(own)
        known = len(number)
        spans = zip((stops - own).tolist(), stops.tolist())
        local = np.fromiter((number.setdefault(chars[a:b], len(number)) for a, b in spans), np.int32, len(own))
        # A shard's strings differ, so no place is there twice.
        leasts[local] = np.minimum(leasts[local], np.frombuffer(zstandard.decompress(row["least"]), np.int64))
        new = local >= known
        anchor[local[new]] = np.frombuffer(row["anchors"], "<u4")[new]
        shard[local[new]] = row["shard"]
        mine.append(local)
    leasts, anchor, shard = (held[: len(number)] for held in (leasts, anchor, shard))
    inner = _window_owners(number, leasts, anchor, shard)
    mixed = np.zeros(len(leasts), np.uint8)
    for n, windows in inner.items():
        leasts[n], mixed[n] = windows[0], (windows != windows[0]).any()
    for row, local in zip(rows, mine):
        own = [inner[n] for n in local[mixed[local] > 0].tolist()]
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([row["shard"]], pa.int64()), "bucket": pa.array([row["bucket"]], pa.int32()),
            "marks": pa.array([row["marks"]], pa.binary()),
            "least": pa.array([zstandard.compress(leasts[local].tobytes())], pa.binary()),
            "mixed": pa.array([mixed[local].tobytes()], pa.binary()),
            "inner": pa.array([zstandard.compress(b"".join([windows.tobytes() for windows in own]))], pa.binary()),
        })


def _covered(held: _Strings, answers: dict[int, tuple[bytes, bytes, bytes]]) -> np.ndarray:
    """Which bytes of a shard are in a window that a smaller document has."""
    change = np.zeros(len(held.data) + 1, np.int32)
    for bucket, at, strings, string in held.of_buckets():
        whole, flags, parts = answers[bucket]
        least, inner = (np.frombuffer(zstandard.decompress(part), np.int64) for part in (whole, parts))
        mixed = np.frombuffer(flags, np.uint8) > 0
        owner, first = held.owners[held.document[at]], held.first[at]
        hit = ~mixed[string] & (least[string] < owner)
        np.add.at(change, first[hit], 1)
        np.add.at(change, (first + held.windows[at] + WIDTH - 1)[hit], -1)
        ends = np.cumsum(np.where(mixed, [len(text) - WIDTH + 1 for text in strings], 0))
        for i in np.flatnonzero(mixed[string]).tolist():
            stop = ends[string[i]]
            windows = inner[stop - held.windows[at[i]] : stop]
            hits = first[i] + np.flatnonzero(windows < owner[i])
            np.add.at(change, hits, 1)
            np.add.at(change, hits + WIDTH, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(
    docs: DataFrame, shard: int = SHARD, carried: Column | None = None, hot: int = HOT, one_in: int = ONE_IN
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every row's text without the bytes that earlier documents have.

    A byte goes if a string of WIDTH bytes over it also starts in a document with a smaller doc_id. Null texts
    are empty. Documents without doc_id come after all others and don't remove each other's bytes, nor do rows with
    one doc_id. Rows stay as many as they are. An empty table gives an empty table. A string column ``carried`` of
    ``docs`` comes back with each row.
    """
    parts = shuffle_parts(docs.sparkSession)
    shards = bucketed(document_shards(docs, shard, carried), "shard", parts, "texts")
    size = shards.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x)).alias("size")).first()["size"]
    parts = max(parts, -(-(size or 0) // PARTITION))
    buckets = max(parts, -(-(size or 0) // BUCKET))
    dealt = written(_anchor_rows(shards, buckets, one_in), "anchors")
    split = _hot_anchors(dealt, hot, one_in)
    # Hot anchors are rare; only then are the shards read once more.
    dealt = _anchor_rows(shards, buckets, one_in, split) if len(split) else dealt.filter("bucket >= 0")
    shared = _by_bucket(dealt, parts, _shared_marks, "shard long, bucket int, marks binary")
    texts = shards.select("shard", "ids", "lengths", "data")
    answers = _by_bucket(_string_rows(texts, shared, buckets, split), parts, _answers, _ANSWERS)

    def cut(_: tuple, texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = texts.iloc[0].to_dict()
        lengths = np.array(row["lengths"], np.int64)
        held = _Strings(row, dict(zip(found["bucket"].tolist(), found["marks"])), buckets, split)
        data, ends, base = held.data, held.ends, held.base
        gone = _covered(held, dict(zip(found["bucket"].tolist(), zip(found["least"], found["mixed"], found["inner"]))))
        removed = np.concatenate([[0], np.cumsum(gone)])
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = base[(lengths > 0)]
        begins[inner] = gone[inner]  # a run ends with its document
        spans = np.concatenate([[0], np.cumsum(begins)])
        whole, left = data[~gone].tobytes(), np.concatenate([[0], np.cumsum(~gone)])
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if i is None or i != i else int(i) for i in row["ids"]], "Int64"),
                "n_bytes": lengths,
                "n_removed": removed[ends] - removed[base],
                "n_spans": spans[ends] - spans[base],
                "kept": [whole[a:b] for a, b in zip(left[base].tolist(), left[ends].tolist())],
                "carried": list(row["carried"]),
            }
        )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, carried string"
    out = shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(cut, schema)
    return out.drop("carried") if carried is None else out


def without_repeats(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The rows of ``docs`` with the bytes gone that earlier documents have; n_chars follows the text.

    Rows that lose their whole text go. Characters of which a byte is gone go as a whole. The other columns are carried
    along as JSON. Null texts become empty.
    """
    row = T.StructType([field for field in docs.schema.fields if field.name != "text"])
    found = remove_repeats(docs, shard, F.to_json(F.struct(*[f"`{name}`" for name in row.names])))
    left = found.filter((F.col("n_removed") < F.col("n_bytes")) | (F.col("n_bytes") == 0))
    text = F.when(F.col("n_removed") == 0, F.col("kept").cast("string")).otherwise(_whole_characters(F.col("kept")))
    back = left.select(F.from_json("carried", row).alias("row"), text.alias("text"))
    columns = {name: F.col("row")[name] for name in row.names} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast("long")
    return back.select([columns[name].cast(docs.schema[name].dataType).alias(name) for name in docs.columns])


@F.pandas_udf(T.StringType())
def _whole_characters(kept: pd.Series) -> pd.Series:
    return kept.map(lambda data: bytes(data).decode("utf-8", "ignore"))

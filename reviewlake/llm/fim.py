"""Fill-in-the-middle texts by displacement scatter.

A text is cut into tokens, runs of ASCII letters or single other code points, and two draws by its doc_id cut the tokens
into prefix, middle and suffix. All texts of a batch lie one after another in one array of bytes. A part moves as a whole, so
the difference of its shift to that of the part before it is noted where it begins; the cumulative sum is every byte's
displacement, and one scatter writes all outputs. Restoring finds the three marks of every output, notes differences where
the parts belong in the text, and gathers the bytes back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import by_size, give_back, identifier, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts, those that are cut, and of 100 cut ones, those whose suffix comes first.
CUT, SUFFIX_FIRST = 90, 20
#: Bytes of texts moved at a time, one text at least; a byte takes some sixty while it is moved.
BATCH = 1 << 18


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column without nulls, one value after another, and where each value ends."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def parted(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The other way round: values of ``data`` that end at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), buffers).cast(pa.binary())


def token_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where tokens begin: at every code point but letters that follow a letter of the same text."""
    letter = ((data | 0x20) - np.uint8(ord("a"))) < 26
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    begins = ends[:-1]
    starts[begins[begins < len(data)]] = True
    return np.flatnonzero(starts)


def places(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where ``mark`` begins."""
    n = max(0, len(data) - len(mark) + 1)
    hit = np.ones(n, bool)
    for i, byte in enumerate(mark):
        hit &= data[i : i + n] == byte
    return np.flatnonzero(hit)


def _owners(at: np.ndarray, size: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text each of the places lies in, and whether ``size`` bytes from there do."""
    text = np.searchsorted(ends, at, side="right")
    return text, at + size <= ends[text]


def _shifts(size: int, at: list[np.ndarray], shift: list[np.ndarray]) -> np.ndarray:
    """The displacement of each of ``size`` bytes, from difference arrays: part k of every text begins at ``at[k]``.

    Parts come by place, text by text; empty ones take no byte, since what is noted at one place adds up.
    """
    begins, moved = np.stack(at, axis=1).ravel(), np.stack(shift, axis=1).ravel()
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begins, np.diff(moved, prepend=0))
    return np.cumsum(change[:-1])


def scatter(
    data: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray, form: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends) of all outputs; a text's middle lies from ``first`` to ``second``, its form is 0 plain, 1 psm, 2 spm."""
    starts = ends - np.diff(ends, prepend=0)
    marks = len(PREFIX) + len(SUFFIX) + len(MIDDLE)
    size = ends - starts + np.where(form > 0, marks, 0)
    out_ends = np.cumsum(size)
    begin = out_ends - size
    prefix, suffix = first - starts, ends - second
    prefix_mark = np.where(form == 2, begin + len(SUFFIX) + suffix, begin)
    suffix_mark = np.where(form == 2, begin, begin + len(PREFIX) + prefix)
    middle_mark = begin + len(PREFIX) + len(SUFFIX) + prefix + suffix
    plain = begin - starts
    shift = [
        np.where(form > 0, mark + len(text) - at, plain)
        for mark, text, at in ((prefix_mark, PREFIX, starts), (middle_mark, MIDDLE, first), (suffix_mark, SUFFIX, second))
    ]
    out = np.zeros(out_ends[-1] if len(out_ends) else 0, np.uint8)
    out[np.arange(len(data)) + _shifts(len(data), [starts, first, second], shift)] = data
    cut = form > 0
    for mark, text in ((prefix_mark, PREFIX), (suffix_mark, SUFFIX), (middle_mark, MIDDLE)):
        out[mark[cut, None] + np.arange(len(text))] = np.frombuffer(text, np.uint8)
    return out, out_ends


def gather(data: np.ndarray, ends: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends) of the texts that outputs of these forms were made of."""
    starts = ends - np.diff(ends, prepend=0)
    cut = np.flatnonzero(form > 0)
    found = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        text, inside = _owners(at := places(data, mark), len(mark), ends)
        at, text = at[inside & (form[text] > 0)], text[inside & (form[text] > 0)]
        if not np.array_equal(text, cut):
            raise ValueError(f"an output that is not plain has no mark {mark!r}, or several")
        found[mark] = np.zeros(len(ends), np.int64)
        found[mark][cut] = at
    prefix, suffix, middle = (found[mark] for mark in (PREFIX, SUFFIX, MIDDLE))
    marks = len(PREFIX) + len(SUFFIX) + len(MIDDLE)
    size = ends - starts - np.where(form > 0, marks, 0)
    out_ends = np.cumsum(size)
    begin = out_ends - size
    prefix_size = np.where(form == 2, middle, suffix) - prefix - len(PREFIX)
    middle_size = ends - middle - len(MIDDLE)
    source = [prefix + len(PREFIX), middle + len(MIDDLE), suffix + len(SUFFIX)]
    at = [begin, begin + prefix_size, begin + prefix_size + middle_size]
    at = [np.where(form > 0, a, begin) for a in at]
    shift = [np.where(form > 0, s - a, starts - begin) for s, a in zip(source, at)]
    total = int(out_ends[-1]) if len(out_ends) else 0
    return data[np.arange(total) + _shifts(total, at, shift)], out_ends


def _draw(number: int, seed: str) -> Column:
    """The ``number``-th 32 bits of the row's hash, null without doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), identifier().cast("string")), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long").alias(f"h{number}")


def transform(docs: DataFrame, seed: str = "1", cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row: its tokens, form and output as UTF-8 bytes.

    Null texts are empty. Empty texts, texts that hold a mark, rows without doc_id, which have no draws, and all but ``cut``
    of 100 others stay plain, without prefix_chars and middle_chars. Repeated rows give repeated rows, an empty table an
    empty one; no other column of ``docs`` is read. A long text is moved by itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, 1, BATCH):
            data, ends = joined(batch.column(1))
            starts = ends - np.diff(ends, prepend=0)
            known = np.array(batch.column(2).is_valid())
            h1, h2, h3, h4 = (np.array(batch.column(i).fill_null(0), np.int64) for i in range(2, 6))
            at = np.append(token_starts(data, ends), len(data))
            rank = np.searchsorted(at, starts)
            n = np.searchsorted(at, ends) - rank
            a, b = h1 % (n + 1), h2 % (n + 1)
            first, second = at[rank + np.minimum(a, b)], at[rank + np.maximum(a, b)]
            marked = np.zeros(len(ends), bool)
            for mark in (PREFIX, SUFFIX, MIDDLE):
                text, inside = _owners(places(data, mark), len(mark), ends)
                marked[text[inside]] = True
            plain = ~known | (n == 0) | marked | (h3 % 100 >= cut)
            form = np.where(plain, 0, np.where(h4 % 100 < suffix_first, 2, 1))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            out, out_ends = scatter(data, ends, np.where(plain, starts, first), np.where(plain, starts, second), form)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "n": pa.array(n, pa.int64()),
                "form": pa.array(np.array([PLAIN, PSM, SPM], object)[form], pa.string()),
                "prefix_chars": pa.array(chars[first] - chars[starts], pa.int64(), mask=plain),
                "middle_chars": pa.array(chars[second] - chars[first], pa.int64(), mask=plain),
                "output": parted(out, out_ends),
            })
        give_back()

    rows = docs.select(identifier().alias("doc_id"), utf8().alias("text"), *[_draw(i, seed) for i in (1, 2, 3, 4)])
    return rows.mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    )


def restore(made: DataFrame) -> DataFrame:
    """``made`` with ``restored``, the bytes of the text that ``form`` and ``output`` were made of.

    Rows without a form are plain, null outputs empty. An output that is not plain and lacks a mark is an error.
    """
    names = made.columns
    if {"form", "output"} - set(names) or "restored" in names:
        raise ValueError("form and output are needed, and no column restored")
    form, output = names.index("form"), names.index("output")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, output, BATCH):
            kinds = [{PSM: 1, SPM: 2}.get(kind, 0) for kind in batch.column(form).to_pylist()]
            data, ends = joined(batch.column(output).fill_null(b""))
            back, back_ends = gather(data, ends, np.array(kinds, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, parted(back, back_ends)], names=[*names, "restored"])
        give_back()

    return made.mapInArrow(run, made.selectExpr("*", "cast(null as binary) AS restored").schema)

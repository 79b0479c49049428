"""Pre-tokens of the byte-level pattern without a regular expression.

Every code point becomes a symbol that knows its class and the few code points after it. A symbol is a function from
the state before it to the state after it, and the finite set of all functions that arise by composing symbols is
numbered, with a table for the number of a composition. Composition is associative: columns of blocks are composed
in step with each other, the totals of the blocks are scanned, and both give the state before every code point, which
tells where tokens begin.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np

#: The code points of Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
#: What may follow an apostrophe at the start of a token.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Letters and numbers of Unicode 16, which the interpreter's tables may not know yet.
NEWER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEWER_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)

END, LETTER, NUMBER, OTHER, SPACE = range(5)  # classes; END is no code point but the end of a text
# Symbols: white space is either before a token (a blank joins it, other white space stands alone) or within a run.
S_END, S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_JOIN, S_ALONE, S_RUN = range(9)
# States: what the code points so far leave open.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_RUN, ONE_LEFT, TWO_LEFT = range(8)
_STATES = 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token begins at the symbol."""
    if symbol == S_END:
        return CLOSED, False
    if symbol == S_LETTER:
        if state in (ONE_LEFT, TWO_LEFT):
            return (CLOSED if state == ONE_LEFT else ONE_LEFT), False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_BLANK)
    if symbol == S_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_BLANK)
    if symbol in (S_OTHER, S_SHORT, S_LONG):
        if state in (IN_OTHERS, AFTER_BLANK):
            return IN_OTHERS, False
        return {S_OTHER: IN_OTHERS, S_SHORT: ONE_LEFT, S_LONG: TWO_LEFT}[symbol], True
    if symbol == S_JOIN:
        return AFTER_BLANK, True
    if symbol == S_ALONE:
        return CLOSED, True
    return IN_RUN, state != IN_RUN


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of code points; functions of symbols; composition; results of functions; where tokens begin."""
    kinds = np.full(sys.maxunicode + 2, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = NUMBER
    for kind, ranges in ((LETTER, NEWER_LETTERS), (NUMBER, NEWER_NUMBERS)):
        for first, last in ranges:
            kinds[first : last + 1] = kind
    kinds[list(WHITE_SPACE)] = SPACE
    kinds[-1] = END
    symbols = [tuple(_step(state, symbol)[0] for state in range(_STATES)) for symbol in range(9)]
    number = {tuple(range(_STATES)): 0}
    functions = list(number)
    for function in functions:  # grows until compositions are closed
        for symbol in symbols:
            after = tuple(symbol[state] for state in function)
            if after not in number:
                number[after] = len(functions)
                functions.append(after)
    compose = np.array(
        [[number[tuple(g[state] for state in f)] for g in functions] for f in functions], np.uint16
    )
    begins = np.array([[_step(state, symbol)[1] for symbol in range(9)] for state in range(_STATES)])
    return kinds, np.array([number[s] for s in symbols], np.uint16), compose, np.array(functions, np.uint8), begins


def _symbols(points: np.ndarray) -> np.ndarray:
    kinds = _tables()[0][points]
    after = np.append(kinds[1:], END)
    out = np.array([S_END, S_LETTER, S_NUMBER, S_OTHER, S_RUN], np.uint8)[kinds]
    before_token = (kinds == SPACE) & (after != SPACE) & (after != END)
    out[before_token] = np.where(points[before_token] == 0x20, S_JOIN, S_ALONE)
    quotes = np.flatnonzero(points[:-2] == 0x27)
    if len(quotes):
        first, second = points[quotes + 1], points[quotes + 2]
        for ending in CONTRACTIONS:
            fits = first == ord(ending[0])
            if len(ending) == 2:
                fits = fits & (second == ord(ending[1]))
            out[quotes[fits]] = S_SHORT if len(ending) == 1 else S_LONG
    return out


def _states_before(symbols: np.ndarray, block: int = 256) -> np.ndarray:
    """The state before every symbol, by a scan of composed functions."""
    _, function_of, compose, results, _ = _tables()
    n, size = len(symbols), len(compose)
    flat = compose.ravel()
    rows = -(-n // block)
    steps = np.zeros(rows * block, np.uint16)  # 0 is the identity
    steps[:n] = function_of[symbols]
    columns = np.ascontiguousarray(steps.reshape(rows, block).T)
    inner = np.empty_like(columns)
    running = np.zeros(rows, np.uint16)
    for i in range(block):
        inner[i] = running
        running = flat[running.astype(np.int32) * size + columns[i]]
    totals, reach = running, 1
    while reach < rows:  # doubling scan of the blocks' totals
        later = totals.copy()
        later[reach:] = flat[totals[:-reach].astype(np.int32) * size + totals[reach:]]
        totals, reach = later, reach * 2
    before = np.concatenate([np.zeros(1, np.uint16), totals[:-1]])
    whole = flat[before.astype(np.int32)[None, :] * size + inner]
    return results[:, CLOSED][whole].T.ravel()[:n]


def token_slices(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(data, bounds, firsts): token i is data[bounds[i]:bounds[i + 1]]; text t has tokens firsts[t] to firsts[t + 1].

    ``data`` is the UTF-8 of all texts one after another.
    """
    joined = "".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = joined.encode("utf-8")
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    ends = np.cumsum(lengths)
    marked = np.insert(points, ends, sys.maxunicode + 1)  # the end of each text
    marked = np.append(marked, np.array([sys.maxunicode + 1] * 2, marked.dtype))
    symbols = _symbols(marked)
    begins = _tables()[4][_states_before(symbols), symbols]
    at = np.flatnonzero(begins)
    text_of = np.searchsorted(ends + np.arange(len(ends)), at, side="left")  # positions in ``marked``
    starts = at - text_of
    if len(data) == len(points):
        offsets = starts
    else:
        sizes = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(sizes)])[starts]
    firsts = np.searchsorted(text_of, np.arange(len(texts) + 1), side="left")
    return data, np.append(offsets, len(data)), firsts

"""A run of bytes that very many strings hold does not put them all into one group."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from reviewlake.llm import bwt_dedup
from tests.llm.test_operators import _without

LINE = "-" * 40


def _rows() -> list[tuple[int, str]]:
    rng = random.Random(6)

    def words(n: int) -> str:
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))

    rows = [(i, f"{words(12)}\n{LINE}\n{words(12)}") for i in range(300)]
    rows += [(300 + i, f"{words(9)} {rows[i][1][20:150]} {words(9)}") for i in range(0, 60, 3)]
    return rows + [(400, "-" * 500), (401, "x" + "-" * 300), (402, ""), (403, rows[5][1])]


def _most(data: np.ndarray, ends: np.ndarray, **more) -> Counter:
    held: dict[int, set[bytes]] = {}
    _, first, windows, anchor = bwt_dedup.anchored(data, ends, **more)
    for a, n, name in zip(first.tolist(), windows.tolist(), anchor.tolist()):
        held.setdefault(name, set()).add(data[a : a + n + bwt_dedup.WIDTH - 1].tobytes())
    return Counter({name: len(strings) for name, strings in held.items()})


def test_parted_windows_do_not_meet():
    texts = [text.encode() for _, text in _rows()]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(text) for text in texts])
    sizes = _most(data, ends)
    hot = np.sort(np.array([name for name, n in sizes.items() if n > 50], np.uint64))
    assert len(hot) and max(sizes.values()) > 200
    assert max(_most(data, ends, hot=hot).values()) <= bwt_dedup.WINDOWS


def test_results_are_the_same(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = _without([(i, text.encode()) for i, text in rows])
    for hot in (20, bwt_dedup.HOT):
        found = bwt_dedup.remove_repeats(docs, 3000, hot=hot, one_in=1).collect()
        assert Counter((*r[:4], bytes(r[4])) for r in found) == wanted
    dealt = bwt_dedup._anchor_rows(bwt_dedup.document_shards(docs, 3000), 8, 1)
    assert len(bwt_dedup._hot_anchors(dealt, 20, 1)) > 0 == len(bwt_dedup._hot_anchors(dealt, bwt_dedup.HOT, 1))

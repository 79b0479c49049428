"""Fingerprints of long texts keep every closed syncmer."""

from __future__ import annotations

import random

import numpy as np

from reviewlake.llm import syncmers


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(n))


def test_every_closed_syncmer_is_kept_with_its_place():
    text = (_words(random.Random(1), 2000) + "ab" * 300).encode()
    inner = syncmers._mixed(_hashes(text, syncmers.INNER))
    edges = syncmers.WIDTH - syncmers.INNER
    wanted = [i for i in range(len(text) - syncmers.WIDTH + 1) if min(inner[i : i + edges + 1]) in (inner[i], inner[i + edges])]
    (sketch,) = syncmers.sketches([text])
    assert sorted(sketch[1].tolist()) == wanted and len(wanted) > 2000
    again = syncmers.parsed(syncmers.printed(sketch))
    assert all(np.array_equal(x, y) for x, y in zip(sketch, again))


def _hashes(text: bytes, length: int) -> np.ndarray:
    runs = (np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * np.uint64(syncmers._BASE)
    size = 1
    while size < length:
        runs, size = syncmers._doubled(runs, size), 2 * size
    return runs


def test_a_short_shared_passage_and_a_small_change_show_in_long_texts():
    rng = random.Random(2)
    passage = _words(rng, 50)
    a, b = (f"{_words(rng, 10_000)} {passage} {_words(rng, 10_000)}".encode() for _ in range(2))
    changed = a[:50_000] + _words(rng, 50)[:200].encode() + a[50_200:]
    one, other, new, none = syncmers.sketches([a, b, changed, _words(rng, 20_000).encode()])
    shared = syncmers.likeness(one, other) * (len(one[0]) + len(other[0]))
    assert 50 <= shared <= 120 and syncmers.likeness(one, none) < syncmers.likeness(one, other) / 10
    assert 0.98 < syncmers.likeness(one, new) < 1.0 and syncmers.printed(one) != syncmers.printed(new)


def test_likeness_is_a_share_in_one_order():
    rng = random.Random(3)
    first, second = (_words(rng, 400).encode() for _ in range(2))
    a, b, twice = syncmers.sketches([first + second, second + first, first + first])
    assert syncmers.likeness(a, a) == syncmers.likeness(twice, twice) == 1.0
    assert 0.3 < syncmers.likeness(a, b) < 0.6
    assert 0.4 < syncmers.likeness(syncmers.sketches([first])[0], twice) < 0.6

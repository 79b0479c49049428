"""What many shards send to one index is little each: it is transformed together, and found as before."""

from __future__ import annotations

import numpy as np

from reviewlake.llm import bwt_dedup


def test_little_of_many_shards_is_transformed_together(monkeypatch):
    rng = np.random.default_rng(2)
    parts = [rng.integers(97, 123, 60, np.uint8).tobytes() for _ in range(40)]
    texts = list({b"".join(parts[i] for i in rng.integers(0, 40, 2)) for _ in range(400)})
    least = rng.permutation(len(texts)).astype(np.int64)
    shard = np.arange(len(texts)) % 300
    made, real = [], bwt_dedup.transform
    monkeypatch.setattr(bwt_dedup, "transform", lambda strings, width: made.append(len(strings)) or real(strings, width))
    for size, most in ((bwt_dedup.TRANSFORMED, 1), (1 << 12, 12)):
        monkeypatch.setattr(bwt_dedup, "TRANSFORMED", size)
        made.clear()
        numbers = {text: i for i, text in enumerate(texts)}
        found = bwt_dedup._window_owners(numbers, least, np.zeros(len(texts), np.uint32), shard)
        assert 0 < len(made) <= most and sum(made) == len(found) == len(texts)
        owner: dict[bytes, int] = {}
        for text, document in zip(texts, least.tolist()):
            for at in range(len(text) - 49):
                owner[text[at : at + 50]] = min(document, owner.get(text[at : at + 50], document))
        for i, text in enumerate(texts):
            assert found[i].tolist() == [owner[text[at : at + 50]] for at in range(len(text) - 49)]


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(0, 4, 5000, np.uint8)
    data[2000:2600] = 7
    lengths = [0, 49, 50, 0, 1901, 3, 900, 0, 2097, 0]
    ends = np.cumsum(lengths)
    assert ends[-1] == len(data)
    whole = bwt_dedup.anchored(data, ends)
    hot = np.unique(whole[3])[::3]
    parted = bwt_dedup.anchored(data, ends, hot=hot)
    monkeypatch.setattr(bwt_dedup, "PIECE", 37)
    for wanted, found in ((whole, bwt_dedup.anchored(data, ends)), (parted, bwt_dedup.anchored(data, ends, hot=hot))):
        assert all(np.array_equal(a, b) for a, b in zip(wanted, found))
    inside = sum(max(0, n - 49) for n in lengths)
    assert whole[2].sum() == parted[2].sum() == inside and whole[2].max() <= bwt_dedup.WINDOWS
    for document, first, windows, _ in zip(*whole):
        assert ends[document] - lengths[document] <= first and first + windows + 49 <= ends[document]

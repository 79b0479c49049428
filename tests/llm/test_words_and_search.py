"""De Bruijn word dedup, reversed search and fill-in-middle against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import debruijn, fim, reversed_search
from tests.llm.test_operators import ROWS, WORDS, bag, docs, empty, plain  # noqa: F401


def _without(rows: list[tuple[int | None, str | None]], window: int) -> Counter:
    split = [(math.inf if i is None else i, plain(text).encode().split()) for i, text in rows]
    least: dict[tuple, float] = {}
    for i, words in split:
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            least[key] = min(i, least.get(key, math.inf))
    out: Counter = Counter()
    for i, words in split:
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if least[tuple(words[at : at + window])] < i:
                gone[at : at + window] = [True] * window
        kept = b" ".join(word for word, out_of in zip(words, gone) if not out_of)
        out[None if i == math.inf else i, len(words), sum(gone), kept] += 1
    return out


def _found(rows) -> Counter:
    return Counter((row["doc_id"], row["n_words"], row["n_removed"], bytes(row["kept"])) for row in rows)


@pytest.mark.parametrize(("window", "run", "shard"), [(50, 16, 4 << 20), (20, 16, 3000), (5, 16, 900), (2, 1, 1)])
def test_debruijn(docs, window, run, shard):
    assert _found(debruijn.remove_repeats(docs, window, run, shard).collect()) == _without(ROWS, window)


def test_debruijn_crowds_and_branches(spark):
    """One passage in a third of all rows, copies that branch off each other, and texts that repeat within themselves."""
    rng = random.Random(1)

    def made(n: int) -> list[str]:
        return [f"w{rng.randrange(40)}" for _ in range(n)]

    common, base = made(30), made(80)
    rows = []
    for i in range(150):
        words = made(rng.randrange(5, 60))
        if i % 3 == 0:
            words = words + common + made(4)
        elif i % 3 == 1:
            cut = rng.randrange(80)
            words = base[:cut] + made(rng.randrange(2)) + base[cut + rng.randrange(3) :]
        elif i % 5 == 0:
            words = made(3) * 12 + common[:20]
        rows.append((rng.randrange(120), " ".join(words)))
    rows += [(500 + i, "a " * (40 + i)) for i in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for shard in (500, 2000, 1 << 20):
        assert _found(debruijn.remove_repeats(table, 8, 3, shard).collect()) == _without(rows, 8)


def test_debruijn_of_nothing(empty, docs):
    assert debruijn.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        debruijn.remove_repeats(docs, window=1)


def test_run_hashes_and_least_values():
    words = np.array([random.Random(5).getrandbits(64) for _ in range(60)], np.uint64)
    base = debruijn._BASE
    for length in (1, 2, 3, 16, 49, 60, 61):
        wanted = [
            sum(int(word) * pow(base, length - 1 - j, 1 << 64) for j, word in enumerate(words[i : i + length])) % (1 << 64)
            for i in range(max(0, 61 - length))
        ]
        assert debruijn.run_hashes(words, length).tolist() == wanted
    for span in (1, 2, 7, 35, 60):
        assert debruijn.least_of(words, span).tolist() == [min(words[i : i + span].tolist()) for i in range(61 - span)]


def test_local_paths_go_through_unbranched_nodes():
    # Nodes by word; the walks 1 2 3 4 and 9 2 3 5 meet between 2 and 3, and 7 8 stands alone.
    nodes = np.array([1, 2, 3, 4, 0, 9, 2, 3, 5, 0, 7, 8], np.uint64)
    at = np.array([0, 1, 2, 5, 6, 7, 10])
    first, length = debruijn.local_paths(at, nodes)
    assert list(zip(at[first].tolist(), length.tolist())) == [(0, 1), (1, 1), (2, 1), (5, 1), (6, 1), (7, 1), (10, 1)]
    # The same walk twice is one path of three windows.
    nodes = np.array([1, 2, 3, 4, 0, 1, 2, 3, 4], np.uint64)
    at = np.array([0, 1, 2, 5, 6, 7])
    first, length = debruijn.local_paths(at, nodes)
    assert list(zip(at[first].tolist(), length.tolist())) == [(0, 3), (5, 3)]


_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text: str | None) -> list[str]:
    return _TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), plain(text)))


def _ranked(rows, items, k: int) -> Counter:
    held = [(math.inf if i is None else i, Counter(_terms(text))) for i, text in rows]
    number = sum(1 for _, counts in held if counts)
    total = sum(sum(counts.values()) for _, counts in held)
    df = Counter(term for _, counts in held for term in counts)
    out: Counter = Counter()
    for item, text in items:
        scores = []
        for doc, counts in held:
            norm = 10 + 90 * sum(counts.values()) * number // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[term] + 1)))
                * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 8 * norm))
                for term in set(_terms(text))
                if counts[term]
            )
            if score > 0:
                scores.append((-score, doc))
        for rank, (score, doc) in enumerate(sorted(scores)[:k]):
            out[item, rank + 1, None if doc == math.inf else doc, -score] += 1
    return out


@pytest.mark.parametrize("block", [1, 120, 1 << 20])
def test_reversed_search(spark, docs, block, monkeypatch):
    monkeypatch.setattr(reversed_search, "CELLS", 37)
    monkeypatch.setattr(reversed_search, "PIECE", 50)
    items = [(1, "The STONE moon"), (2, "grass don't it's"), (2, "wind, 42"), (None, "of river"), (3, None), (4, ""), (5, "absent")]
    items += [(6, "ÜNDIG Élan 日本 the the"), (7, "-- .. --"), (8, " ".join(WORDS) * 3)]
    table = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, place int, salt string")
    found = reversed_search.search(docs, table, 10, block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert bag(found.collect()) == _ranked(ROWS, items, 10)


def test_reversed_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame([(1, "stone")], "item_id long, text string")
    assert reversed_search.search(empty, items).count() == 0
    assert reversed_search.search(docs, items.limit(0)).count() == 0
    assert reversed_search.search(docs.withColumn("text", F.lit("- -")), items).count() == 0


def test_heaps_keep_the_best_and_ties_by_least_doc_id():
    rng = random.Random(2)
    heaps, given = reversed_search.Heaps(3, 4), []
    for _ in range(20):
        rows = [(rng.randrange(3), rng.randrange(1, 6), rng.randrange(50), rng.random() < 0.9) for _ in range(rng.randrange(12))]
        given += rows
        rows = [row for row in rows if row[1] >= heaps.least[row[0]]]
        heaps.update(*(np.array([row[i] for row in rows], bool if i == 3 else np.int64) for i in range(4)))
    order = sorted(given, key=lambda row: (row[0], -row[1], not row[3], row[2]))
    wanted = [row for item in range(3) for row in [row for row in order if row[0] == item][:4]]
    assert list(zip(heaps.item.tolist(), heaps.score.tolist(), heaps.doc.tolist(), heaps.known.tolist())) == wanted


def _middled(doc_id: int | None, text: str) -> tuple:
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    if doc_id is None:
        return n, "plain", None, None, text
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (tokens[:a], tokens[a:b], tokens[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("batch", [1, 500, 1 << 20])
def test_fill_in_middle(spark, batch, monkeypatch):
    monkeypatch.setattr(fim, "BATCH", batch)
    rng = random.Random(8)
    rows = ROWS + [(300, "a <P> b"), (301, "<S>"), (302, "x<M"), (303, ">y"), (304, "<P"), (305, "<<S>>"), (306, "<"), (307, ">")]
    rows += [(400 + i, "".join(rng.choice("aB<>PSM é日\n\x00😀") for _ in range(rng.randrange(40)))) for i in range(200)]
    table = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, form string, h1 int").repartition(3)
    found = fim.restore(fim.transform(table)).collect()
    wanted = Counter((i, *_middled(i, plain(t)), plain(t)) for i, t in rows)
    got = Counter((*row[:5], bytes(row["output"]).decode(), bytes(row["restored"]).decode()) for row in found)
    assert got == wanted
    assert {row["form"] for row in found} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_nothing_and_of_broken_outputs(spark, empty):
    assert fim.restore(fim.transform(empty)).count() == 0
    rows = [(None, None), ("plain", bytearray(b"<P>")), (None, bytearray(b"x")), ("psm", bytearray(b"<P>a<S>c<M>b"))]
    made = spark.createDataFrame(rows, "form string, output binary")
    assert sorted(bytes(row["restored"]) for row in fim.restore(made).collect()) == [b"", b"<P>", b"abc", b"x"]
    with pytest.raises(Exception, match="has no mark"):
        fim.restore(spark.createDataFrame([("psm", bytearray(b"<P>a<S>c"))], "form string, output binary")).collect()

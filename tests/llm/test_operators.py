"""Every operator on a small table with nulls, empty, long and repeated texts, ties and clashing columns, against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewlake.llm import (
    backoff_lm, bwt_dedup, byte_bpe, direct_codes, packing, pretokens, secrets, simhash, syncmers, toxicity, va_search,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = "the of river ündig stone Élan moon 42 wind, don't it's (so) 日本 grass old-new\tfar\nnear".split(" ")


def _texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    made = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(3, 90))) for _ in range(24)]
    passage = " ".join(rng.choice(WORDS) for _ in range(40))
    made[3] += passage
    made[9] = passage + made[9]
    made[11] = made[2]
    made[12] = made[2] + "."
    rows: list[tuple[int | None, str | None]] = [(7 * i % 101, text) for i, text in enumerate(made)]
    rows += [(200, None), (201, ""), (202, ""), (203, " \n\t "), (204, "a"), (205, "ab" * 4000), (206, "ba" * 100)]
    rows += [(207, " ".join(rng.choice(WORDS) for _ in range(9000)))]
    rows += [(208, "pass \"password = 'hunter22x'; token:abc secret=12345 AKIA" + "Z9" * 9 + " " + "0f" * 14)]
    rows += [(209, "API_KEY: é" + "deadbeef" * 3 + "é passwd=token=abcdef"), (210, "-----BEGIN RSA PRIVATE KEY-----")]
    return rows + [rows[4], (None, "no number here " * 12), (None, None)]


ROWS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "src", None if t is None else len(t), 0, "x") for i, t in ROWS]
    schema = "doc_id long, text string, source string, n_chars long, fp long, part string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def bag(rows) -> Counter:
    return Counter(tuple(row) for row in rows)


def plain(text: str | None) -> str:
    return text or ""


def test_toxicity(spark, docs, empty):
    rng = random.Random(3)
    texts = []
    for i in range(400):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(20, 60))]
        if i % 5 == 0:
            words[3:3] = ["grubby", "vile"]
        texts.append((i, " ".join(words)))
    table = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 400, 2)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = {row["doc_id"]: row for row in toxicity.scored(table, labels).collect()}
    assert len(found) == 400 and all(0 <= row["score"] <= 1 for row in found.values())
    assert all(row["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, row in found.items())
    right = [found[i]["predicted"] == int(i % 5 == 0) for i in found if found[i]["held_out"]]
    assert np.mean(right) > 0.95
    assert toxicity.scored(docs, labels).count() == len(ROWS)
    assert toxicity.scored(empty, labels).count() == 0
    none = toxicity.scored(docs, labels.limit(0)).agg(F.max("score")).first()[0]
    assert none == 0.0


def test_risk_is_never_corrected_below_zero():
    columns, firsts = np.array([0, 0]), np.array([0, 1, 2])
    slope, _, risk = toxicity._gradient(np.array([5.0]), 0.0, columns, firsts, np.array([True, False]), 0.9)
    assert risk >= 0 and np.isfinite(slope).all()


def test_syncmers(docs, empty):
    found = syncmers.with_next(docs).collect()
    assert len(found) == len(ROWS)
    order = sorted(((-(1 << 63) if i is None else i, plain(t).encode()) for i, t in ROWS), key=lambda r: (-r[0], r[1]))
    texts = [t.decode() for _, t in order]
    wanted = Counter()
    for a, b in zip(texts, texts[1:] + texts[:1]):
        cut = len(a) // 3
        wanted[len(a), (a[: len(a) - cut] + b[:cut]).encode()] += 1
    assert Counter((r["n_chars"], bytes(r["edited"])) for r in found) == wanted
    prints = {r["doc_id"]: r["fingerprint"] for r in found if r["doc_id"] is not None}
    assert prints[201] == prints[202] == prints[200] == "" and prints[14] == prints[7 * 11 % 101]
    near = [r["near_edited"] for r in found if r["n_chars"] > 300 and r["doc_id"] not in (205, 206)]
    assert min(near) > 0.2
    sketch = syncmers.sketches([b"one long enough text for a few anchors in it"])[0]
    assert syncmers.likeness(sketch, syncmers.parsed(syncmers.printed(sketch))) == 1.0
    assert syncmers.with_next(empty).count() == 0
    assert syncmers.fingerprints(docs).count() == len(ROWS)


def _secrets(text: str) -> list[tuple[int, int, str, int]]:
    patterns = [(rule.pattern, rule.group, rule.least, rule.kind) for rule in secrets.RULES]
    patterns[1:3] = [("AKIA[A-Z0-9]+", 0, 20, "access"), ("[0-9a-f]+", 0, 24, "hex")]
    return sorted(
        (m.start(), place, kind, m.end())
        for place, (pattern, group, least, kind) in enumerate(patterns)
        for m in re.finditer(pattern, text)
        if len(m[group]) >= least
    )


def test_secrets(docs, empty, tmp_path):
    found = secrets.findings(docs, str(tmp_path / "ledger")).collect()
    assert bag((r["path"], tuple(map(tuple, r["spans"]))) for r in found) == bag(
        (i, tuple(_secrets(plain(t)))) for i, t in ROWS
    )
    assert any(len(r["spans"]) > 2 for r in found)
    assert secrets.findings(empty).count() == 0


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = spark.createDataFrame([("a", 1, "token=abcdef1"), ("b", 1, "clean")], "path string, version int, text string")
    later = spark.createDataFrame([("a", 2, "clean"), ("c", 1, "secret: abcdefg")], "path string, version int, text string")
    secrets.scan(first, ledger)
    before = spark.read.parquet(ledger).count()
    found = secrets.scan(first.union(later), ledger)
    assert before == 2 * len(secrets.RULES) and spark.read.parquet(ledger).count() == 3 * len(secrets.RULES)
    assert {(r["path"], r["version"]): len(r["spans"]) for r in found.collect()} == {("a", 1): 1, ("b", 1): 0, ("a", 2): 0, ("c", 1): 1}
    newer = (*secrets.RULES[1:], secrets.Rule("assign", 2, "clean", 0, 1, "clean"))
    again = {(r["path"], r["version"]): len(r["spans"]) for r in secrets.scan(first, ledger, newer).collect()}
    assert again == {("a", 1): 0, ("b", 1): 1} and spark.read.parquet(ledger).count() == 3 * len(secrets.RULES) + 2


def test_redaction(docs):
    found = {r["doc_id"]: r for r in secrets.redact(docs).filter("doc_id >= 200").collect()}
    assert found[200]["text"] is None and found[208]["text"].count("[secret]") == 3 and "AKIA" not in found[208]["text"]
    assert found[208]["n_chars"] == len(found[208]["text"]) and found[208]["source"] == "src"
    assert secrets.redact(docs).count() == len(ROWS)


def test_va_file(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 330)] + [rows[50], (400, None), (None, [0.1] * 6), (401, [1.0, None] * 3)]
    rows += [(402, [float("nan")] * 6), (403, [float("inf")] * 6), (404, [1e30] * 6), (450, []), (500, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = bag((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in va_search.top_k(table, "vec_id % 50 = 0").collect())
    top = (1 << 63) - 1
    fit = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit[i] = [min(top, math.floor(256 * x)) for x in v]
    wanted = Counter()
    for q, v in fit.items():
        if q % 50 == 0:
            scores = [(-min(top, max(-top - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in fit.items() if i != q and len(w) == len(v)]
            wanted.update((q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:5]))
    assert found == wanted
    assert va_search.top_k(table.limit(0), "vec_id % 50 = 0").count() == 0


def test_backoff_automaton(docs, empty):
    found = backoff_lm.score(docs, shard=2000).collect()
    tokens = [[w.decode() for w in plain(t).encode().lower().split()] + [""] for _, t in ROWS]
    folds = [None if i is None else zlib.crc32(str(i).encode()) % 7 for i, _ in ROWS]
    learnt = [t for t, f in zip(tokens, folds) if f is not None and f != 2]
    words, pairs = Counter(w for t in learnt for w in t), Counter(p for t in learnt for p in zip([None, *t], t))
    n, v, k = sum(words.values()), len(words), backoff_lm.CONTEXT_WEIGHT
    wanted = Counter()
    for (i, _), text, fold in zip(ROWS, tokens, folds):
        p = {w: (words[w] + 1) / (n + v + 1) for w in text}
        score = sum(math.log10((pairs[a, b] + k * p[b]) / ((words[""] if a is None else words[a]) + k)) for a, b in zip([None, *text], text))
        base = sum(math.log10(p[w]) for w in text)
        wanted[i, fold == 2, len(text), sum(words[w] > 0 for w in text), n, round(base, 6), round(score, 6)] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in found) == wanted
    assert backoff_lm.score(empty).count() == 0


def test_direct_codes(docs, empty):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(vocabulary)
    found = sorted(direct_codes.write_and_read(docs, vocabulary, 2).collect(), key=lambda r: r["start"])
    start = 0
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    wanted = Counter((i, np.array([*library.encode(plain(t), add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in ROWS)
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in found) == wanted
    assert direct_codes.write_and_read(empty, vocabulary, 2).count() == 0


def test_segment_random_access():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 300, 700), rng.integers(0, 1 << 32, 900), [0, 255, 256, 65535, 65536]]).astype("<u4")
    segment = direct_codes.Segment(direct_codes._segment([(5, ids[:10]), (None, ids[10:])], 3))
    assert [segment[i] for i in range(len(ids))] == ids.tolist() == segment.all().tolist()
    with pytest.raises(IndexError):
        segment[len(ids)]
    for first in (0, 1, 63, 64, 65, 511, 700, 1604, len(ids)):
        for last in (first, first + 1, first + 64, first + 513, len(ids)):
            last = min(last, len(ids))
            assert segment.between(first, last).tolist() == ids[first:last].tolist()


def test_a_document_is_read_without_the_others():
    ids = np.arange(5000, dtype="<u4") * 7919
    segment = direct_codes.Segment(direct_codes._segment([(1, ids[:2000]), (2, ids[2000:2100]), (3, ids[2100:])], 0))
    read: list[int] = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            read.append(at.stop - at.start if isinstance(at, slice) else 1)
            return np.asarray(self)[at]

    segment.levels = [(values.view(Watched), words, ranks) for values, words, ranks in segment.levels]
    assert segment.between(2000, 2100).tolist() == ids[2000:2100].tolist()
    assert sum(read) <= 100 * len(segment.levels)


def test_packing(spark, docs, empty):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(vocabulary)
    found = packing.placements(docs, vocabulary, 0, 256).toPandas()
    wanted = Counter()
    for i, text in ROWS:
        ids = np.array([*library.encode(plain(text), add_special_tokens=False).ids, 0], "<u4")
        pieces = -(-len(ids) // 256)
        cuts = [0, *[len(ids) - 256 * k for k in range(pieces - 1, -1, -1)]]
        wanted.update((-1 if i is None else i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:])))
    rows = found[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
    rows["doc_id"] = rows["doc_id"].fillna(-1).astype(int)
    assert Counter(rows.itertuples(index=False, name=None)) == wanted
    for _, held in found.sort_values("offset").groupby("sequence_id"):
        assert held["offset"].tolist() == (held["length"].cumsum() - held["length"]).tolist() and held["length"].sum() <= 256
    assert packing.placements(empty, vocabulary, 0).count() == 0
    whole = packing.sequences(docs, vocabulary, 0, 256).toPandas()
    assert sum(len(x) for x in whole["ids"]) == 4 * found["length"].sum()


def test_packing_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 50)
    items = spark.range(600).selectExpr("id AS item", "1 + (id * 7919) % 100 AS size")
    found = packing.pack(items, 100).join(items, "item").toPandas()
    assert len(found) == 600
    for _, held in found.sort_values("offset").groupby("bin"):
        assert held["offset"].tolist() == (held["size"].cumsum() - held["size"]).tolist() and held["size"].sum() <= 100
    assert found["bin"].nunique() <= 1.05 * -(-found["size"].sum() // 100) + 1


@pytest.mark.parametrize("sizes", [[60] * 400, [55] * 200 + [45] * 200, [100] * 300, [1] * 500])
def test_packing_of_bins_that_stay_underfull(spark, monkeypatch, sizes):
    monkeypatch.setattr(packing, "ITEMS", 40)
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size int")
    found = packing.pack(items, 100).join(items, "item").toPandas()
    fill = found.groupby("bin")["size"].sum()
    assert len(found) == len(sizes) and fill.max() <= 100
    least = sum(size > 50 for size in sizes) or -(-sum(sizes) // 100)
    assert len(fill) <= 1.05 * least + 1


def test_byte_bpe(docs, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = byte_bpe.decode(byte_bpe.encode(docs, RANKS), RANKS).collect()
    wanted = Counter((i, tuple(library.encode_ordinary(plain(t))), plain(t).encode()) for i, t in ROWS)
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in found) == wanted
    assert byte_bpe.encode(empty, RANKS).count() == 0
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab's t1re2vemlld  \n\t'!'é　-") for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["x" * 3000, " " * 700 + "a", "'s" * 50, ""]
    ids = byte_bpe.Encoder(RANKS).encode(texts)
    assert [np.frombuffer(i, "<i4").tolist() for i in ids] == [library.encode_ordinary(t) for t in texts]
    assert len(pretokens._tables()[2]) < 100


def _simhash(text: str) -> int:
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    prints = [_simhash(plain(t)) for _, t in ROWS]
    group = list(range(len(ROWS)))
    for _ in ROWS:
        for a, x in enumerate(prints):
            group[a] = min(group[b] for b, y in enumerate(prints) if (x ^ y).bit_count() <= 3)
    smallest = {g: min((i for (i, _), h in zip(ROWS, group) if h == g and i is not None), default=None) for g in group}
    wanted = Counter((i, f"{p:016x}", smallest[g]) for (i, _), p, g in zip(ROWS, prints, group))
    assert bag(simhash.near_duplicates(docs).collect()) == wanted
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id IN (14, 77)").count() == 1
    assert simhash.near_duplicates(empty).count() == 0


def test_golay_keys_meet_within_three_bits():
    rng = random.Random(9)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(4)):
            b ^= 1 << bit
        stored = simhash.stored_keys(np.array([a], np.uint64).view(np.int64))[0]
        _, looked = simhash.looked_up_keys(np.array([b], np.uint64).view(np.int64))
        assert set(stored.tolist()) & set(looked.tolist())


def _without(rows: list[tuple[int, bytes]], width: int = 50) -> Counter:
    least: dict[bytes, int] = {}
    for i, data in rows:
        for at in range(len(data) - width + 1):
            window = data[at : at + width]
            least[window] = min(i, least.get(window, i))
    out: Counter = Counter()
    for i, data in rows:
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - width + 1):
            if least[data[at : at + width]] < i:
                gone[at : at + width] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(data) else 0
        out[i, len(data), int(gone.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~gone])] += 1
    return out


def test_merged_bwt(docs, empty):
    wanted = _without([(1 << 62 if i is None else i, plain(t).encode()) for i, t in ROWS])
    for shard in (3000, 4 << 20):
        found = bwt_dedup.remove_repeats(docs, shard).collect()
        assert Counter((1 << 62 if r[0] is None else r[0], *r[1:4], bytes(r[4])) for r in found) == wanted
    assert bwt_dedup.remove_repeats(empty).count() == 0
    kept = bwt_dedup.without_repeats(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id = 201").count() == 1


def test_merge_finds_the_repeated_prefixes():
    rng = random.Random(4)
    shards = [["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))) for _ in range(6)] for _ in range(3)]
    made = [bwt_dedup.transform([np.frombuffer(s.encode(), np.uint8) for s in strings], 8) for strings in shards]
    rows, interval = bwt_dedup.merge([m[0] for m in made], 5)
    of_row = [shards[s][n][p : p + 5] for s, m in enumerate(made) for n, p in zip(m[1].tolist(), m[2].tolist())]
    found: dict[int, list[str]] = {}
    for row, number in zip(rows.tolist(), interval.tolist()):
        found.setdefault(number, []).append(of_row[row])
    counts = Counter(s[i : i + 5] for strings in shards for s in strings for i in range(len(s) - 4))
    assert {held[0]: len(held) for held in found.values()} == {p: n for p, n in counts.items() if n > 1}
    assert all(len(set(held)) == 1 for held in found.values())
    assert [found[n][0] for n in sorted(found)] == sorted(p for p, n in counts.items() if n > 1)

"""Language-model scores by a weighted backoff automaton over smoothed n-grams.

Counts are gathered from the whole corpus. Texts are stored in shards; a shard sends its distinct words and word pairs,
as hashes with their counts, to buckets, which add them up over all shards and send each shard the sums in the
order in which it asked. So a shard gets what its own texts need of a model of any size. The need becomes an
automaton: the root has an arc for every word, the state of a word has arcs for the pairs it begins, and failure arcs
lead from it to the root at the price of its backoff weight. Whatever arc a word takes leads to the state of that word, so
the steps of a shard's texts are taken all at once.

With c the counts in training tokens, N their number, V the distinct ones and K the weight of the shorter context:

    p(w) = (c(w) + 1) / (N + V + 1)        p(w | v) = (c(v w) + K p(w)) / (c(v) + K)

An unseen pair has K / (c(v) + K) p(w), so that is the backoff weight of v. The begin of a text is a context of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import document_shards, opened, shuffle_parts, written

SHARD = 8 << 20
CONTEXT_WEIGHT = 200.0
WORDS, PAIRS = 0, 1
END = b""
_BEGIN = 0x9E3779B97F4A7C15
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


class Automaton:
    """States with arcs (state, token) -> (weight, next state) and one failure arc each; state 0 is the root.

    ``keys``, the arcs' state * tokens + token, are in rising order. The root must have an arc for every token.
    """

    def __init__(
        self, tokens: int, keys: np.ndarray, weights: np.ndarray, nexts: np.ndarray, failure: np.ndarray, backoff: np.ndarray
    ) -> None:
        self.tokens, self.keys, self.weights, self.nexts, self.failure, self.backoff = tokens, keys, weights, nexts, failure, backoff

    def steps(self, states: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight, next state) of one step each, with the failure arcs it takes before there is an arc."""
        weight, state, after = np.zeros(len(states)), states.copy(), np.zeros(len(states), np.int64)
        left = np.arange(len(states))
        while len(left):
            wanted = state[left] * self.tokens + tokens[left]
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            held = self.keys[arc] == wanted
            weight[left[held]] += self.weights[arc[held]]
            after[left[held]] = self.nexts[arc[held]]
            left = left[~held]
            weight[left] += self.backoff[state[left]]
            state[left] = self.failure[state[left]]
        return weight, after

    def walk(self, start: int, tokens: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The weights of the steps along texts that begin at ``firsts``, each from state ``start``.

        Of texts whose every step leads to the state of its token, all steps are taken at once.
        """
        states = np.append(start, tokens[:-1] + 1)
        states[firsts] = start
        weight, after = self.steps(states, tokens)
        if (after != tokens + 1).any():
            raise ValueError("a step leads to another state than that of its token")
        return weight


def bigram_automaton(words: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], total: int, distinct: int,
                     documents: int, weight: float) -> Automaton:
    """Of the words' counts and the pairs (first, second, count) in order; first is a word, or the number of words at a begin.

    State w + 1 is that of word w, the last one that of the begin of a text.
    """
    n = len(words)
    single = (words + 1.0) / (total + distinct + 1.0)
    contexts = np.append(words, documents).astype(float)
    backoff = np.append(0.0, np.log10(weight / (contexts + weight)))
    first, second, count = (values[pairs[2] > 0] for values in pairs)
    weights = np.log10((count + weight * single[second]) / (contexts[first] + weight))
    every = np.arange(n)
    return Automaton(
        n, np.append(every, (first + 1) * n + second), np.append(np.log10(single), weights),
        np.append(every, second) + 1, np.zeros(n + 2, np.int64), backoff,
    )


class _Texts:
    """A shard's texts as numbers of its own distinct words, and its words and pairs in the order of their hashes."""

    def __init__(self, row: dict, folds: int, held_out: int) -> None:
        lengths = np.array(row["lengths"], np.int64)
        data, ends = opened(row["data"], lengths)
        whole = data.tobytes().lower()
        split = [whole[a:b].split() for a, b in zip((ends - lengths).tolist(), ends.tolist())]
        number = {word: i for i, word in enumerate(dict.fromkeys(chain([END], chain.from_iterable(split))))}
        self.ids = [None if i is None or i != i else int(i) for i in row["ids"]]
        self.fold = [None if i is None else zlib.crc32(str(i).encode()) % folds for i in self.ids]
        self.sizes = np.array([len(words) + 1 for words in split], np.int64)
        self.words = len(number)
        self.flat = np.zeros(self.sizes.sum(), np.int64)
        lasts = np.cumsum(self.sizes) - 1
        inner = np.ones(len(self.flat), bool)
        inner[lasts] = False
        self.flat[inner] = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(inner.sum()))
        before = np.append(self.words, self.flat[:-1])
        before[(lasts - self.sizes + 1)] = self.words
        trained = np.repeat([fold is not None and fold != held_out for fold in self.fold], self.sizes)
        digest = xxhash.xxh64_intdigest
        self.word_keys = np.array([digest(word) for word in number], np.uint64)
        self.word_counts = np.bincount(self.flat[trained], minlength=self.words)
        pairs, place = np.unique(before * self.words + self.flat, return_inverse=True)
        self.first, self.second = pairs // self.words, pairs % self.words
        self.pair_counts = np.bincount(place[trained], minlength=len(pairs))
        contexts = np.append(self.word_keys, np.uint64(_BEGIN))
        mixed = contexts[self.first] * _FACTOR + self.word_keys[self.second]
        self.pair_keys = (mixed ^ (mixed >> np.uint64(29))) * _FACTOR

    def dealt(self, kind: int, parts: int) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, places) of the words or pairs, in the order of their hashes."""
        keys = self.word_keys if kind == WORDS else self.pair_keys
        bucket = (keys % np.uint64(parts)).astype(np.int64)
        order = np.argsort(keys)  # equal hashes have equal answers
        order = order[np.argsort(bucket[order].astype(np.uint16 if parts <= 1 << 16 else np.int64), kind="stable")]
        first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        return zip(bucket[order[first]].tolist(), np.split(order, first[1:]))


def _six_bytes(keys: np.ndarray) -> bytes:
    """The upper 48 bits; the bucket stands for the rest."""
    return (keys >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _keys_of(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 6)
    keys = np.zeros((len(raw), 8), np.uint8)
    keys[:, :6] = raw
    return keys.view("<u8")[:, 0]


def _asked(shards: DataFrame, parts: int, folds: int, held_out: int) -> DataFrame:
    """(bucket, kind, shard, keys, counts): what a shard has of each bucket's words or pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = _Texts(row, folds, held_out)
                for kind, keys, counts in (
                    (WORDS, texts.word_keys, texts.word_counts), (PAIRS, texts.pair_keys, texts.pair_counts)
                ):
                    for bucket, places in texts.dealt(kind, parts):
                        yield pa.RecordBatch.from_pydict({
                            "bucket": pa.array([bucket], pa.int32()), "kind": pa.array([kind], pa.int32()),
                            "shard": pa.array([row["shard"]], pa.int64()),
                            "keys": pa.array([_six_bytes(keys[places])], pa.binary()),
                            "counts": pa.array([counts[places].astype("<u4").tobytes()], pa.binary()),
                        })

    return shards.mapInArrow(run, "bucket int, kind int, shard long, keys binary, counts binary")


def _answered(asked: DataFrame, parts: int) -> DataFrame:
    """(shard, kind, bucket, counts, total, trained): sums over all shards in the order a shard asked for them.

    ``total`` and ``trained``, the sum of the bucket's counts and the number of keys that have any, are on one row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                value = (row["shard"], _keys_of(row["keys"]), np.frombuffer(row["counts"], "<u4"))
                held.setdefault((row["bucket"], row["kind"]), []).append(value)
        for bucket, kind in list(held):
            rows = held.pop((bucket, kind))
            names, place = np.unique(np.concatenate([keys for _, keys, _ in rows]), return_inverse=True)
            sums = np.bincount(place, np.concatenate([counts for _, _, counts in rows]), len(names)).astype(np.int64)
            at = 0
            for i, (shard, keys, _) in enumerate(rows):
                own = sums[place[at : at + len(keys)]]
                at += len(keys)
                wide = "<u4" if own.max(initial=0) < 1 << 32 else "<u8"
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int64()), "kind": pa.array([kind], pa.int32()),
                    "bucket": pa.array([bucket], pa.int32()), "wide": pa.array([wide]),
                    "counts": pa.array([own.astype(wide).tobytes()], pa.binary()),
                    "total": pa.array([0 if i else int(sums.sum())], pa.int64()),
                    "trained": pa.array([0 if i else int((sums > 0).sum())], pa.int64()),
                })

    return asked.repartitionById(parts, "bucket").mapInArrow(
        run, "shard long, kind int, bucket int, wide string, counts binary, total long, trained long"
    )


def score(docs: DataFrame, folds: int = 7, held_out: int = 2, weight: float = CONTEXT_WEIGHT, shard: int = SHARD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row's whole text.

    Tokens are the words between white space, A-Z in lower case, and an end. Learnt are the rows whose crc32 of doc_id as
    text mod ``folds`` isn't ``held_out``; rows without doc_id are scored only. ``base_score`` and ``score`` are sums of
    log10 p(w) and of the automaton's weights. Null and empty texts have the end alone. Repeated rows count as often as
    they are there. An empty table gives an empty table; without learnt rows all counts are 0.
    """
    parts = shuffle_parts(docs.sparkSession)
    shards = written(document_shards(docs, shard), "shards")
    answers = written(_answered(_asked(shards, parts, folds, held_out), parts), "counts")
    sums = answers.filter(F.col("kind") == WORDS).agg(F.sum("total").alias("n"), F.sum("trained").alias("v")).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"] or 0)

    def run(_: tuple, rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        texts = _Texts(rows.iloc[0].to_dict(), folds, held_out)
        sums = {
            (kind, bucket): np.frombuffer(counts, wide)
            for kind, bucket, wide, counts in zip(found["kind"], found["bucket"], found["wide"], found["counts"])
        }
        counts = [np.zeros(texts.words, np.int64), np.zeros(len(texts.first), np.int64)]
        for kind in (WORDS, PAIRS):
            for bucket, places in texts.dealt(kind, parts):
                counts[kind][places] = sums[kind, bucket]
        words, pairs = counts
        automaton = bigram_automaton(words, (texts.first, texts.second, pairs), total, distinct, int(words[0]), weight)
        base = np.log10((words + 1.0) / (total + distinct + 1.0))
        ends = np.cumsum(texts.sizes)
        starts = ends - texts.sizes
        begin = texts.words + 1
        weights = automaton.walk(begin, texts.flat, starts)
        return pd.DataFrame(
            {
                "doc_id": pd.array(texts.ids, "Int64"),
                "held_out": [fold == held_out for fold in texts.fold],
                "n_tokens": texts.sizes,
                "n_known": np.add.reduceat((words[texts.flat] > 0).astype(np.int64), starts),
                "train_tokens": total,
                "base_score": np.add.reduceat(base[texts.flat], starts),
                "score": np.add.reduceat(weights, starts),
            }
        )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return shards.groupBy("shard").cogroup(answers.drop("total", "trained").groupBy("shard")).applyInPandas(run, schema)

"""Toxicity by non-negative positive-unlabelled learning.

A classifier sees confirmed toxic texts and unlabelled ones. With the class prior p, its risk is
p R+(toxic) + max(0, R-(unlabelled) - p R-(toxic)): the loss of calling a text clean is estimated on the unlabelled
texts less the share of toxic ones among them, and that estimate must not go below zero; where it does, the step
goes up its gradient instead. A few classifiers learn from different unlabelled texts, one task each, and their scores
are averaged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import TwoGenerations, by_size, free_names, give_back, identifier, utf8

DIMENSIONS = 1 << 22
#: The bounded training sample: about so many toxic texts for all, and unlabelled ones for each classifier.
POSITIVES, UNLABELLED, CLASSIFIERS = 3_000, 6_000, 3
#: A feature is learnt if so many of the toxic texts have it, and this share of them.
LEAST_TEXTS, LEAST_SHARE = 3, 0.01
#: And if it is so many times as frequent in them as in clean texts, by the same prior-corrected estimate as the risk.
LEAST_LIFT = 5.0
_WORD = re.compile(rb"[a-z\x80-\xff]+")


def _features_of(word: bytes) -> tuple[int, ...]:
    """The word and its beginnings of four and five bytes, hashed."""
    return tuple({zlib.crc32(part) % DIMENSIONS for part in (b"=" + word, b"4" + word[:4], b"5" + word[:5])})


def features(text: bytes, hashed: Mapping[bytes, tuple[int, ...]]) -> list[int]:
    """The distinct features of a whole text, in order; ``hashed`` has those of its words."""
    return sorted(set(chain.from_iterable([hashed[word] for word in set(_WORD.findall(text.lower()))])))


def _gradient(
    weights: np.ndarray, bias: float, columns: np.ndarray, firsts: np.ndarray, toxic: np.ndarray, prior: float
) -> tuple[np.ndarray, float, float]:
    """Gradient and risk of the non-negative estimate with the logistic loss. Texts have columns[firsts[i]:firsts[i+1]]."""
    sums = np.concatenate([[0.0], np.cumsum(weights[columns])])
    z = sums[firsts[1:]] - sums[firsts[:-1]] + bias
    p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    n_toxic, n_rest = max(1, toxic.sum()), max(1, (~toxic).sum())
    as_toxic, as_clean = np.logaddexp(0, -z), np.logaddexp(0, z)
    positive = prior * as_toxic[toxic].sum() / n_toxic
    negative = as_clean[~toxic].sum() / n_rest - prior * as_clean[toxic].sum() / n_toxic
    slope = np.where(toxic, -prior * p / n_toxic, p / n_rest)
    if negative >= 0:
        slope = slope + np.where(toxic, prior * (p - 1) / n_toxic, 0)
    else:
        slope = -slope
    by_column = np.bincount(columns, np.repeat(slope, np.diff(firsts)), len(weights))
    return by_column, slope.sum(), positive + max(0.0, negative)


def fit(
    texts: list[np.ndarray], toxic: np.ndarray, prior: float, steps: int = 300, rate: float = 0.1, decay: float = 2e-4
) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) learnt from texts' distinct features by Adam over all texts at once."""
    # Text by text, so that no joined copy of the sample is made; a text has each of its features once.
    size = 1 + max((int(text.max()) for text in texts if len(text)), default=-1)
    by_toxic, by_rest = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for text, is_toxic in zip(texts, toxic.tolist()):
        (by_toxic if is_toxic else by_rest)[text] += 1
    names = np.flatnonzero(by_toxic >= max(LEAST_TEXTS, LEAST_SHARE * toxic.sum()))
    in_toxic = by_toxic[names] / max(1, toxic.sum())
    in_clean = np.maximum(0, by_rest[names] / max(1, (~toxic).sum()) - prior * in_toxic) / (1 - prior)
    names = names[in_toxic >= LEAST_LIFT * in_clean]
    place = by_rest
    place[:] = -1
    place[names] = np.arange(len(names))
    known = [found[found >= 0] for found in (place[text] for text in texts)]
    columns = np.concatenate([np.zeros(0, np.int32), *known])
    firsts = np.concatenate([[0], np.cumsum([len(found) for found in known])]).astype(np.int64)
    weights, bias = np.zeros(len(names)), float(np.log(prior / (1 - prior)))
    mean, square, mean_b, square_b = np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for step in range(1, steps + 1):
        slope, slope_b, _ = _gradient(weights, bias, columns, firsts, toxic, prior)
        slope = slope + decay * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        mean_b, square_b = 0.9 * mean_b + 0.1 * slope_b, 0.999 * square_b + 0.001 * slope_b**2
        size = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        weights -= size * mean / (np.sqrt(square) + 1e-8)
        bias -= size * mean_b / (np.sqrt(square_b) + 1e-8)
    return names, weights, bias


def _drawn(number: int, wanted: int, seed: Column) -> Column:
    """Whether a row is among about ``wanted`` of ``number``, by a hash of doc_id; all are if there are fewer."""
    share = min(1.0, wanted / max(1, number))
    return F.pmod(F.xxhash64("doc_id", seed), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)


def train(docs: DataFrame, labels: DataFrame, classifiers: int = CLASSIFIERS) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Classifiers from ``labels`` (doc_id, toxic 0 or 1) and ``docs`` (doc_id, text); null labels and doc_ids are ignored.

    The class prior is the share of toxic labels. Without toxic labels no classifier is trained. Training holds about
    POSITIVES toxic and UNLABELLED other texts in a task; which they are depends on a hash of doc_id alone.
    """
    known = labels.select(identifier().alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().distinct()
    number, share = known.agg(F.count(F.lit(1)), F.avg((F.col("toxic") == 1).cast("double"))).first()
    if not number or not share:
        return []
    prior = float(min(max(share, 0.001), 0.999))
    texts = docs.select(identifier().alias("doc_id"), utf8().alias("text")).filter("doc_id IS NOT NULL")
    toxic_ids = known.filter("toxic = 1").select("doc_id").distinct()
    toxic_ids = toxic_ids.filter(_drawn(toxic_ids.count(), POSITIVES, F.lit(-1)))
    all_ones = F.sequence(F.lit(0), F.lit(classifiers - 1))
    toxic = texts.join(toxic_ids, "doc_id", "left_semi").select("text", F.lit(True).alias("toxic"), all_ones.alias("ones"))
    number = texts.count()
    mine = F.filter(all_ones, lambda one: _drawn(number, UNLABELLED, one))
    others = texts.select("text", F.lit(False).alias("toxic"), mine.alias("ones")).filter(F.size("ones") > 0)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = TwoGenerations(_features_of, 50_000)
        for batch in by_size(batches, 0, 1 << 22):
            found = [features(text.as_py(), hashed) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1), batch.column(2)], names=["features", "toxic", "ones"]
            )
        hashed.forget()
        give_back()

    sample = toxic.unionByName(others).mapInArrow(extract, "features array<int>, toxic boolean, ones array<int>")
    dealt = sample.select("features", "toxic", F.explode("ones").alias("one"))

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort([zlib.crc32(np.asarray(f, np.int32).tobytes()) for f in rows["features"]], kind="stable")
        held = [np.asarray(rows["features"].iloc[i], np.int32) for i in order]
        names, weights, bias = fit(held, rows["toxic"].to_numpy(bool)[order], prior)
        give_back()
        return pd.DataFrame({"one": [int(rows["one"].iloc[0])], "names": [names], "weights": [weights], "bias": [bias]})

    fitted = dealt.groupBy("one").applyInPandas(learn, "one int, names array<long>, weights array<double>, bias double")
    return [
        (np.array(row["names"], np.int64), np.array(row["weights"]), row["bias"])
        for row in sorted(fitted.collect(), key=lambda row: row["one"])
    ]


def score(docs: DataFrame, models: list[tuple[np.ndarray, np.ndarray, float]]) -> DataFrame:
    """(doc_id, score) of every row's whole text: the classifiers' mean probability, 0 without classifiers.

    Null and empty texts have the score of a text without words. Null and repeated doc_ids stay as they are.
    """
    table: dict[int, list[float]] = {}
    for i, (names, weights, _) in enumerate(models):
        for name, weight in zip(names.tolist(), weights.tolist()):
            table.setdefault(name, [0.0] * len(models))[i] = weight
    shared = docs.sparkSession.sparkContext.broadcast((table, [model[2] for model in models]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, biases = shared.value
        words = TwoGenerations(lambda word: tuple(f for f in _features_of(word) if f in known), 50_000)
        for batch in by_size(batches, 1, 1 << 23):
            scores = []
            for text in batch.column(1):
                distinct = set(_WORD.findall(text.as_py().lower()))
                found = sorted(set(chain.from_iterable([words[word] for word in distinct])))
                z = np.array(biases) + (np.sum([known[f] for f in found], axis=0) if found else 0.0)
                scores.append(float(np.mean(1 / (1 + np.exp(-np.clip(z, -60, 60))))) if len(biases) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
        words.forget()
        give_back()

    return docs.select(identifier().alias("doc_id"), utf8().alias("text")).mapInArrow(run, "doc_id long, score double")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, mod ``folds``; null without doc_id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted). Labels are learnt where ``fold(doc_id, 3)`` isn't 1; held_out says where it is."""
    models = train(docs, labels.filter(fold(identifier(), 3) != 1))
    return score(docs, models).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, by all labels. Rows without doc_id stay; of repeated ids, all go or stay."""
    (toxic,) = free_names(docs, "toxic")
    rejected = score(docs, train(docs, labels)).filter(F.col("score") >= threshold).select(F.col("doc_id").alias(toxic)).distinct()
    return docs.join(rejected, identifier() == F.col(toxic), "left_anti").select([F.col(f"`{column}`") for column in docs.columns])

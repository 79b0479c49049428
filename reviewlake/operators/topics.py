"""Topics: class-based TF-IDF keywords, names, similarity, reduction and assignment."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.scalars import outlier_verdict, percent
from reviewlake.operators.clusters import as_vector
from reviewlake.operators.joins import with_topic_names
from reviewlake.operators.once import present
from reviewlake.operators.ranks import top_n
from reviewlake.operators.vectors import count_vectors, term_at, with_ngrams
from reviewlake.session import cut_lineage


def term_counts(
    df: DataFrame,
    topic: str,
    words: str,
    terms: list[str] | None = None,
    ngram: tuple[int, int] = (1, 1),
) -> DataFrame:
    """(topic, term, n): uses of each term in the texts of each topic.

    With a list of ``terms`` each row is counted in place and the count vectors are summed map-side;
    without it every n-gram counts, one row per (topic, n-gram) and map task in the shuffle.
    """
    if terms is not None:
        counted = count_vectors(df.select(F.col(topic).alias("topic"), words), words, terms, ngram)
        sums = counted.groupBy("topic").agg(Summarizer.sum(F.col("counts")).alias("_sum"))
        entries = sums.select("topic", F.posexplode(vector_to_array("_sum")).alias("_at", "_n"))
        return entries.filter(F.col("_n") > 0).select(
            "topic", term_at(terms, F.col("_at")).alias("term"), F.col("_n").cast("long").alias("n")
        )
    rows = with_ngrams(df.select(F.col(topic).alias("topic"), words), words, ngram)
    grams = rows.select("topic", F.explode("_grams").alias("term"))
    return present(grams, ["topic", "term"]).groupBy("topic", "term").agg(F.count(F.lit(1)).alias("n"))


def ctfidf(counts: DataFrame) -> DataFrame:
    """(topic, term, weight): n / (words of the topic) * ln(1 + A / (uses of the term)).

    A is the mean number of words per topic. Everything runs on the counted (topic, term) table.
    """
    topics = counts.groupBy("topic").agg(F.sum("n").alias("_words"))
    mean_words = topics.agg(F.avg("_words")).scalar()
    terms = counts.groupBy("term").agg(F.sum("n").alias("_uses"))
    joined = counts.join(terms, "term").join(topics, "topic")
    weight = (F.col("n") / F.col("_words")) * F.log(1 + mean_words / F.col("_uses"))
    return joined.select("topic", "term", weight.alias("weight"))


def keywords(weights: DataFrame, n: int = 10) -> DataFrame:
    """(topic, term, weight, rank): the heaviest terms per topic, ties by term.

    Weights are rounded to nine digits so that equal ones tie whatever order they were added in.
    """
    rounded = weights.withColumn("weight", F.round("weight", 9))
    return top_n(rounded, ["topic"], [F.desc("weight"), F.col("term")], n)


def names(top: DataFrame, n: int = 4) -> DataFrame:
    """(topic, topic_name): the id and the leading keywords joined by '_'; -1 is 'Outlier'."""
    entry = F.struct("rank", "term")
    words = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["term"])
    named = top.filter(F.col("rank") <= n).groupBy("topic").agg(F.array_join(words, "_").alias("_words"))
    return named.select(
        "topic",
        F.when(F.col("topic").cast("string") == "-1", "Outlier")
        .otherwise(F.concat(F.col("topic").cast("string"), F.lit("_"), F.col("_words")))
        .alias("topic_name"),
    )


def topic_info(df: DataFrame, topic: str, topic_names: DataFrame) -> DataFrame:
    """(topic, count, topic_name), largest topics first."""
    counts = df.groupBy(F.col(topic).alias("topic")).agg(F.count(F.lit(1)).alias("count"))
    return counts.join(topic_names, "topic", "left").orderBy(F.desc("count"), "topic")


def outlier_report(df: DataFrame, topic: str = "topic") -> DataFrame:
    """One row: rows, topics, outliers, their percentage and the verdict on it."""
    rate = percent(F.col("outliers"), F.col("rows"))
    return (
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct(F.when(F.col(topic) != -1, F.col(topic))).alias("topics"),
            F.count_if(F.col(topic) == -1).alias("outliers"),
        )
        .withColumn("outlier_pct", rate)
        .withColumn("verdict", outlier_verdict(F.col("outlier_pct")))
    )


def similarity(weights: DataFrame) -> DataFrame:
    """(topic_a, topic_b, cosine) for topic_a < topic_b that share a term.

    The table has one row per (topic, term), so what is gathered per term is one weight per topic.
    Products are summed map-side per pair of topics.
    """
    norms = weights.groupBy("topic").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm"))
    unit = weights.join(norms, "topic").select(
        "term", F.struct("topic", (F.col("weight") / F.col("_norm")).alias("w")).alias("_entry")
    )
    listed = unit.groupBy("term").agg(F.sort_array(F.collect_list("_entry")).alias("_entries"))
    first = listed.select("_entries", F.posexplode("_entries").alias("_at", "_a"))
    later = F.slice("_entries", F.col("_at") + 2, F.size("_entries"))
    pairs = first.select("_a", F.explode(later).alias("_b"))
    return pairs.groupBy(F.col("_a.topic").alias("topic_a"), F.col("_b.topic").alias("topic_b")).agg(
        F.sum(F.col("_a.w") * F.col("_b.w")).alias("cosine")
    )


def products(weights: DataFrame) -> DataFrame:
    """(topic_a, topic_b, dot) of the topics' rows, for topic_a <= topic_b that share a term."""
    listed = weights.groupBy("term").agg(
        F.sort_array(F.collect_list(F.struct("topic", F.col("weight").alias("w")))).alias("_entries")
    )
    first = listed.select("_entries", F.posexplode("_entries").alias("_at", "_a"))
    later = F.slice("_entries", F.col("_at") + 1, F.size("_entries"))
    pairs = first.select("_a", F.explode(later).alias("_b"))
    return pairs.groupBy(F.col("_a.topic").alias("topic_a"), F.col("_b.topic").alias("topic_b")).agg(
        F.sum(F.col("_a.w") * F.col("_b.w")).alias("dot")
    )


def _merged(rows: pd.DataFrame, keep: int) -> list[tuple[int, int, float]]:
    """The merges of ``merge_order`` from (topic_a, topic_b, dot) and, where topic_b is missing, (topic_a, size, words)."""
    own = rows[rows["topic_b"].isna()].sort_values("topic_a")
    names = [int(name) for name in own["topic_a"]]
    size, words = own["size"].to_numpy(float), own["words"].to_numpy(float)
    place = {name: i for i, name in enumerate(names)}
    held = rows[rows["topic_b"].notna()]
    gram = np.zeros((len(names), len(names)))
    x, y = (np.array([place[int(name)] for name in held[column]], np.int64) for column in ("topic_a", "topic_b"))
    gram[x, y] = gram[y, x] = held["dot"].to_numpy(float)
    alive, out = np.ones(len(names), bool), []
    while alive.sum() > max(keep, 1):
        left = np.flatnonzero(alive)
        small = int(left[np.argmin(size[left])])  # the first of equals has the least id
        others = left[left != small]
        length = np.sqrt(np.maximum(gram[small, small] * gram[others, others], 0))
        cosine = np.round(np.divide(gram[small, others], length, out=np.zeros(len(others)), where=length > 0), 9)
        best = int(np.argmax(cosine))
        into = int(others[best])
        out.append((names[small], names[into], float(cosine[best])))
        # The merged row is the mean of both, weighted by their words.
        both = words[small] + words[into]
        share = words[small] / both if both else 0.0
        row = share * gram[small] + (1 - share) * gram[into]
        corner = share * row[small] + (1 - share) * row[into]
        gram[into] = gram[:, into] = row
        gram[into, into] = corner
        size[into], words[into] = size[into] + size[small], both
        alive[small] = False
    return out


def merges(counts: DataFrame, sizes: DataFrame, keep: int) -> DataFrame:
    """(step, topic, into, cosine, final): the merges that leave ``keep`` topics, and what each merged topic ends in.

    Each step merges the smallest topic (ties to the smaller id) into the one whose class-based TF-IDF row is nearest by
    cosine (ties likewise); without a shared term all cosines are 0. A merged topic's row is the row of its words, with the
    terms weighted as before the first merge. Topic -1 takes no part. The products of all rows are one distributed job; the
    steps are taken in one task over them, a number for each pair of topics and none for rows or terms.
    """
    used = counts.filter(F.col("topic") != -1)
    rows = cut_lineage(used)
    words = rows.groupBy("topic").agg(F.sum("n").alias("words"))
    own = sizes.filter(F.col("topic") != -1).join(words, "topic", "left").select(
        F.col("topic").cast("long").alias("topic_a"), F.lit(None).cast("long").alias("topic_b"),
        F.lit(None).cast("double").alias("dot"), F.col("size").cast("double").alias("size"),
        F.coalesce(F.col("words"), F.lit(0)).cast("double").alias("words"),
    )
    pairs = products(ctfidf(rows)).join(own.select("topic_a"), "topic_a", "left_semi").select(
        F.col("topic_a").cast("long"), F.col("topic_b").cast("long"), "dot",
        F.lit(None).cast("double").alias("size"), F.lit(None).cast("double").alias("words"),
    )

    def stepped(table: pd.DataFrame) -> pd.DataFrame:
        found = _merged(table, keep)
        final: dict[int, int] = {}
        for source, into, _ in reversed(found):
            final[source] = final.get(into, into)
        return pd.DataFrame(
            [(step, a, b, cosine, final[a]) for step, (a, b, cosine) in enumerate(found)],
            columns=["step", "topic", "into", "cosine", "final"],
        )

    return own.unionByName(pairs).groupBy(F.lit(0).alias("one")).applyInPandas(
        stepped, "step long, topic long, into long, cosine double, final long"
    )


def merge_order(counts: DataFrame, sizes: DataFrame, keep: int) -> list[tuple[int, int, float]]:
    """The steps of ``merges`` as (topic, into, cosine), one for each topic that goes."""
    rows = merges(counts, sizes, keep).orderBy("step").collect()
    return [(row["topic"], row["into"], row["cosine"]) for row in rows]


def reduce_topics(df: DataFrame, topic: str, counts: DataFrame, keep: int) -> DataFrame:
    """Rows with their topic after merging down to ``keep`` topics."""
    sizes = df.groupBy(F.col(topic).alias("topic")).agg(F.count(F.lit(1)).alias("size"))
    kind = df.schema[topic].dataType
    moved = merges(counts, sizes, keep).select(F.col("topic").cast(kind).alias("_from"), F.col("final").cast(kind).alias("_to"))
    found = df.join(moved, F.col(topic) == F.col("_from"), "left")
    return found.withColumn(topic, F.coalesce("_to", topic)).select(df.columns)


def hierarchy(df: DataFrame, counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(step, topic, into, cosine): the merge order down to a single topic."""
    return merges(counts, sizes, 1).drop("final")


def centres(df: DataFrame, topic: str, vector: str) -> DataFrame:
    """(topic, centre): the mean vector of each topic, noise left out."""
    members = as_vector(df.filter(F.col(topic) != -1).select(F.col(topic).alias("topic"), vector), vector)
    means = members.groupBy("topic").agg(Summarizer.mean(F.col(vector)).alias("_mean"))
    return means.select("topic", vector_to_array("_mean").alias("centre"))


def named_topics(df: DataFrame, topic: str, words: str, n: int = 4) -> DataFrame:
    """Rows with ``topic_name`` made from the topic's own keywords."""
    top = keywords(ctfidf(term_counts(df, topic, words)), n)
    return with_topic_names(df, names(top, n), topic)


def lda(df: DataFrame, counts: str, k: int, seed: int = 42, max_iter: int = 10) -> LDAModel:
    """Latent Dirichlet allocation on count vectors (variational Bayes over all vectors).

    Each iteration reads the vectors, a row at a time: a caller for whom they are costly to make cuts their lineage first.
    """
    estimator = LDA(
        k=k, seed=seed, maxIter=max_iter, subsamplingRate=1.0, featuresCol=counts, topicDistributionCol="_topics"
    )
    return estimator.fit(df.select(counts))


def lda_top_words(model: LDAModel, terms: list[str], n: int = 10) -> DataFrame:
    """(topic, rank, term, weight) of the heaviest terms. The vocabulary is a bounded list."""
    described = model.describeTopics(n)
    return described.select(
        F.col("topic").cast("long"),
        F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("_at", "_entry"),
    ).select(
        "topic",
        (F.col("_at") + 1).cast("long").alias("rank"),
        term_at(terms, F.col("_entry")["termIndices"]).alias("term"),
        F.col("_entry")["termWeights"].alias("weight"),
    )


def lda_topics(df: DataFrame, model: LDAModel, weights: str | None = None) -> DataFrame:
    """Adds the dominant ``topic`` (from 0) and its ``confidence``; without any known term all topics are alike.

    ``weights`` names a column for the shares of all topics, which add up to 1.
    """
    known = F.col("_highest") > 0
    shares = vector_to_array(F.col(model.getTopicDistributionCol()))
    alike = F.array_repeat(F.lit(1 / model.getK()), model.getK())
    scored = model.transform(df)
    if weights is not None:
        scored = scored.withColumn(weights, F.when(F.array_max(shares) > 0, shares).otherwise(alike))
    return (
        scored.withColumn("_weights", shares)
        .withColumn("_highest", F.array_max("_weights"))
        .withColumn("confidence", F.when(known, F.col("_highest")).otherwise(F.lit(1 / model.getK())))
        .withColumn("topic", (F.array_position("_weights", F.col("_highest")) - 1).cast("int"))
        .drop("_weights", "_highest", model.getTopicDistributionCol())
    )


def lda_perplexity(model: LDAModel, df: DataFrame) -> float:
    return math.exp(model.logPerplexity(df))

"""Aspect scores of reviews from a lexicon, and what is done with them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.functions.scalars import best_column
from reviewlake.operators.once import compute_once, counted_entries
from reviewlake.operators.stats import group_stats

# The aspects of a game review.
ASPECT_LABELS: tuple[str, ...] = (
    "Atmosphere & Immersion",
    "Technical Performance",
    "Gameplay Mechanics",
    "Stability & Bugs",
    "Story & Narrative",
    "Price & Value",
)

# Our own starter lexicon (label -> term -> weight); callers bring their own for other domains.
GAME_LEXICON: dict[str, dict[str, float]] = {
    "Atmosphere & Immersion": {
        "atmosphere": 1.0, "immersive": 1.0, "creepy": 0.8, "sound": 0.5, "graphics": 0.5,
    },
    "Technical Performance": {
        "fps": 1.0, "performance": 1.0, "optimized": 0.8, "lag": 0.8, "stutter": 0.8,
    },
    "Gameplay Mechanics": {
        "gameplay": 1.0, "mechanics": 1.0, "combat": 0.8, "controls": 0.6, "puzzle": 0.6,
    },
    "Stability & Bugs": {"bug": 1.0, "bugs": 1.0, "crash": 1.0, "crashes": 1.0, "glitch": 0.8},
    "Story & Narrative": {
        "story": 1.0, "narrative": 1.0, "characters": 0.8, "plot": 0.8, "ending": 0.5,
    },
    "Price & Value": {"price": 1.0, "worth": 0.8, "money": 0.8, "sale": 0.6, "refund": 0.6},
}


def score_column(label: str) -> str:
    return f"score_{label}"


def _label_score(words: Column, terms: Mapping[str, float]) -> Column:
    by_weight: dict[float, list[str]] = defaultdict(list)
    for term, weight in terms.items():
        by_weight[weight].append(term)

    def hits(listed: list[str]) -> Column:
        return F.size(F.filter(words, lambda word: word.isin(*[F.lit(term) for term in listed])))

    total: Column = F.lit(0.0)
    for weight, listed in sorted(by_weight.items()):
        total = total + F.lit(weight) * hits(listed)
    return total / (total + 1)


def score(
    df: DataFrame, text: str, lexicon: Mapping[str, Mapping[str, float]] = GAME_LEXICON
) -> DataFrame:
    """Adds one ``score_<label>`` per aspect: w / (1 + w) for the weight w of the matched tokens.

    The labels are independent of each other. Blank text has no scores. The lexicon is part of the
    expression, so rows are scored where they are, without a join or a shuffle.
    """
    blank = tx.is_blank(F.col(text))
    worded = compute_once(df, {"_words": tx.tokens(F.col(text))})
    scores = {
        score_column(label): F.when(~blank, _label_score(F.col("_words"), terms))
        for label, terms in lexicon.items()
    }
    return compute_once(worded, scores).drop("_words")


def score_with_table(df: DataFrame, key: str, text: str, lexicon: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The same scores for a lexicon kept as a table (label, term, weight): (key, score_<label>...).

    Words are counted inside their row, so no task keeps a table of all words of its rows.
    """
    worded = compute_once(df.select(key, text), {"_words": tx.tokens(F.col(text))})
    words = worded.select(key, F.inline(counted_entries(F.col("_words"))).alias("term", "_n"))
    hits = words.join(lexicon, "term")
    weights = hits.groupBy(key).pivot("label", list(labels)).agg(F.sum(F.col("_n") * F.col("weight")))
    blank = tx.is_blank(F.col(text))
    scored = df.select(key, blank.alias("_blank")).join(weights, key, "left")
    columns = []
    for label in labels:
        total = F.coalesce(F.col(f"`{label}`"), F.lit(0.0))
        columns.append(F.when(~F.col("_blank"), total / (total + 1)).alias(score_column(label)))
    return scored.select(key, *columns)


def best_aspect(df: DataFrame, labels: Sequence[str], output: str = "best_topic") -> DataFrame:
    """Adds the label with the highest score; rows with a missing score are dropped."""
    columns = [score_column(label) for label in labels]
    name = tx.last_segment(best_column(columns))
    return df.dropna(subset=columns).withColumn(output, name)


def aspect_stats(df: DataFrame, labels: Sequence[str], score: str) -> DataFrame:
    """Median, mean and maximum of a score per best aspect, in long form."""
    return group_stats(best_aspect(df, labels), "best_topic", score)

"""Inputs of product summaries and the table of finished ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators.joins import not_in
from reviewlake.operators.ranks import top_n
from reviewlake.operators.sampling import random_per_group
from reviewlake.operators.stats import product_ratings, worst_products

# Sample and text sizes of a summary request.
SAMPLE_LIMIT = 50
MAX_TEXT_LENGTH = 8000
MIN_REVIEW_LENGTH = 5
MIN_REVIEWS = 5
SUMMARY_WORDS = 100
# Fixed value: price of 1,000 model tokens in dollars.
TOKEN_PRICE = 0.002


def joined_in_order(rank: str, text: str, separator: str, when: Column | None = None) -> Column:
    """Aggregate: the texts of a group joined along ``rank``."""
    entry = F.struct(F.col(rank).alias("r"), F.col(text).alias("t"))
    listed = F.collect_list(entry if when is None else F.when(when, entry))
    return F.array_join(F.transform(F.array_sort(listed), lambda e: e["t"]), separator)


def pack(
    reviews: DataFrame,
    product: str,
    label: str,
    text: str,
    key: str,
    n: int = SAMPLE_LIMIT,
    longer_than: int = MIN_REVIEW_LENGTH,
    max_length: int = MAX_TEXT_LENGTH,
    seed: int = 42,
) -> DataFrame:
    """(product, pos_text, neg_text): up to ``n`` random reviews per label as one text each.

    Short reviews are dropped after the sampling, then the joined text is cut. A group holds at most
    ``n`` texts when it is collected.
    """
    rows = reviews.filter(F.col(label).isin(0, 1)).select(product, label, text, key)
    sampled = random_per_group(rows, [product, label], n, key, seed, "_rank")
    kept = F.length(text) > longer_than
    # The filter must not move below the sampling, so it is part of the aggregate.
    parts = {
        name: F.substring(
            joined_in_order("_rank", text, "\n- ", kept & (F.col(label) == value)), 1, max_length
        ).alias(name)
        for name, value in (("pos_text", 1), ("neg_text", 0))
    }
    return sampled.groupBy(product).agg(*parts.values())


def prompt(product: Column, positive: Column, negative: Column, words: int = SUMMARY_WORDS) -> Column:
    """The request text for a product."""
    return F.concat(
        F.lit("Product "),
        product.cast("string"),
        F.lit("\n\nPositive reviews:\n"),
        positive,
        F.lit("\n\nNegative reviews:\n"),
        negative,
        F.lit(
            f"\n\nWrite at most {words} words in running text, using only what the reviews say:"
            "\n1. Highlights: the three main reasons to recommend it."
            "\n2. Pain points: the most frequent complaints."
            "\n3. Verdict: one sentence."
        ),
    )


def eligible(
    reviews: DataFrame,
    product: str,
    done: DataFrame | None = None,
    limit: int | None = None,
    min_reviews: int = MIN_REVIEWS,
) -> DataFrame:
    """(product, reviews) to summarise: not done, among the first ``limit``, with enough reviews.

    The limit counts before the review gate, so fewer products than ``limit`` may remain.
    """
    counts = reviews.groupBy(product).agg(F.count(F.lit(1)).alias("reviews"))
    if done is not None:
        counts = not_in(counts, done, product)
    if limit is not None:
        counts = counts.orderBy(product).limit(limit)
    return counts.filter(F.col("reviews") >= min_reviews)


def category_inputs(
    df: DataFrame,
    cluster: str,
    product: str,
    label: str,
    text: str,
    rating: str,
    key: str,
    products: int = 3,
    reviews: int = 10,
) -> DataFrame:
    """What an article on a cluster needs, one row per (cluster, product) of the leading products.

    Columns: position, n_reviews, avg_rating, positive and negative (arrays of the first reviews by
    key), cluster_size, worst_product.
    """
    counts = df.groupBy(cluster, product).agg(
        F.count(F.lit(1)).alias("n_reviews"), F.avg(rating).alias("avg_rating")
    )
    leading = top_n(
        counts.filter(F.col(product).isNotNull()),
        [cluster],
        [F.desc("n_reviews"), F.col(product)],
        products,
        "position",
    )
    chosen = df.join(leading.select(cluster, product), [cluster, product], "left_semi")
    first = top_n(
        chosen.filter(F.col(label).isin(0, 1)).select(cluster, product, label, text, key),
        [cluster, product, label],
        [F.col(key)],
        reviews,
        "_rank",
    )
    entry = F.struct(F.col("_rank"), F.col(text).alias("t"))

    def texts(value: int) -> Column:
        listed = F.array_sort(F.collect_list(F.when(F.col(label) == value, entry)))
        return F.transform(listed, lambda e: e["t"])

    listed = first.groupBy(cluster, product).agg(
        texts(1).alias("positive"), texts(0).alias("negative")
    )
    none = F.array().cast("array<string>")
    sizes = counts.groupBy(cluster).agg(F.sum("n_reviews").alias("cluster_size"))
    worst = worst_products(df, cluster, product, rating).select(cluster, "worst_product")
    return (
        leading.join(listed, [cluster, product], "left")
        .withColumns(
            {"positive": F.coalesce("positive", none), "negative": F.coalesce("negative", none)}
        )
        .join(sizes, cluster)
        .join(worst, cluster, "left")
    )


def one_decimal(value: Column) -> Column:
    """One decimal, halves up."""
    return F.format_string("%.1f", F.floor(value * 10 + 0.5) / 10)


def _sections(part: Column) -> Column:
    """Aggregate: the section texts of a cluster in product order."""
    entry = F.struct(F.col("position").alias("r"), part.alias("t"))
    return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["t"])


def article_body(
    inputs: DataFrame, cluster: str, product: str, name: Column, positives: int = 5, negatives: int = 3
) -> DataFrame:
    """(cluster, body): the text handed to a summariser. Its headings are fixed values.

    A product contributes its first positive reviews cut to 500 characters, its first negative ones cut
    to 300, each part only if there are such reviews.
    """
    praise = F.when(
        F.size("positive") > 0,
        F.concat(
            F.col("position").cast("string"),
            F.lit(". "),
            F.col(product),
            F.lit(" (Rating: "),
            F.coalesce(one_decimal(F.col("avg_rating")), F.lit("0.0")),
            F.lit("/5)\nPositive aspects: "),
            F.substring(F.array_join(F.slice("positive", 1, positives), " "), 1, 500),
        ),
    )
    blame = F.when(
        F.size("negative") > 0,
        F.concat(
            F.lit("Common complaints: "),
            F.substring(F.array_join(F.slice("negative", 1, negatives), " "), 1, 300),
        ),
    )
    section = F.concat_ws("\n", praise, blame)
    bodies = inputs.groupBy(cluster).agg(
        F.array_join(F.filter(_sections(section), lambda t: t != ""), "\n").alias("_sections"),
        F.max("worst_product").alias("_worst"),
    )
    title = F.concat(F.lit("Top Products in "), name, F.lit(":\n"))
    avoid = F.concat(F.lit("\nProduct to Avoid: "), F.coalesce("_worst", F.lit("None")))
    sections = F.when(F.col("_sections") != "", F.col("_sections"))
    return bodies.select(cluster, F.concat_ws("\n", title, sections, avoid).alias("body"))


def template_summary(inputs: DataFrame, cluster: str, product: str, name: Column) -> DataFrame:
    """(cluster, summary): a Markdown summary without a model. Its headings are fixed values."""

    def quoted(heading: str, reviews: str) -> Column:
        return F.when(
            F.size(reviews) > 0,
            F.concat(
                F.lit(f"**{heading}:**\n- "),
                tx.shorten(F.get(reviews, F.lit(0)), 150, "..."),
                F.lit("\n\n"),
            ),
        ).otherwise("")

    section = F.concat(
        F.lit("### "),
        F.col("position").cast("string"),
        F.lit(". "),
        F.col(product),
        F.lit("\n**Rating:** "),
        one_decimal(F.coalesce("avg_rating", F.lit(0.0))),
        F.lit("/5\n\n"),
        quoted("Highlights", "positive"),
        quoted("Common Complaints", "negative"),
    )
    joined = inputs.groupBy(cluster).agg(
        F.array_join(_sections(section), "").alias("_sections"),
        F.max("worst_product").alias("_worst"),
    )
    return joined.select(
        cluster,
        F.concat(
            F.lit("# "),
            name,
            F.lit(" Product Recommendations\n\n## Top 3 Products\n\n"),
            F.col("_sections"),
            F.lit("## Product to Avoid\n\n**"),
            F.coalesce("_worst", F.lit("None")),
            F.lit(
                "** - Based on customer reviews, this product has received consistently low ratings.\n"
            ),
        ).alias("summary"),
    )


def cache_statistics(summaries: DataFrame, product: str, tokens: str, calls: DataFrame | None = None) -> DataFrame:
    """One row: products done, calls made, tokens used and their cost in dollars.

    ``summaries`` holds the current summary per product, ``calls`` one row per call; without it every
    summary counts as one call.
    """
    log = summaries if calls is None else calls
    done = summaries.agg(F.count_distinct(product)).scalar()
    used = F.coalesce(F.sum(tokens), F.lit(0))
    return log.agg(
        F.count(F.lit(1)).alias("total_api_calls"), used.alias("total_tokens_used")
    ).select(
        F.coalesce(done, F.lit(0)).alias("total_products"),
        "total_api_calls",
        "total_tokens_used",
        F.round(F.col("total_tokens_used") / 1000 * TOKEN_PRICE, 4).alias("estimated_cost"),
    )


def processed(products: DataFrame, cache: DataFrame, product: str) -> DataFrame:
    """Products with a flag that says whether the cache has a summary for them."""
    done = cache.select(product).distinct().withColumn("processed", F.lit(True))
    return products.join(done, product, "left").withColumn(
        "processed", F.coalesce("processed", F.lit(False))
    )


def summary_checks(summaries: DataFrame, text: str, sections: Sequence[str] = tx.SUMMARY_SECTIONS) -> DataFrame:
    """Summaries with a completeness flag, the sections they miss and their token estimate."""
    summary = F.col(text)
    return summaries.withColumns(
        {
            "complete": tx.has_sections(summary, sections),
            "missing": tx.missing_sections(summary, sections),
            "tokens": tx.token_estimate(summary),
        }
    )

"""Product summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.plans import summaries
from reviewlake.sinks.keyed import upsert
from reviewlake.workload.registry import GAMES_SQL, REVIEWS_SQL, games, query, reviews, table


def pack_sql(n: int = 50, longer: int = 5, cut: int = 8000) -> str:
    def text(value: int) -> str:
        return (
            f"left(coalesce(string_agg(text, chr(10) || '- ' ORDER BY rn) "
            f"FILTER (quality = {value} AND length(text) > {longer}), ''), {cut})"
        )

    return f"""(SELECT source, {text(1)} AS pos_text, {text(0)} AS neg_text FROM (
        SELECT *, row_number() OVER (PARTITION BY source, quality ORDER BY md5('42:' || doc_id), doc_id) AS rn
        FROM {REVIEWS_SQL}) WHERE rn <= {n} GROUP BY source)"""


def packed(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.pack(reviews(spark, sf), "source", "quality", "text", "doc_id")


@query("sum1_text_pack", f"SELECT * FROM {pack_sql()}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return packed(spark, sf)


@query("sum1_text_pack_long_only", f"SELECT * FROM {pack_sql(50, 100)}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.pack(reviews(spark, sf), "source", "quality", "text", "doc_id", longer_than=100)


@query(
    "sum2_prompt",
    f"""SELECT source, 'Product ' || source || chr(10) || chr(10) || 'Positive reviews:' || chr(10) || pos_text
          || chr(10) || chr(10) || 'Negative reviews:' || chr(10) || neg_text || chr(10) || chr(10)
          || 'Write at most 100 words in running text, using only what the reviews say:' || chr(10)
          || '1. Highlights: the three main reasons to recommend it.' || chr(10)
          || '2. Pain points: the most frequent complaints.' || chr(10) || '3. Verdict: one sentence.' AS prompt
        FROM {pack_sql()}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = summaries.prompt(F.col("source"), F.col("pos_text"), F.col("neg_text"))
    return packed(spark, sf).select("source", text.alias("prompt"))


@query(
    "sum3_eligible_products",
    f"""SELECT p_brand, reviews FROM (SELECT p_brand, count(*) AS reviews FROM part
          WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_type = 'SMALL' GROUP BY p_brand ORDER BY p_brand LIMIT 5)
          GROUP BY p_brand ORDER BY p_brand LIMIT 10) WHERE reviews >= 5""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    done = part.filter(F.col("p_type") == "SMALL").select("p_brand").distinct().orderBy("p_brand").limit(5)
    return summaries.eligible(part, "p_brand", done, 10)


def rated(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with a rating from 1 to 5 made from their length; the language is the cluster."""
    rating = (F.pmod("n_chars", F.lit(5)) + 1).cast("double")
    return reviews(spark, sf).select("doc_id", "lang", "source", "quality", "text", rating.alias("rating"))


INPUTS_SQL = f"""(WITH r AS (SELECT *, (n_chars % 5 + 1)::DOUBLE AS rating FROM {REVIEWS_SQL}),
    c AS (SELECT lang, source, count(*) AS n_reviews, avg(rating) AS avg_rating FROM r GROUP BY lang, source),
    l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_reviews DESC, source) AS position FROM c),
    f AS (SELECT lang, source, quality, text, row_number() OVER (PARTITION BY lang, source, quality ORDER BY doc_id) AS rn FROM r),
    t AS (SELECT lang, source,
        coalesce(list(text ORDER BY rn) FILTER (quality = 1), []) AS positive,
        coalesce(list(text ORDER BY rn) FILTER (quality = 0), []) AS negative
      FROM f WHERE rn <= 10 GROUP BY lang, source),
    s AS (SELECT lang, CAST(sum(n_reviews) AS BIGINT) AS cluster_size FROM c GROUP BY lang),
    w AS (SELECT lang, source AS worst_product FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY avg_rating, source) AS rn
          FROM c WHERE n_reviews >= 5) WHERE rn = 1)
    SELECT l.lang, l.source, l.position, l.n_reviews, l.avg_rating, positive, negative, cluster_size, worst_product
    FROM l JOIN t USING (lang, source) JOIN s USING (lang) LEFT JOIN w USING (lang) WHERE position <= 3)"""


def inputs(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.category_inputs(
        rated(spark, sf), "lang", "source", "quality", "text", "rating", "doc_id"
    )


@query(
    "sum4_category_inputs",
    f"""SELECT lang, source, position, n_reviews, round(avg_rating, 6) AS avg_rating,
          array_to_string(positive, '|') AS positive, array_to_string(negative, '|') AS negative,
          cluster_size, worst_product FROM {INPUTS_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return inputs(spark, sf).withColumns(
        {
            "avg_rating": F.round("avg_rating", 6),
            "positive": F.array_join("positive", "|"),
            "negative": F.array_join("negative", "|"),
        }
    )


RATING_SQL = "printf('%.1f', floor(avg_rating * 10 + 0.5) / 10)"


@query(
    "sum5_article_body",
    f"""WITH p AS (SELECT lang, position, worst_product,
          nullif(concat_ws(chr(10),
            CASE WHEN len(positive) > 0 THEN position || '. ' || source || ' (Rating: ' || {RATING_SQL} || '/5)' || chr(10)
              || 'Positive aspects: ' || left(array_to_string(positive[1:5], ' '), 500) END,
            CASE WHEN len(negative) > 0 THEN 'Common complaints: ' || left(array_to_string(negative[1:3], ' '), 300) END), '') AS part
          FROM {INPUTS_SQL})
        SELECT lang, concat_ws(chr(10), 'Top Products in Category_' || lang || ':' || chr(10),
          string_agg(part, chr(10) ORDER BY position),
          chr(10) || 'Product to Avoid: ' || coalesce(any_value(worst_product), 'None')) AS body FROM p GROUP BY lang""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("Category_"), "lang")
    return summaries.article_body(inputs(spark, sf), "lang", "source", name)


@query(
    "sum6_template_summary",
    f"""WITH p AS (SELECT lang, position, worst_product, '### ' || position || '. ' || source || chr(10)
            || '**Rating:** ' || {RATING_SQL} || '/5' || chr(10) || chr(10)
            || CASE WHEN len(positive) > 0 THEN '**Highlights:**' || chr(10) || '- ' || left(positive[1], 150) || '...' || chr(10) || chr(10) ELSE '' END
            || CASE WHEN len(negative) > 0 THEN '**Common Complaints:**' || chr(10) || '- ' || left(negative[1], 150) || '...' || chr(10) || chr(10) ELSE '' END
            AS part FROM {INPUTS_SQL})
        SELECT lang, '# Category_' || lang || ' Product Recommendations' || chr(10) || chr(10) || '## Top 3 Products' || chr(10) || chr(10)
          || string_agg(part, '' ORDER BY position) || '## Product to Avoid' || chr(10) || chr(10) || '**'
          || coalesce(any_value(worst_product), 'None')
          || '** - Based on customer reviews, this product has received consistently low ratings.' || chr(10) AS summary
        FROM p GROUP BY lang""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("Category_"), "lang")
    return summaries.template_summary(inputs(spark, sf), "lang", "source", name)


def finished(spark: SparkSession, sf: str) -> DataFrame:
    """Events as summaries: the user is the product, the event id the time."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("appid"), F.col("props").alias("summary"),
        (F.col("event_id") % 1000).alias("tokens_used"), F.col("event_id").alias("created_at"), "event_type",
    )


CACHE_SQL = """(SELECT user_id AS appid, arg_max(props, event_id) AS summary,
    arg_max(event_id % 1000, event_id) AS tokens_used, max(event_id) AS created_at FROM events GROUP BY user_id)"""


@query("sum7_cache_upsert", f"SELECT * FROM {CACHE_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = finished(spark, sf)
    columns = ["appid", "summary", "tokens_used", "created_at"]
    stored = rows.filter(F.col("event_type") == "view").select(*columns)
    changes = rows.filter(F.col("event_type") != "view").select(*columns)
    return upsert(stored, changes, "appid", ["created_at"])


@query(
    "sum7_processed_flag",
    f"""SELECT g.appid, g.appid IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) AS processed
        FROM {GAMES_SQL} g""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    cache = reviews(spark, sf).filter(F.col("toxic") == 1).select(F.col("source").alias("appid"))
    return summaries.processed(games(spark, sf).select("appid"), cache, "appid")


@query(
    "sum8_cache_statistics",
    """SELECT count(DISTINCT user_id) AS total_products, count(*) AS total_api_calls,
         CAST(sum(event_id % 1000) AS BIGINT) AS total_tokens_used,
         round(sum(event_id % 1000) / 1000 * 0.002, 4)::DOUBLE AS estimated_cost FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = finished(spark, sf)
    return summaries.cache_statistics(rows, "appid", "tokens_used", rows)

"""Aggregations and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import filters, profile, stats
from reviewlake.operators.once import compute_once
from reviewlake.operators.topics import outlier_report
from reviewlake.plans import preprocessing
from reviewlake.workload import sqltext as sq
from reviewlake.workload.registry import REVIEWS_SQL, documents, query, reviews, rounded, scratch, six, table
from reviewlake.workload.rows import (
    LABELLED_SQL,
    NOTES_SQL,
    TOPICS_SQL,
    event_topics,
    labelled,
    notes,
)
from reviewlake.workload.text import STOP_SQL, STOP_WORDS


@query(
    "flagship_top_sources",
    f"""SELECT source, count(*) FILTER (quality = 0) AS negative, count(*) FILTER (quality = 1) AS positive,
          count(*) AS total, round(100.0 * count(*) FILTER (quality = 1) / count(*), 6) AS positive_pct
        FROM (SELECT source, quality, {sq.clean('text', True)} AS cleaned FROM {REVIEWS_SQL})
        WHERE length(cleaned) >= 10 GROUP BY source ORDER BY total DESC, source LIMIT 30""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = compute_once(
        reviews(spark, sf), {"cleaned": tx.clean_text(F.col("text"), brackets=True)}
    )
    rows = filters.at_least_chars(cleaned, "cleaned", 10)
    return rounded(stats.label_counts(rows, "source", "quality", 30), "positive_pct")


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their part, in the role of rated products."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_returnflag", "l_extendedprice")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


SALES_SQL = "(SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey)"


@query("agg1_value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return stats.value_counts(table(spark, sf, "events"), "event_type")


@query(
    "agg2_value_shares",
    """SELECT l_returnflag, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 6) AS percent
       FROM lineitem GROUP BY l_returnflag""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.value_counts(table(spark, sf, "lineitem"), "l_returnflag", True), "percent")


@query(
    "agg3_imbalance",
    """WITH n AS (SELECT count(*) AS n FROM labels GROUP BY quality)
       SELECT max(n) AS max_count, min(n) AS min_count, round(max(n) * 1.0 / min(n), 6) AS ratio,
         max(n) * 1.0 / min(n) > 1.5 AS imbalanced FROM n""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.imbalance(table(spark, sf, "labels"), "quality"), "ratio")


@query(
    "agg4_top_categories",
    f"""SELECT p_brand, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM {SALES_SQL}), 6) AS percent
        FROM {SALES_SQL} GROUP BY p_brand ORDER BY count DESC, p_brand LIMIT 20""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.top_share(sales(spark, sf), "p_brand", 20), "percent")


@query(
    "agg5_top_and_others",
    f"""WITH c AS (SELECT p_brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rn
          FROM {SALES_SQL} GROUP BY p_brand)
        SELECT CASE WHEN rn <= 10 OR (SELECT count(*) FROM c) <= 20 THEN p_brand ELSE 'Others' END AS p_brand,
          CAST(sum(n) AS BIGINT) AS count FROM c GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_with_others(sales(spark, sf), "p_brand", 10, 20)


@query(
    "agg6_rating_summary",
    """SELECT round(avg(l_extendedprice), 4) AS mean, median(l_extendedprice) AS median,
         round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min, max(l_extendedprice) AS max
       FROM lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.summary(table(spark, sf, "lineitem"), "l_extendedprice")
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query(
    "agg7_rating_distribution",
    """SELECT l_quantity, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 6) AS percent
       FROM lineitem GROUP BY l_quantity""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.distribution(table(spark, sf, "lineitem"), "l_quantity"), "percent")


@query(
    "agg8_label_counts",
    f"""SELECT lang, count(*) FILTER (toxic = 0) AS negative, count(*) FILTER (toxic = 1) AS positive,
          count(*) AS total, round(100.0 * count(*) FILTER (toxic = 1) / count(*), 6) AS positive_pct
        FROM {REVIEWS_SQL} GROUP BY lang""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.label_counts(reviews(spark, sf), "lang", "toxic"), "positive_pct")


@query(
    "agg9_label_shares",
    f"""SELECT p_brand, round(100.0 * count(*) FILTER (l_returnflag = 'A') / count(*), 6) AS "pct_A",
          round(100.0 * count(*) FILTER (l_returnflag = 'N') / count(*), 6) AS "pct_N",
          round(100.0 * count(*) FILTER (l_returnflag = 'R') / count(*), 6) AS "pct_R"
        FROM {SALES_SQL} WHERE p_brand IN (SELECT p_brand FROM {SALES_SQL} GROUP BY p_brand
          ORDER BY count(*) DESC, p_brand LIMIT 10) GROUP BY p_brand""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    shares = stats.label_shares(sales(spark, sf), "p_brand", "l_returnflag", ["A", "N", "R"], 10)
    return rounded(shares, "pct_A", "pct_N", "pct_R")


def histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""WITH r AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}),
      b AS (SELECT range AS bin FROM range({bins})),
      f AS (SELECT least(CAST(floor(({column} - lo) * {bins} / (hi - lo)) AS BIGINT), {bins - 1}) AS bin,
              count(*) AS n FROM {source}, r GROUP BY 1)
      SELECT b.bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) AS low,
        round(lo + (b.bin + 1) * ((hi - lo) / {bins}), 6) AS high, coalesce(n, 0) AS count
      FROM b CROSS JOIN r LEFT JOIN f ON b.bin = f.bin"""


LENGTHS_SQL = "(SELECT CAST(length(text) AS DOUBLE) AS x FROM documents)"


@query("agg10_histogram_50", histogram_sql(LENGTHS_SQL, "x", 50))
def _(spark: SparkSession, sf: str) -> DataFrame:
    lengths = table(spark, sf, "documents").select(tx.char_length(F.col("text")).alias("x"))
    return rounded(stats.histogram(lengths, "x", 50), "low", "high")


@query("agg10_histogram_30", histogram_sql("events", "value", 30))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.histogram(table(spark, sf, "events"), "value", 30), "low", "high")


@query("agg10_histogram_100", histogram_sql("lineitem", "l_extendedprice", 100))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 100), "low", "high")


def box_sql(source: str, by: str, column: str) -> str:
    return f"""WITH q AS (SELECT {by}, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS median,
        quantile_cont({column}, 0.75) AS q3 FROM {source} GROUP BY {by})
      SELECT q.{by}, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
        round(any_value(q3), 6) AS q3,
        round(least(min({column}) FILTER ({column} >= q1 - 1.5 * (q3 - q1)), any_value(q1)), 6) AS whisker_low,
        round(greatest(max({column}) FILTER ({column} <= q3 + 1.5 * (q3 - q1)), any_value(q3)), 6) AS whisker_high,
        count(*) AS count,
        count(*) FILTER ({column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1)) AS outliers
      FROM {source} s JOIN q ON s.{by} = q.{by} GROUP BY q.{by}"""


BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query("agg11_box_text_length", box_sql("(SELECT quality, CAST(length(text) AS DOUBLE) AS x FROM documents JOIN labels USING (doc_id))", "quality", "x"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("quality", tx.char_length(F.col("text")).alias("x"))
    return rounded(stats.box_stats(rows, "x", ["quality"]), *BOX)


@query("agg11_box_value", box_sql("events", "event_type", "value"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.box_stats(table(spark, sf, "events"), "value", ["event_type"]), *BOX)


@query(
    "agg12_top_words",
    f"""WITH w AS (SELECT quality, unnest({sq.tokens('text')}) AS word FROM {REVIEWS_SQL}),
          c AS (SELECT quality, word, count(*) AS count FROM w WHERE word NOT IN ({STOP_SQL}) GROUP BY quality, word)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY count DESC, word) AS rank FROM c)
        WHERE rank <= 100""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_words(reviews(spark, sf), "text", "quality", STOP_WORDS, 100)


@query(
    "agg13_group_stats",
    """SELECT event_type, 'median' AS statistic, round(median(value), 6) AS value FROM events GROUP BY event_type
       UNION ALL SELECT event_type, 'mean', round(avg(value), 6) FROM events GROUP BY event_type
       UNION ALL SELECT event_type, 'max', round(max(value), 6) FROM events GROUP BY event_type""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.group_stats(table(spark, sf, "events"), "event_type", "value"), "value")


@query(
    "agg14_topic_scores",
    "SELECT event_type, count(*) AS count, round(avg(value), 6) AS mean_score FROM events GROUP BY event_type",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.topic_scores(table(spark, sf, "events"), "event_type", "value"), "mean_score")


@query(
    "agg15_coverage",
    """SELECT t AS threshold, round(avg(CASE WHEN value / 100 >= t THEN 1.0 ELSE 0.0 END), 6) AS fraction
       FROM events, (SELECT unnest([0.5::DOUBLE, 0.6::DOUBLE, 0.7::DOUBLE]) AS t) GROUP BY t""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.coverage(table(spark, sf, "events"), F.col("value") / 100), "fraction")


@query(
    "agg16_outlier_share",
    """SELECT event_type = 'error' AS is_outlier, count(*) AS count,
         round(count(*) * 1.0 / (SELECT count(*) FROM events), 6) AS fraction FROM events GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.outlier_share(event_topics(spark, sf), F.col("topic") == -1), "fraction")


@query(
    "agg16_outlier_report",
    f"""SELECT count(*) AS rows, count(DISTINCT topic) FILTER (topic <> -1) AS topics,
          count(*) FILTER (topic = -1) AS outliers, round(100.0 * count(*) FILTER (topic = -1) / count(*), 6) AS outlier_pct,
          CASE WHEN 100.0 * count(*) FILTER (topic = -1) / count(*) > 50 THEN 'too many outliers'
               WHEN 100.0 * count(*) FILTER (topic = -1) / count(*) > 30 THEN 'high outlier rate' ELSE 'ok' END AS verdict
        FROM {TOPICS_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(outlier_report(event_topics(spark, sf)), "outlier_pct")


@query(
    "agg17_density",
    """WITH e AS (SELECT event_type = 'error' AS outlier, value AS x FROM events),
         s AS (SELECT outlier, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h, min(x) AS lo, max(x) AS hi
               FROM e GROUP BY outlier),
         g AS (SELECT outlier, n, h, range AS point, lo - 0.5 * (hi - lo) + range * (2 * (hi - lo) / 999) AS at
               FROM s, range(1000))
       SELECT g.outlier, point, round(any_value(g.at), 6) AS x,
         round(sum(exp(-0.5 * ((g.at - e.x) / h) * ((g.at - e.x) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
       FROM g JOIN e ON g.outlier = e.outlier GROUP BY g.outlier, point""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select((F.col("event_type") == "error").alias("outlier"), "value")
    curve = stats.density(rows, "value", "outlier")
    return curve.withColumns({"x": six("x"), "density": F.round("density", 9)})


@query(
    "agg18_review_totals",
    f"""SELECT count(*) AS total_reviews, count(*) FILTER (quality = 1) AS positive_reviews,
          count(*) FILTER (quality = 0) AS negative_reviews, count(DISTINCT source) AS unique_products FROM {REVIEWS_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return stats.review_totals(reviews(spark, sf), "quality", "source")


@query(
    "agg19_worst_product",
    f"""WITH r AS (SELECT p_type, p_brand, avg(l_quantity) AS m, count(l_quantity) AS n FROM {SALES_SQL} GROUP BY ALL),
          w AS (SELECT p_type, p_brand, m, row_number() OVER (PARTITION BY p_type ORDER BY m, p_brand) AS rn
                FROM r WHERE n >= 5)
        SELECT p_type, p_brand AS worst_product, round(m, 6) AS worst_rating FROM w WHERE rn = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.worst_products(sales(spark, sf), "p_type", "p_brand", "l_quantity"), "worst_rating")


@query(
    "agg20_product_ratings",
    f"""SELECT p_brand, round(avg(l_quantity), 6) AS avg_rating, count(l_quantity) AS n_ratings
        FROM {SALES_SQL} GROUP BY p_brand""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.product_ratings(sales(spark, sf), "p_brand", "l_quantity"), "avg_rating")


@query(
    "agg21_cluster_profile",
    """WITH c AS (SELECT p_size, p_type AS v, count(*) AS n, row_number() OVER (PARTITION BY p_size ORDER BY count(*) DESC, p_type) AS rn
          FROM part GROUP BY p_size, p_type),
        b AS (SELECT p_size, p_brand AS v, count(*) AS n, row_number() OVER (PARTITION BY p_size ORDER BY count(*) DESC, p_brand) AS rn
          FROM part GROUP BY p_size, p_brand)
       SELECT p_size, count(*) AS size,
         (SELECT string_agg(v || ' (' || n || ')', ', ' ORDER BY rn) FROM c WHERE c.p_size = part.p_size AND rn <= 5) AS top_categories,
         (SELECT string_agg(v || ' (' || n || ')', ', ' ORDER BY rn) FROM b WHERE b.p_size = part.p_size AND rn <= 3) AS top_products
       FROM part GROUP BY p_size""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return stats.cluster_profile(table(spark, sf, "part"), "p_size", "p_type", "p_brand")


@query(
    "prf1_missing",
    f"""SELECT 'quality' AS "column", count(*) FILTER (quality IS NULL) AS count,
          round(100.0 * count(*) FILTER (quality IS NULL) / count(*), 6) AS percent FROM {LABELLED_SQL}
        UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL),
          round(100.0 * count(*) FILTER (toxic IS NULL) / count(*), 6) FROM {LABELLED_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.missing(labelled(spark, sf)), "percent")


@query(
    "prf2_duplicates",
    """SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, text FROM documents)) AS duplicates,
         round(100.0 * (count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, text FROM documents))) / count(*), 6) AS percent
       FROM documents""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.duplicates(table(spark, sf, "documents").select("lang", "text")), "percent")


@query(
    "prf3_empty_strings",
    f"""SELECT 'note' AS "column", count(*) FILTER (note = '') AS count,
          round(100.0 * count(*) FILTER (note = '') / count(*), 6) AS percent FROM {NOTES_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.empty_strings(notes(spark, sf)), "percent")


@query(
    "prf4_text_stats",
    f"""WITH t AS (SELECT CAST(length(text) AS BIGINT) AS n, len({sq.word_list('text')}) AS w FROM documents)
        SELECT min(n) AS min_length, max(n) AS max_length, round(avg(n), 6) AS mean_length, round(avg(w), 6) AS mean_words,
          count(*) FILTER (n < 10) AS very_short, count(*) FILTER (n > 5000) AS very_long,
          round(median(n), 6) AS median_length FROM t""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.text_stats(documents(spark, sf), "text")
    return rounded(out, "mean_length", "mean_words", "median_length")


def describe_sql(source: str, numbers: list[str], texts: list[str]) -> str:
    def number(value: str) -> str:
        return f"CAST(CAST(round(CAST({value} AS DOUBLE), 6) AS DECIMAL(30,6)) AS VARCHAR)"

    parts = []
    for c in numbers:
        wanted = {
            "count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})",
            "25%": f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", "50%": f"quantile_cont(CAST({c} AS DOUBLE), 0.5)",
            "75%": f"quantile_cont(CAST({c} AS DOUBLE), 0.75)", "max": f"max({c})",
        }
        parts += [
            f"""SELECT '{c}' AS "column", '{s}' AS statistic, {number(e)} AS value FROM {source}"""
            for s, e in wanted.items()
        ]
    for c in texts:
        top = f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        freq = f"(SELECT count(*) FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1)"
        wanted = {
            "count": f"CAST(count({c}) AS VARCHAR)", "unique": f"CAST(count(DISTINCT {c}) AS VARCHAR)",
            "top": top, "freq": f"CAST({freq} AS VARCHAR)",
        }
        parts += [
            f"""SELECT '{c}' AS "column", '{s}' AS statistic, {e} AS value FROM {source}"""
            for s, e in wanted.items()
        ]
        parts[-2] = f"""SELECT '{c}' AS "column", 'top' AS statistic, {top} AS value"""
        parts[-1] = f"""SELECT '{c}' AS "column", 'freq' AS statistic, CAST({freq} AS VARCHAR) AS value"""
    return " UNION ALL ".join(parts)


@query(
    "prf5_describe",
    describe_sql(LABELLED_SQL, ["doc_id", "n_chars", "quality", "toxic"], ["source", "lang", "text"]),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profile.describe(labelled(spark, sf))


@query("prf6_shape", "SELECT count(*) AS rows, CAST(5 AS BIGINT) AS columns FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profile.shape(table(spark, sf, "documents"))


@query("prf6_first_rows", "SELECT * FROM documents ORDER BY doc_id LIMIT 5")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profile.first_rows(table(spark, sf, "documents"), ["doc_id"])


@query(
    "prf7_cleaning_funnel",
    f"""WITH d AS (SELECT DISTINCT source, lang, text, quality, toxic FROM {LABELLED_SQL}),
          s AS (SELECT (SELECT count(*) FROM {LABELLED_SQL}) AS s0, count(*) AS s1,
            count(*) FILTER (trim(text) <> '') AS s2, count(*) FILTER (trim(text) <> '' AND length(text) >= 10) AS s3,
            count(*) FILTER (trim(text) <> '' AND length(text) >= 10 AND quality IS NOT NULL) AS s4 FROM d)
        SELECT 0::BIGINT AS step, 'original' AS name, s0 AS rows, 0 AS removed, 0.0::DOUBLE AS removed_pct FROM s
        UNION ALL SELECT 1, 'no duplicates', s1, s0 - s1, round(100.0 * (s0 - s1) / s0, 6) FROM s
        UNION ALL SELECT 2, 'with text', s2, s1 - s2, round(100.0 * (s1 - s2) / s0, 6) FROM s
        UNION ALL SELECT 3, 'long enough', s3, s2 - s3, round(100.0 * (s2 - s3) / s0, 6) FROM s
        UNION ALL SELECT 4, 'labelled', s4, s3 - s4, round(100.0 * (s3 - s4) / s0, 6) FROM s""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf).select("source", "lang", "text", "quality", "toxic")
    return rounded(profile.cleaning_funnel(rows, "text", "quality"), "removed_pct")


@query(
    "prf8_stage_report",
    f"""WITH o AS (SELECT doc_id, text, quality FROM {LABELLED_SQL}),
          c AS (SELECT * FROM o WHERE length(text) >= 10 AND quality IS NOT NULL),
          m AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM c GROUP BY quality)),
          s AS (SELECT (SELECT count(*) FROM o) AS o, (SELECT count(*) FROM c) AS c, 2 * n AS b,
            2 * floor(0.7::DOUBLE * n)::BIGINT AS tr,
            2 * floor(0.5::DOUBLE * (n - floor(0.7::DOUBLE * n)))::BIGINT AS va FROM m)
        SELECT 0::BIGINT AS position, 'original' AS stage, o AS rows, 100.0::DOUBLE AS percent FROM s
        UNION ALL SELECT 1, 'cleaned', c, round(100.0 * c / o, 6) FROM s
        UNION ALL SELECT 2, 'balanced', b, round(100.0 * b / o, 6) FROM s
        UNION ALL SELECT 3, 'train', tr, round(100.0 * tr / b, 6) FROM s
        UNION ALL SELECT 4, 'validation', va, round(100.0 * va / b, 6) FROM s
        UNION ALL SELECT 5, 'test', b - tr - va, round(100.0 * (b - tr - va) / b, 6) FROM s""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf).select("doc_id", "text", "quality")
    return rounded(preprocessing.run(rows, "text", "quality", "doc_id", scratch(spark)), "percent")

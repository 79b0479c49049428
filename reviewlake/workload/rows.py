"""Filters, label columns, joins, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import filters, joins, profile
from reviewlake.operators.sampling import random_per_group
from reviewlake.plans import topic_model
from reviewlake.sources.tables import query as sql_query
from reviewlake.workload import sqltext as sq
from reviewlake.workload.registry import (
    GAMES_SQL,
    REVIEWS_SQL,
    games,
    query,
    reviews,
    six,
    table,
)
from reviewlake.workload.text import DROP_METADATA_SQL, MARKED_UP_SQL, marked_up


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, with null labels where there is none."""
    documents = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left")


LABELLED_SQL = """(SELECT d.doc_id, source, lang, n_chars, text, quality, toxic
    FROM documents d LEFT JOIN labels l USING (doc_id))"""


def notes(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as a text with nulls, empty and white-space values in it."""
    kind = F.col("event_type")
    note = (
        F.when(kind == "error", " \n\t ")
        .when(kind == "signup", "")
        .when(kind != "click", F.col("props"))
    )
    return table(spark, sf, "events").select("event_id", "event_type", note.alias("note"))


NOTES_SQL = """(SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN ' ' || chr(10) || chr(9) || chr(160)
    WHEN event_type = 'signup' THEN '' WHEN event_type <> 'click' THEN props END AS note FROM events)"""


@query("flt1_not_blank", f"SELECT * FROM {NOTES_SQL} WHERE event_type IN ('view', 'purchase')")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return filters.drop_blank(notes(spark, sf), "note")


@query("flt2_min_length", "SELECT doc_id, text FROM documents WHERE length(text) >= 10")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return filters.at_least_chars(table(spark, sf, "documents").select("doc_id", "text"), "text", 10)


@query("flt3_min_length_20", "SELECT doc_id, text FROM documents WHERE length(text) >= 20")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return filters.at_least_chars(table(spark, sf, "documents").select("doc_id", "text"), "text", 20)


FIVE_WORDS_SQL = f"""(SELECT doc_id, text, {DROP_METADATA_SQL} AS cleaned_text,
    len({sq.word_list(DROP_METADATA_SQL)}) AS n FROM {MARKED_UP_SQL})"""


@query("flt4_min_words", f"SELECT doc_id, cleaned_text FROM {FIVE_WORDS_SQL} WHERE n >= 20")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return topic_model.load_reviews(marked_up(spark, sf), "text", 20).select("doc_id", "cleaned_text")


@query(
    "flt4_word_gate_report",
    f"""SELECT count(*) AS rows, count(*) FILTER (n >= 20) AS kept, count(*) FILTER (n < 20) AS dropped
        FROM {FIVE_WORDS_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = marked_up(spark, sf).withColumn("cleaned_text", tx.drop_metadata(F.col("text")))
    return profile.word_gate_report(rows, "cleaned_text", 20)


@query("flt5_labelled", f"SELECT doc_id, quality FROM {LABELLED_SQL} WHERE quality IS NOT NULL")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return filters.drop_null(labelled(spark, sf), "quality").select("doc_id", "quality")


@query(
    "flt6_complete_rows",
    "SELECT event_id, event_type, note FROM " + NOTES_SQL + " WHERE note IS NOT NULL",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return filters.complete_rows(notes(spark, sf))


@query(
    "flt7_one_product",
    f"SELECT doc_id, source, quality FROM {REVIEWS_SQL} WHERE source = 'src1' ORDER BY doc_id",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).filter(F.col("source") == "src1")
    return rows.orderBy("doc_id").select("doc_id", "source", "quality")


@query(
    "flt7_label_counts",
    """SELECT (SELECT count(*) FROM labels WHERE quality = 0) AS negative,
         (SELECT count(*) FROM labels WHERE quality = 1) AS positive, count(*) AS total FROM labels""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").agg(
        F.count_if(F.col("quality") == 0).alias("negative"),
        F.count_if(F.col("quality") == 1).alias("positive"),
        F.count(F.lit(1)).alias("total"),
    )


def game_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return reviews(spark, sf).select("doc_id", F.col("source").alias("appid"), "text", "quality")


@query(
    "flt8_rating_description",
    f"""SELECT r.doc_id, r.source AS appid, r.quality, g.review_score_desc FROM {REVIEWS_SQL} r
        JOIN {GAMES_SQL} g ON r.source = g.appid WHERE g.review_score_desc = 'Positive'""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.with_games(game_reviews(spark, sf), games(spark, sf), "Positive")
    return joined.select("doc_id", "appid", "quality", "review_score_desc")


def event_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a topic id by type (errors are noise) and their value as the score."""
    kind = F.col("event_type")
    topic = (
        F.when(kind == "error", -1)
        .when(kind == "view", 0)
        .when(kind == "click", 1)
        .when(kind == "purchase", 2)
        .otherwise(3)
    )
    return table(spark, sf, "events").select("event_id", "event_type", "value", topic.alias("topic"))


TOPICS_SQL = """(SELECT event_id, event_type, value, CASE event_type WHEN 'error' THEN -1 WHEN 'view' THEN 0
    WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS topic FROM events)"""


@query("flt9_topic_rows", f"SELECT * FROM {TOPICS_SQL} WHERE topic = 0")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return filters.topic_rows(event_topics(spark, sf), 0)


@query("flt9_outlier_rows", f"SELECT * FROM {TOPICS_SQL} WHERE topic = -1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return filters.topic_rows(event_topics(spark, sf), -1)


@query(
    "flt10_sample_then_length",
    f"""SELECT doc_id, source, quality FROM (SELECT *, row_number() OVER (PARTITION BY source, quality
          ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM {REVIEWS_SQL})
        WHERE rn <= 5 AND length(text) > 100""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("doc_id", "source", "quality", "text")
    sampled = random_per_group(rows, ["source", "quality"], 5, "doc_id")
    return filters.longer_than(sampled, "text", 100).select("doc_id", "source", "quality")


@query(
    "flt11_score_threshold",
    """SELECT event_id, label, score FROM (
         SELECT event_id, 'score_value' AS label, value / 490 AS score FROM events
         UNION ALL SELECT event_id, 'score_user', user_id / 200 FROM events) WHERE score >= 0.4""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    scored = table(spark, sf, "events").select(
        "event_id", (F.col("value") / 490).alias("score_value"), (F.col("user_id") / 200).alias("score_user")
    )
    return filters.score_rows(scored, "event_id", ["score_value", "score_user"], 0.4)


SPELLING_SQL = """CASE event_type WHEN 'view' THEN 'positive' WHEN 'click' THEN 'POS' WHEN 'error' THEN 'bad'
    WHEN 'purchase' THEN '1' END"""


def spelling() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "view", "positive")
        .when(kind == "click", "POS")
        .when(kind == "error", "bad")
        .when(kind == "purchase", "1")
    )


@query(
    "prj2_normal_label",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 1 WHEN 'error' THEN 0 END AS label
       FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", filters.normal_label(spelling()).alias("label"))


@query(
    "prj3_is_positive",
    f"""SELECT event_id, CASE WHEN coalesce({SPELLING_SQL}, '') = 'positive' THEN 1 ELSE 0 END AS label FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", filters.is_positive(spelling()).alias("label"))


@query(
    "prj4_label_name",
    f"""SELECT doc_id, CASE quality WHEN 1 THEN 'Positive' WHEN 0 THEN 'Negative' END AS label FROM {LABELLED_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("doc_id", filters.label_name(F.col("quality")).alias("label"))


@query(
    "prj5_description",
    f"SELECT event_id, event_type || ' ' || note AS value FROM {NOTES_SQL}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return notes(spark, sf).select(
        "event_id", filters.description(F.col("event_type"), F.col("note")).alias("value")
    )


@query(
    "prj6_is_outlier",
    "SELECT event_id, event_type = 'error' AS is_outlier FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("topic") == -1, "Outlier").otherwise(F.col("event_type"))
    return event_topics(spark, sf).select("event_id", filters.is_outlier(name).alias("is_outlier"))


@query(
    "prj7_model_output",
    """SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 1 ELSE 0 END AS prediction,
         round(CASE WHEN event_type IN ('view', 'click', 'purchase') THEN value / 500 ELSE 1 - value / 500 END, 6)
           AS probability FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    label = (
        F.when(kind == "view", "positive")
        .when(kind == "click", "label_1")
        .when(kind == "purchase", "1")
        .when(kind == "error", "NEGATIVE")
        .otherwise("LABEL_0")
    )
    return table(spark, sf, "events").select(
        "event_id",
        filters.model_prediction(label).alias("prediction"),
        six(filters.positive_probability(label, F.col("value") / 500)).alias("probability"),
    )


@query(
    "jn1_reviews_games",
    f"""SELECT r.doc_id, r.quality, g.appid, g.total, g.review_score_desc FROM {REVIEWS_SQL} r
        JOIN {GAMES_SQL} g ON r.source = g.appid""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.with_games(game_reviews(spark, sf), games(spark, sf))
    return joined.select("doc_id", "quality", "appid", "total", "review_score_desc")


@query(
    "jn2_reviews_topics",
    "SELECT d.doc_id, d.text, l.quality * 2 + l.toxic AS topic FROM documents d JOIN labels l USING (doc_id)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    topics = table(spark, sf, "labels").select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("topic"))
    return joins.with_topics(table(spark, sf, "documents").select("doc_id", "text"), topics, "doc_id")


@query(
    "jn3_reviews_lda_topics",
    "SELECT doc_id, n_chars, label AS topic FROM documents JOIN embeddings ON doc_id = vec_id",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    topics = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("topic"))
    return joins.with_topics(table(spark, sf, "documents").select("doc_id", "n_chars"), topics, "doc_id")


@query(
    "jn4_scores_beside",
    "SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source")
    return joins.beside(rows, table(spark, sf, "labels"), "doc_id")


@query(
    "jn5_topic_names",
    """SELECT vec_id, topic, CASE WHEN topic = -1 THEN 'Outlier' ELSE n_name END AS topic_name FROM (
         SELECT vec_id, CASE WHEN label = 9 THEN -1 ELSE label END AS topic FROM embeddings)
       LEFT JOIN nation ON n_nationkey = topic""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.when(F.col("label") == 9, -1).otherwise(F.col("label")).alias("topic")
    )
    names = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("topic"), F.col("n_name").alias("topic_name")
    )
    return joins.with_topic_names(rows, names)


@query(
    "jn6_in_top_categories",
    """SELECT p_partkey, p_brand FROM part WHERE p_brand IN (
         SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 10)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return joins.in_top_values(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", 10)


@query(
    "jn7_not_yet_done",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    done = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return joins.not_in(table(spark, sf, "customer").select("c_custkey", "c_name"), done, "c_custkey")


@query(
    "srt1_sort_head",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "set1_concat",
    f"""SELECT doc_id, source, 0 AS label FROM {REVIEWS_SQL} WHERE quality = 0
        UNION ALL SELECT doc_id, source, 1 FROM {REVIEWS_SQL} WHERE quality = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("doc_id", "source", F.col("quality").alias("label"))
    return rows.filter("label = 0").unionByName(rows.filter("label = 1"))


@query("set2_distinct_rows", "SELECT DISTINCT lang, source, text FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("lang", "source", "text").dropDuplicates()


@query("set3_distinct_keys", "SELECT DISTINCT o_custkey FROM orders")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sql_query(spark, "SELECT DISTINCT o_custkey FROM {orders}", orders=table(spark, sf, "orders"))

"""Top rows per group, balanced samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators import sampling
from reviewlake.operators.ranks import top_n
from reviewlake.sinks.keyed import first_per_key
from reviewlake.workload.registry import REVIEWS_SQL, query, reviews, table

KEY_SQL = "md5('42:' || doc_id), doc_id"


@query(
    "win1_top_products",
    """SELECT p_type, p_brand, n, rank FROM (SELECT p_type, p_brand, count(*) AS n,
         row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS rank
       FROM part GROUP BY p_type, p_brand) WHERE rank <= 3""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "part").groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("n"))
    return top_n(counts, ["p_type"], [F.desc("n"), F.col("p_brand")], 3)


@query(
    "win2_first_reviews",
    f"""SELECT source, quality, string_agg(text, ' ' ORDER BY doc_id) AS value FROM (
          SELECT *, row_number() OVER (PARTITION BY source, quality ORDER BY doc_id) AS rn FROM {REVIEWS_SQL})
        WHERE rn <= 10 GROUP BY source, quality""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("source", "quality", "doc_id", "text")
    first = top_n(rows, ["source", "quality"], [F.col("doc_id")], 10)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda e: e["text"])
    return first.groupBy("source", "quality").agg(F.array_join(texts, " ").alias("value"))


@query(
    "win3_random_per_group",
    f"""SELECT doc_id, source, quality, rank FROM (SELECT *, row_number() OVER (PARTITION BY source, quality
          ORDER BY {KEY_SQL}) AS rank FROM {REVIEWS_SQL}) WHERE rank <= 50""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("doc_id", "source", "quality")
    return sampling.random_per_group(rows, ["source", "quality"], 50, "doc_id")


@query(
    "win4_first_per_key",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return first_per_key(rows, "user_id", ["event_id"])


@query("win5_first_products", "SELECT DISTINCT source FROM documents ORDER BY source LIMIT 3")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("source").distinct().orderBy("source").limit(3)


@query(
    "smp1_undersample",
    f"""SELECT doc_id, source, quality FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY {KEY_SQL}) AS rn
          FROM {REVIEWS_SQL}) WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality))""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.undersample(reviews(spark, sf).select("doc_id", "source", "quality"), "quality", "doc_id")


@query(
    "smp1_undersample_events",
    """SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type
          ORDER BY md5('42:' || event_id), event_id) AS rn FROM events)
        WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM events GROUP BY event_type))""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.undersample(table(spark, sf, "events").select("event_id", "event_type"), "event_type", "event_id")


OVERSAMPLE_SQL = f"""WITH r AS (SELECT doc_id, source, quality,
      row_number() OVER (PARTITION BY quality ORDER BY {KEY_SQL}) - 1 AS pos,
      count(*) OVER (PARTITION BY quality) AS n FROM {REVIEWS_SQL}),
    c AS (SELECT quality, any_value(n) AS n FROM r GROUP BY quality),
    d AS (SELECT quality, n, unnest(range((SELECT max(n) FROM c))) AS draw FROM c),
    p AS (SELECT quality, ('0x' || substr(md5('42:draw:' || quality || ':' || draw), 1, 15))::BIGINT % n AS pos FROM d)"""


@query(
    "smp2_oversample",
    OVERSAMPLE_SQL
    + """ SELECT doc_id, source, r.quality, count(*) AS copies FROM r JOIN p ON r.quality = p.quality AND r.pos = p.pos
         GROUP BY doc_id, source, r.quality""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.oversample(reviews(spark, sf).select("doc_id", "source", "quality"), "quality", "doc_id")


@query(
    "smp2_oversampled_rows",
    OVERSAMPLE_SQL
    + """ SELECT doc_id, source, r.quality, row_number() OVER (PARTITION BY doc_id) AS copy
         FROM r JOIN p ON r.quality = p.quality AND r.pos = p.pos""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("doc_id", "source", "quality")
    return sampling.repeat_rows(sampling.oversample(rows, "quality", "doc_id"), "doc_id")


@query("smp3_shuffle", "SELECT event_id, user_id FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.shuffle_rows(table(spark, sf, "events").select("event_id", "user_id"), "event_id")


@query(
    "smp4_split_70_15_15",
    """WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type
          ORDER BY md5('42:' || event_id), event_id) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events),
        b AS (SELECT *, floor(0.7::DOUBLE * n) AS t,
          floor(0.7::DOUBLE * n) + floor(0.5::DOUBLE * (n - floor(0.7::DOUBLE * n))) AS v FROM r)
       SELECT event_id, event_type, CASE WHEN rn <= t THEN 'train' WHEN rn <= v THEN 'validation' ELSE 'test' END AS split
       FROM b""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split(table(spark, sf, "events").select("event_id", "event_type"), "event_type", "event_id")


SPLIT_80_SQL = f"""(SELECT doc_id, quality, CASE WHEN rn <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY quality ORDER BY {KEY_SQL}) AS rn, count(*) OVER (PARTITION BY quality) AS n
    FROM {REVIEWS_SQL}))"""


@query("smp5_split_80_20", f"SELECT * FROM {SPLIT_80_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("doc_id", "quality")
    return sampling.split(rows, "quality", "doc_id", {"train": 0.8, "test": 0.2})


@query(
    "smp5_first_test_rows",
    f"SELECT * FROM {SPLIT_80_SQL} WHERE split = 'test' ORDER BY {KEY_SQL} LIMIT 100",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("doc_id", "quality")
    parts = sampling.split(rows, "quality", "doc_id", {"train": 0.8, "test": 0.2})
    return sampling.random_rows(parts.filter(F.col("split") == "test"), 100, "doc_id")


@query("smp6_sample", "SELECT o_orderkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 5")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.random_rows(table(spark, sf, "orders").select("o_orderkey"), 5, "o_orderkey")

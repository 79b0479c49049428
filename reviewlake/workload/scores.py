"""Evaluation of predictions and aspect scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators import aspects, evaluate
from reviewlake.workload import sqltext as sq
from reviewlake.workload.registry import documents, query, rounded, table


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as scored rows: the truth is a return, the score depends on price and discount."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("truth"),
        (F.col("l_discount") > 0.05).cast("int").alias("prediction"),
        F.round(F.col("l_quantity") / 50 * (1 - F.col("l_discount")), 4).alias("score"),
    )


SCORED_SQL = """(SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS truth,
    CASE WHEN l_discount > 0.05::DOUBLE THEN 1 ELSE 0 END AS prediction,
    round(l_quantity / 50 * (1 - l_discount), 4) AS score FROM lineitem)"""

CONFUSION_SQL = f"""(SELECT t.t AS truth, p.p AS prediction, (SELECT count(*) FROM {SCORED_SQL} s
    WHERE s.truth = t.t AND s.prediction = p.p) AS count
    FROM (SELECT unnest([0::BIGINT, 1::BIGINT]) AS t) t, (SELECT unnest([0::BIGINT, 1::BIGINT]) AS p) p)"""


@query("evl1_confusion", f"SELECT * FROM {CONFUSION_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(scored(spark, sf), "truth", "prediction")


def report_sql(rows: str) -> str:
    return f"""WITH s AS {rows}, c AS (
        SELECT k, count(*) FILTER (truth = k AND prediction = k) AS hit, count(*) FILTER (truth = k) AS support,
          count(*) FILTER (prediction = k) AS said FROM s, (SELECT unnest([0, 1]) AS k) GROUP BY k),
      m AS (SELECT k, support, CASE WHEN said = 0 THEN 0.0 ELSE hit / said END AS p,
          CASE WHEN support = 0 THEN 0.0 ELSE hit / support END AS r,
          CASE WHEN said + support = 0 THEN 0.0 ELSE 2 * hit / (said + support) END AS f FROM c),
      a AS (SELECT count(*) FILTER (truth = prediction) / count(*) AS acc, count(*) AS n FROM s)
      SELECT CAST(k AS VARCHAR) AS name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM m
      UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM a
      UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM m
      UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
        round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m"""


MEASURES = ("precision", "recall", "f1")


@query("evl2_report", report_sql(SCORED_SQL))
def _(spark: SparkSession, sf: str) -> DataFrame:
    matrix = evaluate.confusion(scored(spark, sf), "truth", "prediction")
    return rounded(evaluate.report(matrix), *MEASURES)


@query(
    "evl2_report_one_class",
    report_sql("(SELECT quality AS truth, 1 AS prediction FROM labels)"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").select(F.col("quality").alias("truth"), F.lit(1).alias("prediction"))
    return rounded(evaluate.report(evaluate.confusion(rows, "truth", "prediction")), *MEASURES)


@query(
    "evl3_roc",
    f"""WITH c AS (SELECT score, sum(truth) AS pos, sum(1 - truth) AS neg FROM {SCORED_SQL} GROUP BY score)
        SELECT score AS threshold, round(sum(neg) OVER w / sum(neg) OVER (), 6) AS fpr,
          round(sum(pos) OVER w / sum(pos) OVER (), 6) AS tpr FROM c WINDOW w AS (ORDER BY score DESC)
        UNION ALL SELECT 'infinity'::DOUBLE, 0.0, 0.0""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluate.roc(scored(spark, sf), "truth", "score"), "fpr", "tpr")


@query(
    "evl3_auc",
    f"""WITH c AS (SELECT score, sum(truth) AS pos, sum(1 - truth) AS neg FROM {SCORED_SQL} GROUP BY score),
          r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM c)
        SELECT round(sum(pos * (below + 0.5 * neg))::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS auc FROM r""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluate.auc(scored(spark, sf), "truth", "score"), "auc")


@query(
    "evl4_score_histogram",
    f"""WITH s AS {SCORED_SQL}, r AS (SELECT truth, min(score) AS lo, max(score) AS hi FROM s GROUP BY truth),
          f AS (SELECT s.truth, least(CAST(floor((score - lo) * 30 / (hi - lo)) AS BIGINT), 29) AS bin, count(*) AS n
                FROM s JOIN r ON s.truth = r.truth GROUP BY 1, 2)
        SELECT r.truth, b.range AS bin, round(lo + b.range * ((hi - lo) / 30), 6) AS low,
          round(lo + (b.range + 1) * ((hi - lo) / 30), 6) AS high, coalesce(n, 0) AS count
        FROM r CROSS JOIN range(30) b LEFT JOIN f ON f.truth = r.truth AND f.bin = b.range""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluate.score_histogram(scored(spark, sf), "truth", "score"), "low", "high")


@query(
    "evl4_score_box",
    f"""WITH s AS {SCORED_SQL}, q AS (SELECT truth, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
          quantile_cont(score, 0.75) AS q3 FROM s GROUP BY truth)
        SELECT q.truth, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
          round(min(score) FILTER (score >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
          round(max(score) FILTER (score <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high, count(*) AS count,
          count(*) FILTER (score < q1 - 1.5 * (q3 - q1) OR score > q3 + 1.5 * (q3 - q1)) AS outliers
        FROM s JOIN q ON s.truth = q.truth GROUP BY q.truth""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    box = evaluate.score_box(scored(spark, sf), "truth", "score")
    return rounded(box, "q1", "median", "q3", "whisker_low", "whisker_high")


# A small lexicon in the words of the documents.
LEXICON: dict[str, dict[str, float]] = {
    "english": {"the": 0.5, "of": 0.5, "and": 0.5, "with": 1.0, "this": 1.0},
    "french": {"le": 0.5, "les": 1.0, "des": 1.0, "et": 0.5},
    "german": {"der": 1.0, "die": 0.5, "und": 1.0, "von": 1.0},
    "spanish": {"el": 1.0, "que": 0.5, "los": 1.0, "la": 0.25},
}
LEXICON_SQL = ", ".join(
    f"('{label}', '{term}', {weight}::DOUBLE)" for label, terms in LEXICON.items() for term, weight in terms.items()
)
ASPECT_SQL = f"""(WITH t AS (SELECT doc_id, unnest({sq.tokens('text')}) AS term FROM documents),
    h AS (SELECT doc_id, label, sum(weight) AS w FROM t JOIN (VALUES {LEXICON_SQL}) AS x(label, term, weight) USING (term)
          GROUP BY doc_id, label)
    SELECT d.doc_id, d.n_chars, """ + ", ".join(
    f"coalesce(max(w) FILTER (label = '{label}'), 0.0) / (coalesce(max(w) FILTER (label = '{label}'), 0.0) + 1) AS score_{label}"
    for label in LEXICON
) + " FROM documents d LEFT JOIN h USING (doc_id) GROUP BY d.doc_id, d.n_chars)"
SCORES = [aspects.score_column(label) for label in LEXICON]
ROUNDED_SQL = ", ".join(f"round({name}, 6) AS {name}" for name in SCORES)


@query("asp1_aspect_scores", f"SELECT doc_id, {ROUNDED_SQL} FROM {ASPECT_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    found = aspects.score(documents(spark, sf).select("doc_id", "text"), "text", LEXICON)
    return rounded(found.drop("text"), *SCORES)


@query("asp1_scores_from_table", f"SELECT doc_id, {ROUNDED_SQL} FROM {ASPECT_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(label, term, weight) for label, terms in LEXICON.items() for term, weight in terms.items()]
    lexicon = spark.createDataFrame(rows, "label string, term string, weight double")
    docs = documents(spark, sf).select("doc_id", "text")
    return rounded(aspects.score_with_table(docs, "doc_id", "text", lexicon, list(LEXICON)), *SCORES)


BEST_SQL = "CASE " + " ".join(
    f"WHEN score_{label} = greatest({', '.join(SCORES)}) THEN '{label}'" for label in LEXICON
) + " END"


@query("asp2_best_aspect", f"SELECT doc_id, {BEST_SQL} AS best_topic FROM {ASPECT_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    found = aspects.score(documents(spark, sf).select("doc_id", "text"), "text", LEXICON)
    return aspects.best_aspect(found, list(LEXICON)).select("doc_id", "best_topic")


@query(
    "asp2_aspect_stats",
    f"""WITH b AS (SELECT {BEST_SQL} AS best_topic, n_chars FROM {ASPECT_SQL})
        SELECT best_topic, 'median' AS statistic, round(median(n_chars), 6) AS value FROM b GROUP BY best_topic
        UNION ALL SELECT best_topic, 'mean', round(avg(n_chars), 6) FROM b GROUP BY best_topic
        UNION ALL SELECT best_topic, 'max', max(n_chars)::DOUBLE FROM b GROUP BY best_topic""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    found = aspects.score(documents(spark, sf).select("doc_id", "text", "n_chars"), "text", LEXICON)
    return rounded(aspects.aspect_stats(found, list(LEXICON), "n_chars"), "value")

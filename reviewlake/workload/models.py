"""Fitted models.

What a fit finds depends on numerical optimisation, so most queries return facts about the fitted result that SQL can
work out from the tables: sizes, conserved sums, and counts of rows that break what the model promises.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.scalars import squared_distance
from reviewlake.operators import clusters, sentiment, topics, vectors
from reviewlake.operators.blocks import mean_silhouettes
from reviewlake.operators.filters import at_least_chars
from reviewlake.plans import review_analysis, review_topics, topic_model
from reviewlake.session import cut_lineage, stored
from reviewlake.workload.registry import REVIEWS_SQL, documents, query, reviews, scratch, six, table
from reviewlake.workload.text import STOP_WORDS
from reviewlake.workload.vectors import ALL_SQL, text_vectors, vocabulary_sql, worded


def embedded(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


def kmeans_facts(rows: DataFrame, model: KMeansModel, vector: str) -> DataFrame:
    """One row: rows, clusters, ``strays`` (rows nearer to another centre) and ``moved`` (centres off their members' mean)."""
    placed = clusters.as_vector(clusters.assign(rows, model, vector), vector)
    centres = rows.sparkSession.createDataFrame(
        [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())],
        "topic int, centre array<double>",
    )
    listed = centres.agg(F.array_sort(F.collect_list(F.struct("topic", "centre")))).scalar()
    far = F.transform("_centres", lambda c: squared_distance(F.col("_v"), c["centre"]))
    measured = placed.select("cluster", vector_to_array(F.col(vector)).alias("_v"), listed.alias("_centres")).select(
        "cluster", far.alias("_far")
    )
    stray = F.get("_far", F.col("cluster")) > F.array_min("_far") + 1e-6
    means = topics.centres(placed.withColumn("topic", F.col("cluster")), "topic", vector)
    shift = squared_distance(F.col("centre"), F.col("_mean"))
    moved = centres.join(means.withColumnRenamed("centre", "_mean"), "topic").agg(
        F.count_if(shift > 1e-4).alias("moved")
    )
    return measured.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("cluster").alias("clusters"),
        F.count_if(stray).alias("strays"),
    ).withColumn("moved", moved.scalar())


def kmeans_sql(name: str, k: int) -> str:
    return f"SELECT count(*) AS rows, {k} AS clusters, 0 AS strays, 0 AS moved FROM {name}"


@query("clu1_text_kmeans", kmeans_sql("documents", 5))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = text_vectors(spark, sf)
    return kmeans_facts(rows, clusters.kmeans(rows, "features", 5), "features")


@query(
    "clu1_product_clusters",
    """SELECT count(*) AS descriptions, CAST(sum(n) AS BIGINT) AS rows, 5 AS clusters, 0 AS divided
       FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY p_type, p_brand)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    placed = review_analysis.cluster_products(part, "p_type", "p_brand", 5)
    equal = placed.groupBy("p_type", "p_brand").agg(
        F.count("meta_category").alias("n"),
        F.min("meta_category").alias("low"),
        F.max("meta_category").alias("high"),
    )
    return equal.agg(
        F.count(F.lit(1)).alias("descriptions"),
        F.sum("n").alias("rows"),
        F.count_distinct("low").alias("clusters"),
        F.count_if(F.col("low") != F.col("high")).alias("divided"),
    )


@query("clu2_embedding_kmeans", kmeans_sql("embeddings", 5))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = embedded(spark, sf)
    return kmeans_facts(rows, clusters.kmeans(rows, "embedding", 5), "embedding")


@query("clu3_assign_clusters", kmeans_sql("embeddings", 10))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = embedded(spark, sf)
    return kmeans_facts(rows, clusters.kmeans(rows, "embedding", 10), "embedding")


COORDINATES_SQL = """(SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
    FROM embeddings)"""
TOTAL_SQL = f"(SELECT sum(v) FROM (SELECT var_samp(x) AS v FROM {COORDINATES_SQL} GROUP BY pos))"
COORDINATES = 64


@query(
    "clu5_pca",
    f"""SELECT count(*) AS rows, round({TOTAL_SQL}, 6) AS variance, 0 AS crossed, 0 AS rising FROM embeddings""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # A full rotation keeps the total variance; its components are uncorrelated and fall in variance.
    rows = embedded(spark, sf)
    moved = clusters.pca(rows, "embedding", COORDINATES).transform(rows, "embedding")
    parts = moved.select(*[F.col("components")[i].alias(f"c{i}") for i in range(COORDINATES)])
    variances = [F.var_samp(f"c{i}") for i in range(COORDINATES)]
    crossed = [
        (F.abs(F.covar_samp(f"c{i}", f"c{j}")) > 1e-9).cast("int") for i in range(8) for j in range(i)
    ]
    rising = [(variances[i + 1] > variances[i] + 1e-9).cast("int") for i in range(COORDINATES - 1)]
    return parts.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(sum(variances[1:], variances[0]), 6).alias("variance"),
        sum(crossed[1:], crossed[0]).alias("crossed"),
        sum(rising[1:], rising[0]).alias("rising"),
    )


@query(
    "clu5_explained_variance",
    f"""SELECT {COORDINATES} AS components, 1.0::DOUBLE AS total, round(sum(c * c) / power({TOTAL_SQL}, 2), 9) AS squares
        FROM (SELECT covar_samp(a.x, b.x) AS c FROM {COORDINATES_SQL} a JOIN {COORDINATES_SQL} b USING (vec_id)
              GROUP BY a.pos, b.pos)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # The squared shares add up to the squared entries of the covariance matrix over its squared trace.
    shares = clusters.pca(embedded(spark, sf), "embedding", COORDINATES).explained_variance
    rows = [(i + 1, share) for i, share in enumerate(shares)]
    return spark.createDataFrame(rows, "component long, explained double").agg(
        F.count(F.lit(1)).alias("components"),
        F.round(F.sum("explained"), 9).alias("total"),
        F.round(F.sum(F.col("explained") * F.col("explained")), 9).alias("squares"),
    )


@query(
    "clu5_projected_centres",
    """WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
         o AS (SELECT pos, avg(x) AS m FROM e GROUP BY pos),
         c AS (SELECT label, pos, avg(x) AS m FROM e GROUP BY label, pos)
       SELECT label AS topic, round(sqrt(sum((c.m - o.m) * (c.m - o.m))), 6) AS distance FROM c JOIN o USING (pos) GROUP BY label""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster centres moved to the components of all rows: a full rotation keeps their distance from the mean of all rows."""
    rows = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    projection = clusters.pca(rows, "embedding", COORDINATES)
    moved = projection.transform(topics.centres(rows, "label", "embedding"), "centre")
    length = F.sqrt(F.aggregate("components", F.lit(0.0), lambda a, x: a + x * x))
    return moved.select("topic", six(length).alias("distance"))


@query("clu6_silhouette_sweep")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.silhouette_sweep(embedded(spark, sf), "embedding")


@query(
    "clu6_silhouette",
    """WITH d AS (
         SELECT a.vec_id, a.label AS own, b.label AS other, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
         FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
       m AS (SELECT vec_id, own, other, avg(d) AS d FROM d GROUP BY vec_id, own, other),
       s AS (SELECT vec_id, max(d) FILTER (own = other) AS a, min(d) FILTER (own <> other) AS b FROM m GROUP BY vec_id)
       SELECT 'label' AS labelling, round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
         AS silhouette FROM s""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The given labels as clusters: exact mean distances, as the sweep takes them for its own clusters."""
    rows = table(spark, sf, "embeddings")
    found = mean_silhouettes(rows, "embedding", ["label"])
    return found.withColumn("silhouette", six("silhouette"))


@query(
    "clu7_elbow_sweep",
    f"""SELECT 6 AS runs, round(sum(v * n), 4) AS one_cluster, 0 AS rising
        FROM (SELECT var_pop(x) AS v, count(*) AS n FROM {COORDINATES_SQL} GROUP BY pos)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    costs = clusters.elbow_sweep(embedded(spark, sf), "embedding")
    smaller = costs.select((F.col("k") + 1).alias("k"), F.col("inertia").alias("_before"))
    return costs.join(smaller, "k", "left").agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(F.max(F.when(F.col("k") == 1, F.col("inertia"))), 4).alias("one_cluster"),
        F.count_if(F.col("inertia") > F.col("_before")).alias("rising"),
    )


def topic_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that have an embedding."""
    vectors_by_id = embedded(spark, sf).withColumnRenamed("vec_id", "doc_id")
    return worded(spark, sf).join(vectors_by_id, "doc_id")


@query("top1_topic_model")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Topics of all embedded documents by 50 components; the clustering is tested against a plain version."""
    rows = topic_documents(spark, sf)
    _, placed = topic_model.fit(rows, "doc_id", "embedding", "words", components=50, min_samples=3, min_cluster_size=5)
    return placed.select("doc_id", "topic", "topic_name")


@query(
    "top1_topic_facts",
    "SELECT count(*) AS rows, 0 AS small, 0 AS misnamed, 0 AS unordered FROM documents JOIN embeddings ON doc_id = vec_id",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Topics are large enough, numbered by falling size, and named by their number or as outliers."""
    rows = topic_documents(spark, sf)
    _, placed = topic_model.fit(rows, "doc_id", "embedding", "words", components=50, min_samples=3, min_cluster_size=5)
    outlier = F.col("topic_name") == "Outlier"
    named = F.when(F.col("topic") == -1, outlier).otherwise(F.col("topic_name").startswith(F.concat("topic", F.lit("_"))))
    sizes = placed.groupBy("topic").agg(F.count(F.lit(1)).alias("size"), F.count_if(~named).alias("misnamed"))
    following = sizes.select((F.col("topic") - 1).alias("topic"), F.col("size").alias("_next"))
    real = F.col("topic") >= 0
    return sizes.join(following, "topic", "left").agg(
        F.sum("size").alias("rows"),
        F.count_if(real & (F.col("size") < 5)).alias("small"),
        F.sum("misnamed").alias("misnamed"),
        F.count_if(real & (F.col("_next") > F.col("size"))).alias("unordered"),
    )


SOURCES_SQL = r"(SELECT CAST(regexp_extract(source, '(\d+)$', 1) AS BIGINT) AS topic FROM documents)"


@query("top3_reduce_topics", f"SELECT count(*) AS rows, least(12, count(DISTINCT topic)) AS topics FROM {SOURCES_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = numbered_sources(spark, sf)
    counts = source_counts(rows)
    reduced = topics.reduce_topics(rows, "topic", counts, 12)
    return reduced.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("topic").alias("topics"))


def numbered_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their source number as the topic."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("long")
    return worded(spark, sf).withColumn("topic", number)


def source_counts(rows: DataFrame) -> DataFrame:
    """Uses of the 1,000 most frequent n-grams per topic."""
    vocab = vectors.vocabulary(rows, "words", (1, 3), 1000, 10, 0.7)
    return topics.term_counts(rows, "topic", "words", vectors.vocabulary_terms(vocab, 1000), (1, 3))


@query(
    "top5_hierarchy",
    f"""SELECT count(*) - 1 AS merges, count(*) - 1 AS topics, 0 AS gone, arg_min(topic, (size, topic)) AS first
        FROM (SELECT topic, count(*) AS size FROM {SOURCES_SQL} GROUP BY topic)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = numbered_sources(spark, sf)
    sizes = rows.groupBy("topic").agg(F.count(F.lit(1)).alias("size"))
    merges = topics.hierarchy(rows, source_counts(rows), sizes)
    # A topic is merged once, the smallest first, and nothing is merged into one that is gone.
    before = merges.select(F.col("topic").alias("into"), F.col("step").alias("_gone"))
    return merges.join(before, "into", "left").agg(
        F.count(F.lit(1)).alias("merges"),
        F.count_distinct("topic").alias("topics"),
        F.count_if(F.col("_gone") <= F.col("step")).alias("gone"),
        F.min_by("topic", "step").alias("first"),
    )


def lda_counts(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """(doc_id, counts) and the terms. Texts are split once and counted once: a fit and what is asked of it read the counts."""
    docs = stored(worded(spark, sf).select("doc_id", "words"))
    vocab = vectors.vocabulary(docs, "words", (1, 2), 1500, 15, 0.6)
    terms = vectors.vocabulary_terms(vocab, 1500)
    counted = vectors.count_vectors(docs, "words", terms, (1, 2))
    return cut_lineage(counted.select("doc_id", "counts")), terms


LDA_TERMS_SQL = vocabulary_sql(1, 2, 1500, "15", f"0.6 * {ALL_SQL}")


def topic_facts(placed: DataFrame, weights: str) -> DataFrame:
    """(doc_id, total, topics, heaviest, confidence): what the weights of all topics say of a document's topic."""
    top = F.array_max(weights)
    return placed.select(
        "doc_id",
        six(F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)).alias("total"),
        F.size(weights).cast("long").alias("topics"),
        (F.array_position(weights, top) - 1 == F.col("topic")).alias("heaviest"),
        six(F.col("confidence") - top).alias("off"),
    )


@query("lda1_topic_sizes", "SELECT count(*) AS rows, true AS within, count(*)::DOUBLE AS weight, 0 AS off FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes by topic add up to all documents, as the weights of all topics do, and fit the documents' heaviest weights."""
    rows, _ = lda_counts(spark, sf)
    placed = topics.lda_topics(rows, topics.lda(rows, "counts", 3), "weights")
    heaviest = F.array_position("weights", F.array_max("weights")) - 1
    sizes = placed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("count"), F.count_if(heaviest != F.col("topic")).alias("off"),
        F.sum(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)).alias("weight"),
    )
    return sizes.agg(
        F.sum("count").alias("rows"), F.bool_and(F.col("topic").between(0, 2)).alias("within"),
        F.round(F.sum("weight"), 6).alias("weight"), F.sum("off").alias("off"),
    )


@query("lda2_top_words", f"SELECT term, 6 AS topics, true AS positive FROM {LDA_TERMS_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows, terms = lda_counts(spark, sf)
    # Read to its end, the list of every topic is the whole vocabulary.
    listed = topics.lda_top_words(topics.lda(rows, "counts", 6), terms, len(terms))
    return listed.groupBy("term").agg(
        F.count_distinct("topic").alias("topics"), F.bool_and(F.col("weight") > 0).alias("positive")
    )


FACTS_SQL = "doc_id, 1.0::DOUBLE AS total, {k}::BIGINT AS topics, true AS heaviest, 0.0::DOUBLE AS off FROM documents"


@query("lda3_document_topics", f"SELECT {FACTS_SQL.format(k=7)}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = lda_counts(spark, sf)
    return topic_facts(topics.lda_topics(rows, topics.lda(rows, "counts", 7), "weights"), "weights")


@query("lda3_topics_of_cleaned_reviews", f"SELECT {FACTS_SQL.format(k=3)} WHERE length(text) >= 20")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf).select("doc_id", "text")
    model = review_topics.fit(rows, "text", 3, STOP_WORDS)
    return topic_facts(model.place(rows, "text", "weights"), "weights")


@query(
    "lda4_perplexity",
    f"""SELECT count(*) AS terms, CAST(sum(frequency) AS BIGINT) AS uses, true AS plausible FROM {LDA_TERMS_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Terms known to be used are guessed better than all terms alike, over all uses of all terms."""
    rows, terms = lda_counts(spark, sf)
    perplexity = topics.lda_perplexity(topics.lda(rows, "counts", 3), rows)
    found = rows.agg(Summarizer.sum(F.col("counts")).alias("sums")).select(
        F.aggregate(vector_to_array("sums"), F.lit(0.0), lambda a, x: a + x).cast("long").alias("uses"),
        F.lit(len(terms)).cast("long").alias("terms"),
    )
    return found.select("terms", "uses", F.lit(perplexity).between(1, F.col("terms")).alias("plausible"))


def sentiment_run(spark: SparkSession, sf: str) -> review_analysis.SentimentRun:
    rows = at_least_chars(reviews(spark, sf).select("doc_id", "text", "quality"), "text", 10)
    return review_analysis.run_sentiment(rows, "text", "quality", "doc_id", scratch(spark))


TEST_SQL = f"""(SELECT quality, count(*) - CAST(floor(0.8 * count(*)) AS BIGINT) AS rows FROM {REVIEWS_SQL}
    WHERE length(text) >= 10 GROUP BY quality)"""


@query(
    "sen1_train_metrics",
    f"""SELECT CAST(sum(rows) FILTER (quality = 0) AS BIGINT) AS support_0, CAST(sum(rows) FILTER (quality = 1) AS BIGINT) AS support_1,
          CAST(sum(rows) AS BIGINT) AS support, 0.0::DOUBLE AS accuracy_gap, 0.0::DOUBLE AS recall_gap FROM {TEST_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # The report against the scored rows themselves.
    run = sentiment_run(spark, sf)
    hit = (F.col("prediction") == F.col("quality")).cast("double")
    plain = run.scored.agg(F.avg(hit).alias("_hits"), F.avg(F.when(F.col("quality") == 1, hit)).alias("_recall"))

    def of(name: str, measure: str):
        return F.max(F.when(F.col("name") == name, F.col(measure)))

    facts = run.metrics.agg(
        of("0", "support").alias("support_0"),
        of("1", "support").alias("support_1"),
        of("accuracy", "support").alias("support"),
        of("accuracy", "precision").alias("_accuracy"),
        of("1", "recall").alias("_positive"),
    )
    return facts.select(
        "support_0",
        "support_1",
        "support",
        F.abs(six(F.col("_accuracy") - plain.select("_hits").scalar())).alias("accuracy_gap"),
        F.abs(six(F.col("_positive") - plain.select("_recall").scalar())).alias("recall_gap"),
    )


@query("sen2_batch_scores", f"SELECT quality, rows, 0 AS odd FROM {TEST_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    said = F.col("prediction") == (F.col("probability") > 0.5).cast("int")
    fits = said & F.col("probability").between(0, 1)
    return sentiment_run(spark, sf).scored.groupBy("quality").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(fits, F.lit(False))).alias("odd")
    )


@query(
    "sen2_score_with",
    """SELECT doc_id, CASE WHEN length(text) > 1000 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS label,
         CASE WHEN length(text) > 1000 THEN 0.75 ELSE 0.5 END::DOUBLE AS score FROM documents""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    def by_length(batch):
        long = batch["text"].str.len() > 1000
        return batch[["doc_id"]].assign(
            label=long.map({True: "POSITIVE", False: "NEGATIVE"}), score=long.map({True: 0.75, False: 0.5})
        )

    return sentiment.score_with(
        table(spark, sf, "documents"), ["doc_id", "text"], by_length, "doc_id long, label string, score double"
    )


@query("mod1_save_load", f"SELECT count(*) AS rows, 0 AS mismatches FROM {REVIEWS_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews(spark, sf).select("doc_id", "text", "quality")
    model = sentiment.train(rows, "text", "quality", stop_words=STOP_WORDS)
    path = scratch(spark)
    sentiment.save(model, path)
    return sentiment.reload_mismatches(rows, "doc_id", model, sentiment.load(path))


@query("sen3_reload_check", "SELECT count(*) AS rows, 0::BIGINT AS mismatches FROM documents JOIN labels USING (doc_id)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = reviews(spark, sf).select("doc_id", "text", "quality")
    run = review_analysis.run_sentiment(rows, "text", "quality", "doc_id", f"{path}/split")
    sentiment.save(run.model, f"{path}/model")
    return sentiment.reload_mismatches(rows, "doc_id", run.model, sentiment.load(f"{path}/model"))

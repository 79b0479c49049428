"""Vocabularies, TF-IDF, cluster terms and topic keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import clusters, density, hierarchy, topics, vectors
from reviewlake.session import cut_lineage
from reviewlake.workload import sqltext as sq
from reviewlake.workload.registry import documents, query, rounded, table
from reviewlake.workload.text import STOP_SQL, STOP_WORDS


def worded(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as tokens without stop words."""
    words = tx.remove_stop_words(tx.tokens(F.col("text")), STOP_WORDS)
    return documents(spark, sf).select("doc_id", "source", "lang", words.alias("words"))


WORDED_SQL = f"""(SELECT doc_id, source, lang, list_filter({sq.tokens('text')}, lambda w: w NOT IN ({STOP_SQL})) AS words
    FROM documents)"""


def vocabulary_sql(low: int, high: int, top: int | None, min_df: str = "1", max_df: str = "1e18") -> str:
    limit = f"ORDER BY frequency DESC, term LIMIT {top}" if top else ""
    return f"""(SELECT term, count(DISTINCT doc_id) AS df, count(*) AS frequency FROM (
        SELECT doc_id, unnest({sq.grams('words', low, high)}) AS term FROM {WORDED_SQL}) GROUP BY term
        HAVING count(DISTINCT doc_id) >= {min_df} AND count(DISTINCT doc_id) <= {max_df} {limit})"""


ALL_SQL = "(SELECT count(*) FROM documents)"


@query("vec1_vocabulary_1_3", f"SELECT * FROM {vocabulary_sql(1, 3, 1000)}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.vocabulary(worded(spark, sf), "words", (1, 3), 1000)


@query(
    "vec1_vocabulary_1_2_bounded",
    f"SELECT * FROM {vocabulary_sql(1, 2, 1500, '15', f'0.6 * {ALL_SQL}')}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.vocabulary(worded(spark, sf), "words", (1, 2), 1500, 15, 0.6)


@query(
    "vec1_vocabulary_2_3",
    f"SELECT * FROM {vocabulary_sql(2, 3, 1500, '15', f'0.6 * {ALL_SQL}')}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.vocabulary(worded(spark, sf), "words", (2, 3), 1500, 15, 0.6)


@query(
    "vec1_vocabulary_1_3_bounded",
    f"SELECT * FROM {vocabulary_sql(1, 3, 1000, '10', f'0.7 * {ALL_SQL}')}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.vocabulary(worded(spark, sf), "words", (1, 3), 1000, 10, 0.7)


@query("vec1_vocabulary_min_df", f"SELECT * FROM {vocabulary_sql(1, 2, None, '5')}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.vocabulary(worded(spark, sf), "words", (1, 2), None, 5)


def tfidf_sql(low: int, high: int, vocab: str) -> str:
    return f"""(WITH v AS {vocab},
      t AS (SELECT doc_id, unnest({sq.grams('words', low, high)}) AS term FROM {WORDED_SQL}),
      c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
      r AS (SELECT doc_id, term, tf * (ln((1 + {ALL_SQL})::DOUBLE / (1 + df)) + 1) AS raw FROM c JOIN v USING (term)),
      n AS (SELECT doc_id, sqrt(sum(raw * raw)) AS norm FROM r GROUP BY doc_id)
      SELECT doc_id, term, raw / norm AS weight FROM r JOIN n USING (doc_id))"""


TFIDF_SQL = tfidf_sql(1, 3, vocabulary_sql(1, 3, 1000))


def text_vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Documents with their TF-IDF vector over 1,000 n-grams, and the terms."""
    docs = worded(spark, sf)
    vocab = vectors.vocabulary_rows(vectors.vocabulary(docs, "words", (1, 3), 1000), 1000)
    placed = vectors.tfidf_vectors(docs, "words", vocab, docs.count(), (1, 3))
    return placed.drop("words"), [term for term, _ in vocab]


def weights(spark: SparkSession, sf: str) -> DataFrame:
    docs = worded(spark, sf)
    vocab = vectors.vocabulary(docs, "words", (1, 3), 1000)
    return vectors.tfidf(docs, "doc_id", "words", vocab, (1, 3), 1000)


@query("vec2_tfidf", f"SELECT doc_id, term, round(weight, 6) AS weight FROM {TFIDF_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(weights(spark, sf), "weight")


@query(
    "vec2_tfidf_all_terms",
    f"SELECT doc_id, term, round(weight, 6) AS weight FROM {tfidf_sql(1, 1, vocabulary_sql(1, 1, None))}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = worded(spark, sf)
    vocab = vectors.vocabulary(docs, "words")
    return rounded(vectors.tfidf(docs, "doc_id", "words", vocab), "weight")


@query(
    "clu4_top_terms",
    f"""WITH w AS {TFIDF_SQL}, s AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
          c AS (SELECT d.lang, term, round(sum(weight) / any_value(s.n), 9) AS weight FROM w JOIN documents d USING (doc_id)
                JOIN s ON s.lang = d.lang GROUP BY d.lang, term)
        SELECT lang, term, round(weight, 6) AS weight, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, term) AS rank FROM c) WHERE rank <= 10""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    placed, terms = text_vectors(spark, sf)
    return rounded(clusters.top_terms(placed, "features", "lang", terms), "weight")


CTFIDF_SQL = f"""(WITH t AS (SELECT source AS topic, unnest(words) AS term FROM {WORDED_SQL}),
    c AS (SELECT topic, term, count(*) AS n FROM t GROUP BY topic, term),
    w AS (SELECT topic, sum(n) AS words FROM c GROUP BY topic),
    u AS (SELECT term, sum(n) AS uses FROM c GROUP BY term)
    SELECT topic, term, (n / words) * ln(1 + (SELECT avg(words) FROM w) / uses) AS weight
    FROM c JOIN w USING (topic) JOIN u USING (term))"""

KEYWORDS_SQL = f"""(SELECT topic, term, weight, rank FROM (SELECT topic, term, round(weight, 9) AS weight,
    row_number() OVER (PARTITION BY topic ORDER BY round(weight, 9) DESC, term) AS rank FROM {CTFIDF_SQL}) WHERE rank <= 10)"""


def source_weights(spark: SparkSession, sf: str) -> DataFrame:
    return topics.ctfidf(topics.term_counts(worded(spark, sf), "source", "words"))


@query("top2_keywords", f"SELECT topic, term, round(weight, 6) AS weight, rank FROM {KEYWORDS_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(topics.keywords(source_weights(spark, sf)), "weight")


NAMES_SQL = f"""(SELECT topic, topic || '_' || string_agg(term, '_' ORDER BY rank) AS topic_name FROM {KEYWORDS_SQL}
    WHERE rank <= 4 GROUP BY topic)"""


@query("top2_topic_names", f"SELECT * FROM {NAMES_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return topics.names(topics.keywords(source_weights(spark, sf)))


@query(
    "top4_topic_info",
    f"""SELECT topic, count, topic_name FROM (SELECT source AS topic, count(*) AS count FROM documents GROUP BY source)
        LEFT JOIN {NAMES_SQL} USING (topic)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = worded(spark, sf)
    names = topics.names(topics.keywords(source_weights(spark, sf)))
    return topics.topic_info(docs, "source", names)


@query(
    "top5_similarity",
    f"""WITH w AS {CTFIDF_SQL}, n AS (SELECT topic, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY topic),
          u AS (SELECT topic, term, weight / norm AS x FROM w JOIN n USING (topic))
        SELECT a.topic AS topic_a, b.topic AS topic_b, round(sum(a.x * b.x), 6) AS cosine
        FROM u a JOIN u b ON a.term = b.term AND a.topic < b.topic GROUP BY a.topic, b.topic""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(topics.similarity(source_weights(spark, sf)), "cosine")


@query(
    "top6_assign_topics",
    """WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
         c AS (SELECT label AS topic, pos, avg(x) AS m FROM e GROUP BY label, pos),
         d AS (SELECT vec_id, topic, sqrt(sum((x - m) * (x - m))) AS d FROM e JOIN c USING (pos) GROUP BY vec_id, topic),
         r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, topic) AS rn FROM d)
       SELECT vec_id, CASE WHEN d <= 0.95 THEN topic ELSE -1 END AS topic FROM r WHERE rn = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    centres = topics.centres(rows, "label", "embedding")
    return clusters.nearest(rows, "embedding", centres, 0.95).select("vec_id", "topic")


CELLS_SQL = """(SELECT vec_id, CAST(floor(embedding[1]::DOUBLE / 0.05) AS BIGINT) AS x,
    CAST(floor(embedding[2]::DOUBLE / 0.05) AS BIGINT) AS y FROM embeddings)"""
DENSITY_SQL = f"""(WITH c AS (SELECT x, y, count(*) AS points FROM {CELLS_SQL} GROUP BY x, y)
    SELECT a.x, a.y, any_value(a.points) AS points, CAST(sum(b.points) AS BIGINT) AS nearby FROM c a JOIN c b
      ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY a.x, a.y)"""


@query("clu8_cell_densities", f"SELECT x, y, points, nearby FROM {DENSITY_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    cells = clusters.grid_cells(table(spark, sf, "embeddings"), "embedding", 0.05, 2)
    found = clusters.cell_densities(cells, 2)
    return found.select(F.col("cell")[0].alias("x"), F.col("cell")[1].alias("y"), "points", "nearby")


NEAR_SQL = """(SELECT a.vec_id, b.vec_id AS other FROM embeddings a JOIN embeddings b
    ON list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) <= 1.16)"""


@query("clu8_neighbour_counts", f"SELECT vec_id, count(*) AS nearby FROM {NEAR_SQL} GROUP BY vec_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Points near every row; equal vectors are compared once, and each of their rows has the count."""
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    points = cut_lineage(density.with_blocks(density.distinct_points(rows, "vec_id", "embedding"), 1.16, 2))
    counts = points.join(density.neighbour_counts(points, 1.16, 2), "node").select("name", "nearby")
    return density.of_rows(rows, "vec_id", "embedding", counts).select("vec_id", "nearby")


@query(
    "clu8_density_clusters",
    f"""WITH RECURSIVE near AS MATERIALIZED {NEAR_SQL},
          core AS MATERIALIZED (SELECT vec_id FROM near GROUP BY vec_id HAVING count(*) >= 5),
          link AS MATERIALIZED (SELECT n.vec_id, n.other FROM near n SEMI JOIN core c ON n.other = c.vec_id),
          reach(vec_id, r) AS (SELECT vec_id, vec_id FROM core
            UNION SELECT l.vec_id, r.r FROM reach r JOIN link l ON l.other = r.vec_id SEMI JOIN core c ON l.vec_id = c.vec_id),
          part AS (SELECT vec_id, min(r) AS component FROM reach GROUP BY vec_id),
          member AS (SELECT * FROM part UNION ALL
            SELECT l.vec_id, min(p.component) FROM link l JOIN part p ON l.other = p.vec_id
            WHERE l.vec_id NOT IN (SELECT vec_id FROM core) GROUP BY l.vec_id),
          sizes AS (SELECT component, count(*) AS size FROM member GROUP BY component HAVING count(*) >= 5),
          num AS (SELECT component, row_number() OVER (ORDER BY size DESC, component) - 1 AS cluster FROM sizes)
        SELECT vec_id, CAST(coalesce(cluster, -1) AS INTEGER) AS cluster FROM embeddings
        LEFT JOIN member USING (vec_id) LEFT JOIN num USING (component)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return density.density_clusters(rows, "vec_id", "embedding", 1.16, 5, 5).select("vec_id", "cluster")


SAMPLES = 10
CORE_SQL = f"""(SELECT vec_id, core FROM (
    SELECT a.vec_id, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS core,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS place
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE place = {SAMPLES})"""


def embedding_points(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy.numbered_points(table(spark, sf, "embeddings"), "vec_id", "embedding")


@query("clu8_core_distances", f"SELECT vec_id, round(core, 6) AS core FROM {CORE_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    points = embedding_points(spark, sf)
    cores = hierarchy.opened_points(hierarchy.core_distances(points, SAMPLES))
    return rounded(points.join(cores, "number").select(F.col("node").alias("vec_id"), "core"), "core")


@query(
    "clu8_tree_edges",
    f"""WITH core AS MATERIALIZED {CORE_SQL}
        SELECT a.vec_id, round(min(greatest(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), x.core, y.core)), 6) AS w
        FROM embeddings a JOIN core x ON a.vec_id = x.vec_id JOIN embeddings b ON a.vec_id <> b.vec_id
          JOIN core y ON b.vec_id = y.vec_id GROUP BY a.vec_id""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The shortest edge of the spanning tree at every point, which is its shortest of all; the tree's edges are tested too."""
    points = embedding_points(spark, sf)
    tree, _, _ = hierarchy.linkage(points, SAMPLES, 15)
    ends = tree.select(F.explode(F.array("i", "j")).alias("number"), "w").groupBy("number").agg(F.min("w").alias("w"))
    return rounded(ends.join(points, "number").select(F.col("node").alias("vec_id"), "w"), "w")


@query("clu8_hierarchy")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The most stable clusters of all embeddings; tested against a plain version."""
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    found = hierarchy.hierarchical_clusters(rows, "vec_id", "embedding", 5, 3, probability="probability")
    return rounded(found.select("vec_id", "cluster", "probability"), "probability")

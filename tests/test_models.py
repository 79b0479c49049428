from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.operators import aspects, clusters, components, density, sentiment, topics, vectors
from reviewlake.plans import review_analysis, review_topics, topic_model
from reviewlake.workload import models as queries_of_models
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    rows = []
    for label, (x, y) in enumerate([(0.0, 0.0), (5.0, 5.0), (10.0, 0.0)]):
        rows += [(label, [float(x + a), float(y + b)]) for a, b in rng.normal(0, 0.2, (120, 2))]
    # Copies and far-off points.
    rows += [(0, [0.0, 0.0])] * 200
    rows += [(-1, [50.0 + 7 * i, -40.0]) for i in range(6)]
    return spark.createDataFrame(
        [(i, label, point) for i, (label, point) in enumerate(rows)], "id long, label int, v array<double>"
    ).persist()


def test_density_clusters_find_blobs_and_noise(blobs):
    found = density.density_clusters(blobs, "id", "v", 0.5, min_samples=10, min_cluster_size=15).collect()
    assert len(found) == blobs.count()
    by_label = {label: Counter(r["cluster"] for r in found if r["label"] == label) for label in (-1, 0, 1, 2)}
    assert set(by_label[-1]) == {-1}
    # The largest cluster is number 0.
    assert by_label[0].most_common(1)[0][0] == 0
    assert {by_label[1].most_common(1)[0][0], by_label[2].most_common(1)[0][0]} == {1, 2}
    assert sum(c.most_common(1)[0][1] for c in by_label.values()) >= 560


def test_small_clusters_are_noise(blobs):
    found = density.density_clusters(blobs, "id", "v", 0.5, min_samples=10, min_cluster_size=200)
    assert set(r["cluster"] for r in found.select("cluster").distinct().collect()) == {-1, 0}


def brute_density(points, radius, min_samples, min_cluster_size):
    v = np.array(points, dtype=float)
    near = ((v[:, None] - v[None]) ** 2).sum(-1) <= radius**2
    core = near.sum(1) >= min_samples
    labels = np.where(core, np.arange(len(v)), len(v))
    while True:
        reached = np.where(near & core[None] & core[:, None], labels[None], len(v)).min(1)
        if (reached == labels).all():
            break
        labels = reached
    labels = np.where(core, labels, np.where(near & core[None], labels[None], len(v)).min(1))
    sizes = Counter(x for x in labels if x < len(v))
    kept = sorted((x for x in sizes if sizes[x] >= min_cluster_size), key=lambda x: (-sizes[x], x))
    return [kept.index(x) if x in kept else -1 for x in labels]


def density_labels(spark, points, radius, *sizes, dimensions=2):
    df = spark.createDataFrame(list(enumerate(points)), "id long, v array<double>")
    found = density.density_clusters(df, "id", "v", radius, *sizes, dimensions=dimensions).collect()
    assert len(found) == len(points)
    return [r["cluster"] for r in sorted(found, key=lambda r: r["id"])]


def test_density_reads_every_coordinate(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(0, 0.1, (200, 5))
    points[100:, 4] += 9
    found = density_labels(spark, points.tolist(), 0.5, 5, 20)
    assert {found[0], found[150]} == {0, 1} and len(set(found[:100])) == 1 and len(set(found[100:])) == 1


@pytest.mark.parametrize("dimensions", [1, 3])
def test_density_equals_brute_force(spark, dimensions):
    # Crowded cells of many blocks, copies, ties on the radius and lone points.
    rng = np.random.default_rng(7)
    points = np.vstack([rng.normal(0, 1, (500, 3)), np.repeat(rng.normal(3, 1, (4, 3)), 30, axis=0)]).round(1)
    for radius, *sizes in [(0.4, 6, 10), (0.5, 3, 4)]:
        found = density_labels(spark, points.tolist(), radius, *sizes, dimensions=dimensions)
        assert found == brute_density(points, radius, *sizes)


def test_density_of_odd_vectors(spark):
    points = [None, [float("nan"), 0.0], [None, 1.0], [0.0, 0.0], [-0.0, 0.0], [float("inf"), 0.0]]
    assert density_labels(spark, points, 0.5, 2, 2) == [-1, -1, -1, 0, 0, -1]
    assert density_labels(spark, [], 0.5, 2, 2) == []


def test_grid_needs_few_dimensions(blobs):
    with pytest.raises(ValueError):
        clusters.grid_cells(blobs, "v", 0.5, 9)


def test_kmeans_assigns_blobs(blobs):
    rows = blobs.filter("label >= 0")
    model = clusters.kmeans(rows, "v", 3, seeds=[1, 2])
    found = clusters.assign(rows, model, "v")
    pairs = Counter((r["label"], r["cluster"]) for r in found.collect())
    assert len({c for _, c in pairs}) == 3 and len(pairs) == 3


def test_sweeps(blobs):
    rows = blobs.filter("label >= 0")
    scores = {r["k"]: r for r in clusters.silhouette_sweep(rows, "v", [2, 3, 4], [1]).collect()}
    assert [k for k in scores if scores[k]["best"]] == [3]
    inertia = [r["inertia"] for r in clusters.elbow_sweep(rows, "v", [1, 2, 3], [1, 2]).orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)
    points = np.array([r["v"] for r in rows.collect()])
    assert inertia[0] == pytest.approx(((points - points.mean(axis=0)) ** 2).sum())


def test_pca_is_centred(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(300, 5)) * [5, 3, 1, 0.5, 0.1] + 7
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(data)], "id long, v array<double>")
    projection = clusters.pca(df, "v", 2)
    found = np.array([r["components"] for r in projection.transform(df, "v").orderBy("id").collect()])
    assert np.abs(found.mean(axis=0)).max() < 1e-9
    centred = data - data.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(found) == pytest.approx(np.abs(centred @ axes[:2].T), abs=1e-8)
    assert sum(projection.explained_variance) <= 1.0


def test_components_of_a_chain_a_star_and_a_lone_node(spark):
    edges = [(f"a{i:03d}", f"a{i + 1:03d}") for i in range(150)]
    edges += [("hub", f"s{i:03d}") for i in range(150)]
    nodes = sorted({n for e in edges for n in e} | {"lone"})
    found = components.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node string"),
        spark.createDataFrame(edges, "src string, dst string"),
    )
    sizes = {r["component"]: r["count"] for r in found.groupBy("component").count().collect()}
    assert sizes == {"a000": 151, "hub": 151, "lone": 1}


DOCS = [
    (1, 0, "red red blue"), (2, 0, "red blue green"), (3, 1, "green green"), (4, 1, "blue sky sky"), (5, 2, "sky"),
    (6, 2, "red blue red blue"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "id long, topic long, text string")
    return df.withColumn("words", F.split("text", " ")).persist()


def grams(text, low, high):
    words = text.split()
    return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("low, high, top, least, most", [
    (1, 1, None, 1, 1.0), (1, 3, 5, 1, 1.0), (1, 2, 4, 2, 0.6), (2, 3, 3, 1, 1.0), (1, 3, 4, 2, 1.0), (1, 3, 50, 1, 1.0),
    (2, 3, 50, 2, 1.0), (1, 2, 2, 1, 2),
])
@pytest.mark.parametrize("listed", [5_000, 2])
def test_vocabulary(docs, low, high, top, least, most, listed, monkeypatch):
    monkeypatch.setattr(vectors, "MAX_LISTED_TERMS", listed)
    frequency, documents = Counter(), Counter()
    for _, _, text in DOCS:
        frequency.update(grams(text, low, high))
        documents.update(set(grams(text, low, high)))
    highest = most if isinstance(most, int) else most * len(DOCS)
    kept = [t for t in frequency if least <= documents[t] <= highest]
    kept = sorted(kept, key=lambda t: (-frequency[t], t))[:top]
    found = vectors.vocabulary(docs, "words", (low, high), top, least, most).collect()
    assert {r["term"]: (r["df"], r["frequency"]) for r in found} == {t: (documents[t], frequency[t]) for t in kept}


def test_tfidf_in_rows_equals_the_join(docs):
    vocab = vectors.vocabulary(docs, "words", (1, 2), 6)
    listed = {(r["id"], r["term"]): r["weight"] for r in vectors.tfidf(docs, "id", "words", vocab, (1, 2), 6).collect()}
    joined = {(r["id"], r["term"]): r["weight"] for r in vectors.tfidf(docs, "id", "words", vocab, (1, 2)).collect()}
    assert listed.keys() == joined.keys()
    assert all(listed[k] == pytest.approx(joined[k]) for k in joined)
    by_doc = Counter()
    for (key, _), weight in joined.items():
        by_doc[key] += weight * weight
    assert all(total == pytest.approx(1.0) for total in by_doc.values())


def test_topic_counts_in_rows_equal_the_explode(docs):
    terms = ["blue", "green", "red", "red blue", "sky"]
    listed = {(r["topic"], r["term"]): r["n"] for r in topics.term_counts(docs, "topic", "words", terms, (1, 2)).collect()}
    every = {(r["topic"], r["term"]): r["n"] for r in topics.term_counts(docs, "topic", "words", None, (1, 2)).collect()}
    assert listed == {k: n for k, n in every.items() if k[1] in terms}


def test_ctfidf(docs):
    counts = topics.term_counts(docs, "topic", "words")
    found = {(r["topic"], r["term"]): r["weight"] for r in topics.ctfidf(counts).collect()}
    per_topic, uses = {t: Counter() for t in (0, 1, 2)}, Counter()
    for _, topic, text in DOCS:
        per_topic[topic].update(text.split())
        uses.update(text.split())
    mean = sum(uses.values()) / 3
    for topic, words in per_topic.items():
        for word, n in words.items():
            assert found[topic, word] == pytest.approx(n / sum(words.values()) * math.log(1 + mean / uses[word]))


def test_many_topics_and_terms(spark):
    counts = spark.range(501).selectExpr("id AS topic", "concat('t', id % 7) AS term", "id + 1 AS n")
    assert topics.ctfidf(counts).count() == 501
    vocab = spark.range(5_001).selectExpr("concat('t', id) AS term", "1L AS df")
    assert len(vectors.vocabulary_rows(vocab, 6_000)) == 5_001


def test_names(docs):
    top = topics.keywords(topics.ctfidf(topics.term_counts(docs, "topic", "words")), 10)
    found = {r["topic"]: r["topic_name"] for r in topics.names(top, 2).collect()}
    assert found[2].startswith("2_") and len(found) == 3


def test_merge_smallest_into_nearest(spark):
    rows = [(0, "a b c"), (0, "a b"), (0, "a c"), (1, "a b"), (2, "x y z"), (2, "x y"), (-1, "q q q")]
    df = spark.createDataFrame([(i, t, text.split()) for i, (t, text) in enumerate(rows)], "id long, topic long, words array<string>")
    counts = topics.term_counts(df, "topic", "words")
    sizes = df.groupBy("topic").agg(F.count("*").alias("size"))
    merges = topics.merge_order(counts, sizes, 2)
    assert [(a, b) for a, b, _ in merges] == [(1, 0)]
    reduced = {r["topic"]: r["count"] for r in topics.reduce_topics(df, "topic", counts, 2).groupBy("topic").count().collect()}
    assert reduced == {0: 4, 2: 2, -1: 1}
    assert topics.hierarchy(df, counts, sizes).count() == 2


def test_nearest_centre(spark):
    df = spark.createDataFrame([(1, [0.0, 0.1]), (2, [5.0, 5.0]), (3, [0.5, 0.5])], "id long, v array<double>")
    centres = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 1.0])], "topic long, centre array<double>")
    found = {r["id"]: r["topic"] for r in clusters.nearest(df, "v", centres, 2.0).collect()}
    assert found == {1: 0, 2: -1, 3: 0}
    assert clusters.nearest(df, "v", centres).filter("id = 2").first()["topic"] == 1


def test_topic_model_round_trip(blobs, tmp_path):
    rows = blobs.withColumn("words", F.array(F.concat(F.lit("word"), F.col("label").cast("string")), F.lit("shared")))
    model, placed = topic_model.fit(
        rows, "id", "v", "words", components=2, reach=0.6, min_samples=10, min_cluster_size=50, radius=3.0
    )
    names = {r["topic"]: r["topic_name"] for r in placed.select("topic", "topic_name").distinct().collect()}
    assert names[-1] == "Outlier" and names[0].startswith("0_")
    topic_model.save(model, str(tmp_path / "m"))
    loaded = topic_model.load(rows.sparkSession, str(tmp_path / "m"))
    first = {r["id"]: r["topic"] for r in model.predict(rows, "v").collect()}
    second = {r["id"]: r["topic"] for r in loaded.predict(rows, "v").collect()}
    assert first == second
    agreement = sum(first[r["id"]] == r["topic"] for r in placed.collect())
    assert agreement >= 0.95 * len(first)


def test_lda(docs):
    terms = ["blue", "green", "red", "sky"]
    counted = vectors.count_vectors(docs, "words", terms)
    model = topics.lda(counted, "counts", 2, max_iter=5)
    placed = topics.lda_topics(counted, model).collect()
    assert len(placed) == len(DOCS)
    assert all(r["topic"] in (0, 1) and 0.5 <= r["confidence"] <= 1.0 for r in placed)
    words = topics.lda_top_words(model, terms, 3).collect()
    assert len(words) == 6 and {r["term"] for r in words} <= set(terms)
    assert topics.lda_perplexity(model, counted) > 1


def test_review_topics_round_trip(spark, tmp_path):
    rows = [(i, "lovely castle story narrative ghost" if i % 2 else "crash stutter driver graphics engine") for i in range(40)]
    df = spark.createDataFrame([*rows, (99, "too short")], "id long, text string")
    model = review_topics.fit(df, "text", 2, ["lovely"], min_df=2, max_df=0.9)
    assert "lovely" not in model.terms and "crash" not in model.terms and "castle story" in model.terms
    placed = {r["id"]: r["topic"] for r in model.place(df, "text").collect()}
    assert 99 not in placed and len(set(placed.values())) == 2
    assert len({topic for i, topic in placed.items() if i % 2}) == 1
    assert model.perplexity(df, "text") > 1 and model.top_words(3).count() == 6
    review_topics.save(spark, model, str(tmp_path / "m"))
    loaded = review_topics.load(spark, str(tmp_path / "m"))
    assert {r["id"]: r["topic"] for r in loaded.place(df, "text").collect()} == placed


def test_sentiment_model(spark, tmp_path):
    rows = [(i, "great fun love it" if i % 3 else "awful boring waste", int(i % 3 > 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, text string, label int")
    run = review_analysis.run_sentiment(df, "text", "label", "id", str(tmp_path / "split"))
    accuracy = run.metrics.filter("name = 'accuracy'").first()
    assert accuracy["f1"] == 1.0 and accuracy["support"] == 18
    sentiment.save(run.model, str(tmp_path / "model"))
    check = sentiment.reload_mismatches(df, "id", run.model, sentiment.load(str(tmp_path / "model"))).first()
    assert (check["rows"], check["mismatches"]) == (90, 0)


def test_training_needs_both_classes(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "text string, label int")
    with pytest.raises(ValueError):
        sentiment.train(df, "text", "label")


def test_aspect_scores(spark):
    df = spark.createDataFrame(
        [(1, "The story and the plot"), (2, "  "), (3, None), (4, "Crash crash; price")], "id long, text string"
    )
    found = {r["id"]: r for r in aspects.score(df, "text").collect()}
    story, bugs = aspects.score_column("Story & Narrative"), aspects.score_column("Stability & Bugs")
    assert found[1][story] == pytest.approx(1.8 / 2.8) and found[1][bugs] == 0.0
    assert found[2][story] is None and found[3][story] is None
    assert found[4][bugs] == pytest.approx(2 / 3)
    best = {r["id"]: r["best_topic"] for r in aspects.best_aspect(aspects.score(df, "text"), aspects.ASPECT_LABELS).collect()}
    assert best == {1: "Story & Narrative", 4: "Stability & Bugs"}
    lexicon = spark.createDataFrame(
        [(label, term, w) for label, terms in aspects.GAME_LEXICON.items() for term, w in terms.items()],
        "label string, term string, weight double",
    )
    table = aspects.score_with_table(df, "id", "text", lexicon, aspects.ASPECT_LABELS)
    for row in table.collect():
        for label in aspects.ASPECT_LABELS:
            want = found[row["id"]][aspects.score_column(label)]
            got = row[aspects.score_column(label)]
            assert got == want or got == pytest.approx(want)


def test_product_clusters(spark):
    rows = [(i, "pet food", f"dog {i % 2}") for i in range(20)] + [(20 + i, "batteries", "cell power") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, category string, product string")
    found = review_analysis.cluster_products(df, "category", "product", 2).collect()
    pairs = {(r["category"], r["meta_category"]) for r in found}
    assert len(found) == 40 and len(pairs) == 2


def test_lda_counts_are_made_once(spark):
    rows, terms = queries_of_models.lda_counts(spark, SMALL)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert terms and rows.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    # What reads the counts reads no text.
    assert "parquet" not in plan and "text" not in plan

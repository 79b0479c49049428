"""Rows for several passes are stored, not held in memory."""

from __future__ import annotations

from glob import glob
from hashlib import sha256

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from reviewlake import session
from reviewlake.operators import topics
from reviewlake.plans import review_topics
from reviewlake.workload import models

SMALL = "/root/testdata/sf0.001"


def test_stored_rows_lie_in_small_groups(spark, monkeypatch):
    monkeypatch.setattr(session, "ROW_GROUP", 1 << 20)
    rows = [(i, [sha256(b"%d %d" % (i, j)).hexdigest() for j in range(80)]) for i in range(1000)] + [(1000, None), (1001, [])]
    df = spark.createDataFrame(rows, "id long, words array<string>").coalesce(1)
    kept = session.stored(df)
    assert kept.schema == df.schema and sorted(map(tuple, kept.collect())) == sorted(rows)
    (path,) = {name.removeprefix("file://") for name in kept.inputFiles()}
    groups = pq.ParquetFile(glob(path)[0]).metadata
    assert groups.num_row_groups > 2


def test_topic_models_hold_no_table(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("a table is held in memory")

    for name in ("persist", "cache"):
        monkeypatch.setattr(type(spark.range(0)), name, refused)
    rows, terms = models.lda_counts(spark, SMALL)
    model = topics.lda(rows, "counts", 2, max_iter=1)
    assert topics.lda_top_words(model, terms, 3).count() == 6
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.col("text"))
    fitted = review_topics.fit(texts, "text", 2, ["the"], min_df=2)
    assert fitted.place(texts, "text").count() == texts.filter("length(text) >= 20").count()

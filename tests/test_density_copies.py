"""Copies of a vector are rows of their own in what is found for rows."""

from __future__ import annotations

import duckdb
import numpy as np

from reviewlake import workload


def test_every_copy_has_its_count(spark, tmp_path):
    known = workload.load()
    v = np.random.default_rng(3).normal(0, 0.13, (60, 64)).round(3)
    listed = [(i, v[i % 60 if i < 150 else 0].tolist()) for i in range(240)] + [(300, None), (301, [float("nan")] * 64)]
    df = spark.createDataFrame(listed, "vec_id long, embedding array<float>")
    df.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = {(r["vec_id"], r["nearby"]) for r in known.QUERIES["clu8_neighbour_counts"](spark, str(tmp_path)).collect()}
    with duckdb.connect() as base:
        base.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet' WHERE vec_id < 300")
        wanted = set(base.execute(known.ORACLE["clu8_neighbour_counts"]).fetchall())
    assert len(wanted) == 240 and found == wanted

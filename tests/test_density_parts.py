"""Density clustering in parts of groups: a task's share does not grow with the number of points."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from reviewlake.operators import density


def test_a_group_meets_others_in_parts(spark, monkeypatch):
    monkeypatch.setattr(density, "BLOCK_POINTS", 32)
    monkeypatch.setattr(density, "PART_PAIRS", 4)
    v = np.random.default_rng(4).normal(0, 1, (300, 3)).round(2)
    v = np.unique(v, axis=0)
    assert len(v) == 300
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "id long, v array<double>")
    near = ((v[:, None] - v[None]) ** 2).sum(-1) <= 0.25
    placed = density.with_blocks(density.distinct_points(df, "id", "v"), 20.0, 2).persist()
    met = density._met(placed.withColumn("core", F.lit(False)), 2)
    assert met.filter("NOT own").groupBy("grp", "part").count().agg(F.max("count")).first()[0] <= 4
    assert met.select("grp", "part").distinct().count() > met.select("grp").distinct().count()
    wanted = {i: int(n) for i, n in enumerate(near.sum(1))}
    assert wanted == {r["node"]: r["nearby"] for r in density.neighbour_counts(placed, 0.5, 2).collect()}
    core = near.sum(1) >= 5
    dense = F.array_contains(F.lit(np.flatnonzero(core).tolist()), F.col("node").cast("int"))
    links = density._links(placed.withColumn("core", dense), 0.5, 2).collect()
    labels = density._hooked(np.arange(300), *np.array([(r["src"], r["dst"]) for r in links if r["inner"]]).T)
    joined = near & core[None] & core[:, None]
    assert (labels[core] == density._hooked(np.arange(300), *np.nonzero(joined))[core]).all()
    border = sorted((r["src"], r["dst"]) for r in links if not r["inner"])
    assert border == sorted(zip(*(x.tolist() for x in np.nonzero(near & core[None] & ~core[:, None]))))

"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.session import cut_lineage

SALTS = 16


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node id reachable over undirected edges (src, dst).

    Each round every node takes the smallest label among itself and its neighbours, then the label of
    that label, which halves long chains, until nothing changes. Rounds are checkpointed.
    """
    both = cut_lineage(
        edges.select("src", "dst")
        .unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )
    labels = cut_lineage(nodes.select("node", F.col("node").alias("component")).distinct())
    while True:
        seen = both.join(
            labels.select(F.col("node").alias("dst"), F.col("component").alias("_near")), "dst"
        ).groupBy(F.col("src").alias("node")).agg(F.min("_near").alias("_near"))
        hooked = labels.join(seen, "node", "left").select(
            "node",
            F.col("component").alias("_old"),
            F.least("component", F.coalesce("_near", "component")).alias("_new"),
        )
        # Labels of labels. A label may hold a third of all nodes, so its followers are salted.
        salted = hooked.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
        wanted = salted.select(F.col("_new").alias("node"), "_salt").distinct()
        jumped = wanted.join(hooked.select("node", F.col("_new").alias("_jump")), "node").select(
            F.col("node").alias("_new"), "_salt", "_jump"
        )
        following = cut_lineage(
            salted.join(jumped, ["_new", "_salt"]).select(
                "node", "_old", F.least("_new", "_jump").alias("component")
            )
        )
        changed = following.filter(F.col("_old") != F.col("component")).limit(1).count()
        labels = following.select("node", "component")
        if not changed:
            return labels

"""Clashing column names in what changes documents, several vectors with one id, a ledger two runs wrote to."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import secrets, toxicity, va_search
from reviewlake.llm.common import free_names
from tests.llm.test_operators import ROWS, docs  # noqa: F401

CLASHES = ("blob", "_blob", "spans", "_spans", "state", "_state", "toxic", "_toxic", "score", "path", "a.b")


def _clashing(docs):
    return docs.withColumns({name: F.concat(F.lit(f"{name}:"), F.col("source")) for name in CLASHES})


def _others(rows) -> list[tuple]:
    return sorted((str(row["doc_id"]), *[row[name] for name in CLASHES]) for row in rows)


def test_redaction_leaves_columns_of_any_name(docs):
    table = _clashing(docs)
    found = secrets.redact(table)
    assert found.columns == table.columns
    rows = found.collect()
    assert _others(rows) == _others(table.collect())
    plain = {row["doc_id"]: row["text"] for row in secrets.redact(docs).collect()}
    assert {row["doc_id"]: row["text"] for row in rows} == plain


def test_toxic_rows_go_whatever_columns_there_are(spark):
    rng = random.Random(2)
    texts = []
    for i in range(300):
        words = [rng.choice(("stone", "river", "grass", "moon", "wind")) for _ in range(rng.randrange(20, 40))]
        texts.append((i, " ".join(words + ["grubby", "vile"] * (i % 5 == 0)), "s"))
    table = _clashing(spark.createDataFrame(texts, "doc_id long, text string, source string"))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int")
    kept = toxicity.keep_clean(table, labels)
    assert kept.columns == table.columns
    rows = kept.collect()
    assert all(row["doc_id"] % 5 for row in rows) and len(rows) >= 230
    assert _others(rows) == _others(table.filter(F.col("doc_id").isin([row["doc_id"] for row in rows])).collect())
    assert toxicity.keep_clean(table, labels.limit(0)).count() == 300


def test_all_labels_are_learnt_in_a_pipeline(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: seen.append(labels.count()) or [])
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    table = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    toxicity.keep_clean(table, labels)
    toxicity.scored(table, labels)
    assert seen[0] == 30 > seen[1]


def test_free_names(docs):
    table = docs.withColumns({"x": F.lit(1), "_X": F.lit(1)})
    assert free_names(table, "x", "y", "x") == ["__x", "y", "___x"]


def test_a_ledger_that_holds_a_scan_twice(spark, tmp_path):
    versions = spark.createDataFrame([(1, 0, "password=hunter22x")], "path long, version int, text string")
    ledger = str(tmp_path / "ledger")
    first = secrets.scan(versions, ledger).collect()
    twice = spark.read.parquet(ledger)
    rows = twice.collect()
    spark.createDataFrame(rows, twice.schema).write.mode("append").parquet(ledger)
    assert secrets.scan(versions, ledger).collect() == first


def _best(rows, k: int) -> dict[int, list[tuple[int, int]]]:
    out = {}
    for query in {i for i, _ in rows if i % 50 == 0}:
        scores = [
            (-int(np.dot(a, b)), j) for i, a in rows if i == query for j, b in rows if j != query
        ]
        out[query] = [(j, -score) for score, j in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("block", [2, 3, 4096])
def test_one_id_with_several_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(va_search, "BLOCK", block)
    rng = random.Random(5)
    ids = [50] * 6 + list(range(1, 9)) + [100, 100, 3, 3]
    rows = [(i, [rng.randrange(-300, 300) for _ in range(5)]) for i in ids]
    rows[0] = (50, [900, 900, 900, 900, 900])  # its own vectors score far above all others
    rows[1] = (50, [901, 900, 900, 900, 900])
    table = spark.createDataFrame([(i, [x / 256 for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    found: dict[int, list] = {}
    for row in sorted(va_search.top_k(table, "vec_id % 50 = 0").collect()):
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    assert found == _best(rows, 5)

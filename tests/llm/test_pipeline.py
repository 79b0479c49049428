"""The pipeline stage by stage on planted documents, with columns whose names its own ones could clash with."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

CLEAN = "stone river grass moon wind amber cedar lantern harbour meadow violet copper saddle thunder orchard marble".split()
SECRET = "password=hunter22xyz"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)

    def words(n: int) -> list[str]:
        return [rng.choice(CLEAN) + str(rng.randrange(900)) for _ in range(n)]

    passage = " ".join(words(70))
    texts = [" ".join(words(rng.randrange(30, 120))) for _ in range(240)]
    for i in range(0, 240, 6):
        texts[i] += " grubby vile rotten"
    texts[1] += f" {SECRET} and more"
    texts[7] = f"{texts[7]} {passage}"
    texts[8] = f"{passage} {texts[8]}"
    texts[21] = texts[20] + "."
    texts[22] = texts[20]
    texts += [None, "", "x"]
    path = tmp_path_factory.mktemp("sf")
    rows = [(i, t, "en", "src", None if t is None else len(t), "s", "t", "b", 7) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _spans string, _state string, blob string, toxic int"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i % 6 == 0)) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), texts, passage


def test_every_stage(spark, folder):
    path, texts, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, path)
        if name != "packing":
            assert found.columns == docs.columns, name
            found = spark.createDataFrame(found.collect(), docs.schema)
            assert {tuple(row)[5:] for row in found.collect()} <= {("s", "t", "b", 7)}, name
            docs = found
        kept[name] = {row["doc_id"]: row for row in found.collect()} if name != "packing" else found.collect()
    toxic = {i for i in range(0, 240, 6)}
    gone = set(range(len(texts))) - kept["toxicity"].keys()
    assert len(toxic & gone) >= 0.9 * len(toxic) and len(gone - toxic) <= 12
    near = kept["near_duplicates"]
    assert sum(i in near for i in (20, 21, 22)) <= 1
    repeats = kept["repeats"]
    if 7 in repeats and 8 in repeats:
        assert passage in repeats[7]["text"] and passage[60:-60] not in repeats[8]["text"]
    secrets = kept["secrets"]
    assert not any(SECRET in (row["text"] or "") for row in secrets.values())
    assert all(row["n_chars"] is None or row["n_chars"] == len(row["text"] or "") for row in secrets.values())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths, sums = Counter(), {}
    for row in kept["packing"]:
        lengths[row["doc_id"]] += row["length"]
        sums[row["doc_id"], row["piece"]] = row["ids_crc32"]
    assert lengths.keys() == secrets.keys()
    for i, row in secrets.items():
        ids = np.array([*library.encode(row["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        assert lengths[i] == len(ids)
        if len(ids) <= 2048:
            assert sums[i, 0] == zlib.crc32(ids.tobytes())


def test_run_goes_through_all_stages(spark, folder):
    path, _, _ = folder
    rows = corpus_pipeline.run(spark, path).collect()
    used: dict[int, list] = {}
    for row in rows:
        used.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for held in used.values():
        held.sort()
        assert [a for a, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= 2048

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from reviewlake.operators.ranks import top_n
from reviewlake.plans import summaries
from reviewlake.session import checkpoint_dir
from reviewlake.sinks import files, keyed
from reviewlake.sources import delimited, html_rows, review_pages, tables
from reviewlake.streaming import ingest


def entry(number, author, **more):
    return {
        "recommendationid": str(number),
        "author": {
            "steamid": author, "num_reviews": number, "num_games_owned": 2,
            "playtime_at_review": 30, "playtime_forever": 60,
        },
        "review": f"text {number}\nsecond line",
        "timestamp_created": "1700000000",
        "voted_up": True,
        "votes_up": 1,
        "votes_funny": 0,
        "weighted_vote_score": "0.52",
        "steam_purchase": True,
        "received_for_free": False,
        **more,
    }


def write_page(folder, app, page, reviews, bom=False):
    target = folder / f"appid={app}"
    target.mkdir(parents=True, exist_ok=True)
    text = json.dumps({"cursor": "*", "reviews": reviews}, indent=1)
    (target / f"{page}.json").write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())


def pages(folder):
    write_page(folder, 10, 1, [entry(1, "700", comment_count=4), entry(2, "701")])
    write_page(folder, 10, 2, [entry(3, "700")], bom=True)
    write_page(folder, 20, 1, [])
    write_page(folder, 30, 1, [entry(4, "700", review=None)])


def test_review_pages(spark, tmp_path):
    pages(tmp_path / "in")
    rows = review_pages.entries(review_pages.read_pages(spark, str(tmp_path / "in")))
    reviews = {r["recommendationid"]: r for r in review_pages.review_rows(rows).collect()}
    assert sorted(reviews) == [1, 2, 3, 4]
    assert reviews[1]["comment_count"] == 4 and reviews[2]["comment_count"] == 0
    assert reviews[3]["appid"] == 10 and reviews[4]["review"] is None
    assert str(reviews[1]["review_date"]) == "2023-11-14"
    assert reviews[1]["voted_up"] == 1 and reviews[1]["weighted_vote_score"] == 0.52
    players = {r["author_id"]: r["num_reviews"] for r in review_pages.player_rows(rows).collect()}
    assert players == {700: 1, 701: 2}


def test_cap_keeps_page_order(spark, tmp_path):
    pages(tmp_path / "in")
    rows = review_pages.entries(review_pages.read_pages(spark, str(tmp_path / "in")))
    kept = review_pages.review_rows(review_pages.cap_per_app(rows, 2)).collect()
    assert sorted(r["recommendationid"] for r in kept) == [1, 2, 4]


def test_ingest_pages_twice_adds_nothing(spark, tmp_path):
    pages(tmp_path / "in")
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run(checkpoint):
        ingest.ingest_pages(spark, str(tmp_path / "in"), target, checkpoint).awaitTermination()
        return (
            spark.read.parquet(f"{target}/reviews").count(),
            spark.read.parquet(f"{target}/players").count(),
        )

    assert run(progress) == (4, 2)
    assert run(progress) == (4, 2)
    # A lost checkpoint replays every file; the keys keep the tables as they are.
    assert run(str(tmp_path / "progress2")) == (4, 2)
    write_page(tmp_path / "in", 20, 2, [entry(5, "702"), entry(1, "700")])
    assert run(progress) == (5, 3)


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_cap_holds_over_batches(spark, tmp_path, files_per_batch):
    for page in range(1, 4):
        # Each page repeats the last review of the one before it.
        write_page(tmp_path / "in", 10, page, [entry(2 * page + i, str(700 + page)) for i in range(3)])
        at = 1_700_000_000 + page
        os.utime(tmp_path / "in" / "appid=10" / f"{page}.json", (at, at))
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    ingest.ingest_pages(spark, str(tmp_path / "in"), target, progress, files_per_batch, cap=4).awaitTermination()
    found = spark.read.parquet(f"{target}/reviews").collect()
    assert sorted(r["recommendationid"] for r in found) == [2, 3, 4, 5]


GAMES = """<html><table><tbody>
<tr class="app" data-appid="570"><td>1</td><td></td><td><a href="/x">Left &amp; <b>Right</b></a></td><td></td>
<td data-sort="1999">$19.99</td><td data-sort="88,5">88</td><td data-sort="1700000000">x</td><td data-sort="1234">1</td></tr>
<tr data-appid="571"><td>2</td><td></td><td><a href="/y">Free</a></td><td></td>
<td data-sort="-1"></td><td data-sort="n/a"></td><td data-sort="0"></td><td data-sort="5"></td></tr>
<tr data-appid="570"><td>3</td><td></td><td><a>Again</a></td><td></td>
<td data-sort="1"></td><td data-sort="1"></td><td data-sort="1"></td><td data-sort="1"></td></tr>
</tbody></table><table><tbody><tr data-appid="9"><td></td></tr></tbody></table></html>"""


def test_game_rows(spark, tmp_path):
    (tmp_path / "list.html").write_text(GAMES)
    found = {r["appid"]: r for r in html_rows.game_rows(html_rows.read_documents(spark, str(tmp_path))).collect()}
    assert sorted(found) == [570, 571]
    first = found[570]
    assert (first["title"], first["price"], first["rating"], first["followers"]) == ("Left & Right", 19.99, 88.5, 1234)
    assert str(first["release_date"]) == "2023-11-14"
    second = found[571]
    assert (second["price"], second["rating"], second["release_date"], second["followers"]) == (None, None, None, 5)


def test_delimited_round_trip(spark, tmp_path):
    rows = [(1, 'a;b "quoted"\nnext line'), (2, " padded "), (3, "x,y"), (4, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    files.write_delimited(df, str(tmp_path / "out"), ";")
    found = delimited.read_delimited(spark, str(tmp_path / "out"), df.schema, ";").orderBy("id").collect()
    assert [tuple(r) for r in found] == rows


def test_insert_or_ignore(spark, tmp_path):
    path = str(tmp_path / "t")

    def insert(rows):
        batch = spark.createDataFrame(rows, "k long, at long, v string")
        keyed.insert_or_ignore(batch, path, "k", ["at"])
        return sorted(tuple(r) for r in spark.read.parquet(path).collect())

    first = insert([(1, 2, "late"), (1, 1, "early"), (2, 1, "b")])
    assert first == [(1, 1, "early"), (2, 1, "b")]
    assert insert([(1, 0, "ignored"), (3, 1, "c")]) == first + [(3, 1, "c")]
    assert insert([(1, 0, "ignored"), (3, 1, "c")]) == first + [(3, 1, "c")]


def test_insert_key_only(spark, tmp_path):
    batch = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    keyed.insert_or_ignore(batch, str(tmp_path / "k"), "k", ["k"])
    assert spark.read.parquet(str(tmp_path / "k")).count() == 2


def test_update_and_delete(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, v string")
    updated = keyed.update_rows(df, F.col("v") == "a", {"v": "z", "k": F.col("k") + 10})
    assert sorted(tuple(r) for r in updated.collect()) == [(2, None), (3, "c"), (11, "z")]
    assert keyed.affected(df, F.col("v") == "a").first()[0] == 1
    assert sorted(r["k"] for r in keyed.delete_rows(df, F.col("v") == "a").collect()) == [2, 3]
    updates = spark.createDataFrame([(1, None), (9, "x")], "k long, v string")
    assert sorted(tuple(r) for r in keyed.update_from(df, updates, "k").collect()) == [(1, None), (2, None), (3, "c")]


def test_delete_duplicates_keeps_the_smallest_id(spark):
    df = spark.createDataFrame([(5, "a", None), (3, "a", None), (4, "b", None)], "id long, t string, u string")
    assert sorted(r["id"] for r in keyed.delete_duplicates(df, ["t", "u"], "id").collect()) == [3, 4]


def test_upsert_latest_wins(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "k long, v string, at long")
    new = spark.createDataFrame([(1, "c", 5), (2, "d", 4), (3, "e", 1)], "k long, v string, at long")
    found = sorted(tuple(r) for r in keyed.upsert(old, new, "k", ["at"]).collect())
    assert found == [(1, "c", 5), (2, "b", 5), (3, "e", 1)]


def test_batched_write(spark, tmp_path):
    path = tmp_path / "b"
    files.write_batched(spark.range(25).coalesce(1), str(path), 10)
    assert len(list(path.glob("*.parquet"))) == 3


def test_json_export_keeps_nulls_apart(spark, tmp_path):
    rows = spark.createDataFrame([(1, "s"), (2, None)], "appid long, summary string")
    statistics = summaries.cache_statistics(rows.withColumn("tokens", F.lit(2500).cast("long")), "appid", "tokens")
    files.export_json(rows, statistics, {"sample_limit": 50}, str(tmp_path / "e"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "e")).collect()]
    kinds = {line["kind"]: line for line in lines}
    assert len(lines) == 4 and kinds["metadata"]["estimated_cost"] == 0.01 and kinds["config"]["sample_limit"] == 50


def test_query_and_scans(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, v string")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    assert tables.scan_not_null(spark, path, "v", 1, ["id"]).first()["id"] == 1
    assert tables.scan_not_null(spark, path, "v").count() == 2
    assert tables.query(spark, "SELECT max(id) AS m FROM {t}", t=df).first()["m"] == 3
    plan = tables.scan_not_null(spark, path, "v").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(v)]" in plan and "ReadSchema: struct<id:bigint,v:string>" in plan
    pruned = tables.scan_columns(spark, path, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in pruned


def test_checkpoint_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert named.rstrip("/") in checkpoint_dir(spark)


def test_no_group_limit_is_lost(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), "id")
    assert top_n(df, ["g"], [F.col("id")], 100).count() == 10

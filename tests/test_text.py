from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import aspects, vectors, words
from reviewlake.operators.once import counted_entries


def values(spark, rows, function):
    df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "id long, text string")
    found = df.select("id", function(F.col("text")).alias("value")).orderBy("id").collect()
    return [row["value"] for row in found]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, ""),
        ("", ""),
        (" \n\t", ""),
        ("See HTTP://x.y/z now", "see now"),
        ("www.a.b c", "c"),
        ("awww.a b", "a b"),
        ("<b>Hi</b>\n<i", "hi <i"),
        ("<a\nb>c", "<a b>c"),
        ("a  b　", "a b"),
        ("x\x85<u>\x1cy", "x y"),
    ],
)
def test_clean_text(spark, text, expected):
    assert values(spark, [text], tx.clean_text) == [expected]


def test_clean_text_brackets(spark):
    def clean(c):
        return tx.clean_text(c, brackets=True)

    assert values(spark, ["[h1]Title[/h1] body", "[open", "[a\nb]"], clean) == [
        "title body", "[open", "[a b]",
    ]


def test_clean_minimal_keeps_case_and_punctuation(spark):
    assert values(spark, ["<p>Very [b]Good[/b]!  http://a.b </p>", None], tx.clean_minimal) == [
        "Very Good!", "",
    ]


def test_letters_only(spark):
    assert values(spark, ["I can't play 2 games a b c", "Ünder é x", None], tx.letters_only) == [
        "cant play games", "nder", "",
    ]


def test_words_only_keeps_other_scripts(spark):
    assert values(spark, ["Été 2024, c'est_ok! 日本 ½"], tx.words_only) == ["été cest_ok 日本 ½"]


def test_drop_metadata(spark):
    rows = [
        "Posted: 3 May\ngood",
        "12.5 hrs on record fun",
        "12.5 HRS ON RECORD fun",
        "early access review ok",
        "PRODUCT received for FREE nice",
        None,
    ]
    assert values(spark, rows, tx.drop_metadata) == ["good", "fun", "12.5 HRS ON RECORD fun", "ok", "nice", ""]


def test_drop_domain_terms(spark):
    rows = [
        "10 hrs played, not recommended, fps crash",
        "123456 hours of replaying",
        "Early Access is worth it; early  access",
        "ñplay playé play",
        None,
    ]
    assert values(spark, rows, tx.drop_domain_terms) == ["not", "hours replaying", "early access", "", ""]


def test_word_count_like_split(spark):
    rows = [None, "", "  ", "a", " a b c\n", "one two"]
    assert values(spark, rows, tx.word_count) == [len((row or "").split()) for row in rows]


def test_split_words_and_stop_words(spark):
    rows = ["the cat and the hat", " the ", ""]
    assert values(spark, rows, lambda c: tx.remove_stop_words_text(c, ["the", "and"])) == ["cat hat", "", ""]
    assert values(spark, rows, lambda c: tx.remove_stop_words_text(c, [])) == ["the cat and the hat", "the", ""]


def test_tokens_have_two_characters(spark):
    assert values(spark, ["I am à Paris_2 x"], tx.tokens) == [["am", "paris_2"]]


def test_ngrams(spark):
    def grams(low, high):
        return lambda c: tx.ngrams(tx.split_words(c), low, high)

    assert values(spark, ["a b c", "a", ""], grams(1, 3)) == [
        ["a", "b", "c", "a b", "b c", "a b c"], ["a"], [],
    ]
    assert values(spark, ["a b c", "a"], grams(2, 3)) == [["a b", "b c", "a b c"], []]
    assert values(
        spark, ["a b x b a"], lambda c: tx.ngrams(tx.only_words(tx.split_words(c), ["a", "b"]), 1, 2)
    ) == [["a", "b", "b", "a", "a b", "b a"]]


def test_stem(spark):
    rows = ["glasses", "ponies", "cats", "grass", "playing", "played", "ring", "ed", "is"]
    assert values(spark, rows, tx.stem) == [
        "glass", "poni", "cat", "grass", "play", "play", "ring", "ed", "is",
    ]


def test_shorten_segment_estimate(spark):
    assert values(spark, ["abcdef"], lambda c: tx.shorten(c, 3, "...")) == ["abc..."]
    assert values(spark, ["score_Price & Value", "plain"], tx.last_segment) == ["Price & Value", "plain"]
    assert values(spark, ["12345678", "abc"], tx.token_estimate) == [2, 0]


def test_sections(spark):
    rows = ["HIGHLIGHTS pain points verdict", "verdict only", None]
    assert values(spark, rows, tx.has_sections) == [True, False, False]
    assert values(spark, rows[:2], tx.missing_sections) == ["", "Highlights, Pain Points"]


def test_english_stop_words(spark):
    listed = tx.english_stop_words(tx.SHOP_STOP_WORDS)
    assert "the" in listed and "amazon" in listed and len(listed) > 100


@pytest.fixture(params=["10m", "-1"])
def broadcasts(spark, request):
    """Spark with and without broadcasts of its own choice."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_base_forms_keep_order(spark, broadcasts):
    docs = spark.createDataFrame([(1, ["cats", "run", "cats"]), (2, [])], "id long, words array<string>")
    forms = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "word string, base string")
    found = words.apply_base_forms(docs, "id", "words", forms).orderBy("id").collect()
    assert [row["base_text"] for row in found] == ["cat run cat", ""]


def test_preprocess_with_forms(spark):
    docs = spark.createDataFrame([(1, "The 3 Cats ran")], "id long, review string")
    forms = spark.createDataFrame([("cats", "cat"), ("ran", "run")], "word string, base string")
    found = words.preprocess(docs, "id", "review", ["the"], forms).first()
    assert found["clean_review"] == "cat run"


def test_base_forms_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(words, "CHUNK_ROWS", 3)
    rows = [(i, ["the"] * (i % 4) + [f"w{i % 7}", None, f"w{i}"], 2**60 + i) for i in range(40)] + [(40, [], None), (41, None, 1)]
    docs = spark.createDataFrame(rows, "id long, words array<string>, other long")
    forms = spark.createDataFrame([("the", "a"), ("w3", "x"), ("w30", "y"), ("w5", "w5"), ("unseen", "z")], "word string, base string")
    table = {"the": "a", "w3": "x", "w30": "y"}
    wanted = [(i, ws, other, " ".join(table.get(w, w) for w in ws or [] if w is not None)) for i, ws, other in rows]
    found = words.apply_base_forms(docs, "id", "words", forms)
    assert [tuple(row) for row in found.orderBy("id").collect()] == wanted
    # No row per use or per document of a word: texts are moved whole.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "CoGroup" in plan


def test_entries_are_counted_in_their_row(spark):
    rows = [(1, ["b", "a", None, "b", "b"]), (2, []), (3, None), (4, [None]), (5, ["x"]), (6, ["y", "y"])]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    found = df.select("id", F.inline(counted_entries(F.col("words"))))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(1, "a", 1), (1, "b", 3), (5, "x", 1), (6, "y", 2)]


def test_no_task_keeps_all_words_of_its_rows(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"])], "id long, words array<string>")
    weights = vectors.tfidf(df, "id", "words", vectors.vocabulary(df, "words"))
    lexicon = spark.createDataFrame([("L", "aa", 1.0), ("L", "bb", 0.5)], "label string, term string, weight double")
    texts = spark.createDataFrame([(1, "aa bb aa"), (2, "cc"), (3, " ")], "id long, text string")
    scores = aspects.score_with_table(texts, "id", "text", lexicon, ["L"])
    assert sorted(tuple(r) for r in scores.collect()) == [(1, 2.5 / 3.5), (2, 0.0), (3, None)]
    for found in (weights, scores):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        grouped = [line for line in plan.splitlines() if "Aggregate [id" in line]
        assert not any("term" in line.split("]")[0] for line in grouped)

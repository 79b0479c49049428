"""The stemmer against a plain version that works on patterns of the whole word, and against published pairs."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.functions.porter import IRREGULAR, porter_stem
from reviewlake.operators import words
from tests.conftest import SMALL

PAIRS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
    "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "digitizer": "digit", "conformabli": "conform", "radicalli": "radic",
    "differentli": "differ", "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "dying": "die", "spied": "spi", "died": "die", "enjoy": "enjoy", "geology": "geolog", "a": "a", "is": "is",
}


def _plain(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR or len(word) <= 2:
        return IRREGULAR.get(word, word)

    def shape(stem: str) -> str:
        out = []
        for i, letter in enumerate(stem):
            vowel = letter in "aeiou" or (letter == "y" and i > 0 and out[i - 1] == "c")
            out.append("v" if vowel else "c")
        return "".join(out)

    def m(stem: str) -> int:
        return len(re.findall("v+c+", shape(stem)))

    def o(stem: str) -> bool:
        return shape(stem) == "vc" or bool(re.search("cvc$", shape(stem)) and not re.search("[wxy]$", stem))

    def swap(word: str, table: str, least: int, extra=lambda stem, end: True) -> str:
        for rule in table.split():
            end, _, by = rule.partition(">")
            if word.endswith(end):
                stem = word.removesuffix(end)
                counted = stem + "l" if end == "logi" else stem
                return stem + by if m(counted) > least and extra(stem, end) else word
        return word

    word = re.sub("^(.)ies$", r"\1ie", word) if re.fullmatch(".ies", word) else re.sub("(ss)es$|(i)es$|(s)s$|s$", lambda x: {
        "sses": "ss", "ies": "i", "ss": "ss", "s": ""}[x[0]], word)
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("eed"):
        word = word[:-1] if m(word[:-3]) else word
    else:
        cut = re.sub("(ed|ing)$", "", word)
        if cut != word and "v" in shape(cut):
            if re.search("(at|bl|iz)$", cut):
                word = cut + "e"
            elif re.search(r"(.)\1$", cut) and shape(cut)[-1] == "c":
                word = cut if cut[-1] in "lsz" else cut[:-1]
            else:
                word = cut + "e" if m(cut) == 1 and o(cut) else cut
    if word.endswith("y") and len(word) > 2 and shape(word)[-2] == "c":
        word = word[:-1] + "i"
    if word.endswith("alli") and m(word[:-4]) > 0:
        word = word[:-2]
    word = swap(word, "ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous "
                "ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble "
                "fulli>ful logi>log", 0)
    word = swap(word, "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>", 0)
    word = swap(word, "al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ion> ou> ism> ate> iti> ous> ive> ize>", 1,
                lambda stem, end: end != "ion" or stem[-1:] in ("s", "t"))
    if word.endswith("e") and (m(word[:-1]) > 1 or (m(word[:-1]) == 1 and not o(word[:-1]))):
        word = word[:-1]
    return word[:-1] if word.endswith("ll") and m(word[:-1]) > 1 else word


def test_published_pairs():
    assert {word: porter_stem(word) for word in PAIRS} == PAIRS


def test_equals_the_plain_version_on_made_words():
    rng = random.Random(3)
    ends = "ational tional enci izer bli alli entli ization ation ator iveness biliti fulli logi icate ative ical ful ness al ance "
    ends += "er able ement ion ou ate ize ed ing eed ies ied s ss sses y e ll ly yy yyy é"
    for _ in range(20000):
        word = "".join(rng.choice("aeiouybcdlmnprstvwxzé") for _ in range(rng.randrange(8)))
        word += "".join(rng.choice(ends.split()) for _ in range(rng.randrange(3)))
        assert porter_stem(word) == _plain(word), word


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", tx.tokens(F.col("text")).alias("words"))
    return {row["word"]: row["base"] for row in words.porter_table(docs, "words").collect()}


def test_every_word_of_the_documents(found):
    assert len(found) > 1000
    assert {word: base for word, base in found.items() if base != _plain(word)} == {}


def test_stems_are_put_back_in_order(spark):
    rows = [(1, "The ponies, hopping and hopping relational ponies"), (2, None), (3, ""), (4, "ponies"), (5, "xyz")]
    df = spark.createDataFrame(rows, "id long, text string")
    done = words.preprocess(df, "id", "text", ["the", "and"], porter=True)
    assert {r["id"]: r["clean_review"] for r in done.collect()} == {
        1: "poni hop hop relat poni", 2: "", 3: "", 4: "poni", 5: "xyz"
    }


def test_porter_moves_no_tokens(spark):
    df = spark.createDataFrame([(1, "The cats and running dogs"), (2, None), (3, "the the"), (4, "Running running")], "id long, text string")
    done = words.preprocess(df, "id", "text", ["the", "and"], porter=True)
    assert [row["clean_review"] for row in done.orderBy("id").collect()] == ["cat run dog", "", "", "run run"]
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()

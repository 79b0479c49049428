from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from reviewlake.functions import scalars
from reviewlake.operators import filters


def one(spark, value, function, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(function(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("12", 12.0), ("1,5", 1.5), ("2.0", 2.0), ("-1", None), ("-1.0", -1.0), ("n/a", None), (None, None),
        ("about 7 or 8", 7.0), ("-12%", -12.0), ("3.4.5", 3.4),
    ],
)
def test_parse_number(spark, text, expected):
    assert one(spark, text, scalars.parse_number) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("0", None), (" ", None), ("", None), (None, None), ("abc", None),
        ("1700000000", datetime.date(2023, 11, 14)), ("-1", datetime.date(1969, 12, 31)),
    ],
)
def test_parse_date(spark, text, expected):
    assert one(spark, text, scalars.parse_date) == expected


def test_log10_of_zero(spark):
    assert one(spark, 0.0, scalars.log10, "double") == -math.inf
    assert math.isnan(one(spark, -1.0, scalars.log10, "double"))
    assert one(spark, 1000.0, scalars.log10, "double") == pytest.approx(3.0)


def test_signed_power(spark):
    assert one(spark, -2.0, scalars.signed_power, "double") == -8.0


def test_best_column(spark):
    rows = [(1.0, 3.0, None), (None, None, None), (2.0, 2.0, 1.0), (None, -1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = [row["r"] for row in df.select(scalars.best_column(["a", "b", "c"]).alias("r")).collect()]
    assert found == ["b", None, "a", "b"]


def test_l2_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    found = [row["r"] for row in df.select(scalars.l2_normalise(F.col("v")).alias("r")).collect()]
    assert found == [[0.6, 0.8], [0.0, 0.0]]


@pytest.mark.parametrize(
    "label, expected", [("positive", 1), ("POS", None), ("bad", 0), ("1", 1), ("0", 0), (None, None)]
)
def test_normal_label(spark, label, expected):
    assert one(spark, label, filters.normal_label) == expected


def test_numeric_label(spark):
    assert one(spark, 1, filters.normal_label, "int") == 1


@pytest.mark.parametrize(
    "label, prediction", [("POSITIVE", 1), ("label_1", 1), ("1", 1), ("LABEL_0", 0), ("neg", 0), (None, 0)]
)
def test_model_prediction(spark, label, prediction):
    assert one(spark, label, filters.model_prediction) == prediction


def test_description_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "c string, n string")
    found = [r[0] for r in df.select(filters.description(F.col("c"), F.col("n"))).collect()]
    assert found == ["a b", None]

"""Number, date and score expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a number inside a text, with a point or a comma as decimal mark.
NUMBER = r"-?\p{Nd}+([.,]\p{Nd}+)?"


def parse_number(text: Column) -> Column:
    """The first number in a text as a double.

    A bare ``-1`` means "unknown" and gives null; ``-1.0`` is the number minus one.
    """
    found = F.regexp_extract(text, NUMBER, 0)
    number = F.regexp_replace(found, ",", ".").try_cast("double")
    return F.when((found == "") | (found == "-1"), None).otherwise(number)


def parse_date(text: Column) -> Column:
    """Epoch seconds in a text to a UTC date; '0', blank and unreadable values give null."""
    seconds = F.trim(text).try_cast("long")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
    return F.when(text.isin("0", " ", "") | seconds.isNull(), None).otherwise(day)


def signed_power(value: Column, power: float = 3.0) -> Column:
    """``sign(x) * |x| ** power``."""
    return F.signum(value) * F.pow(F.abs(value), F.lit(float(power)))


def log10(value: Column) -> Column:
    """Base-10 logarithm with log10(0) = -inf and a negative value giving NaN."""
    return (
        F.when(value == 0, F.lit(float("-inf")))
        .when(value < 0, F.lit(float("nan")))
        .otherwise(F.log10(value))
    )


def best_column(columns: Sequence[str]) -> Column:
    """Name of the column holding the row's largest value; the first wins a tie, nulls lose."""
    top = F.greatest(*[F.col(name) for name in columns]) if len(columns) > 1 else F.col(columns[0])
    choice = F.lit(None).cast("string")
    for name in reversed(columns):
        choice = F.when(F.col(name) == top, F.lit(name)).otherwise(choice)
    return choice


def l2_norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    )


def l2_normalise(vector: Column) -> Column:
    """The vector at unit length; the zero vector stays as it is."""
    # The norm is an element of an array, so that the inner lambda sees a value, not the aggregate.
    return F.get(
        F.transform(
            F.array(l2_norm(vector)),
            lambda norm: F.transform(
                vector, lambda x: F.when(norm == 0, x.cast("double")).otherwise(x.cast("double") / norm)
            ),
        ),
        F.lit(0),
    )


def squared_distance(left: Column, right: Column) -> Column:
    """Squared Euclidean distance of two arrays of equal length."""
    parts = F.zip_with(
        left, right, lambda a, b: (a.cast("double") - b.cast("double"))
    )
    return F.aggregate(parts, F.lit(0.0), lambda total, d: total + d * d)


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null where there is nothing to divide by."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def outlier_verdict(rate: Column) -> Column:
    """Verdict on an outlier rate given in percent."""
    return (
        F.when(rate > 50, "too many outliers")
        .when(rate > 30, "high outlier rate")
        .otherwise("ok")
    )

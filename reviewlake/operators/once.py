"""Expressions evaluated once per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose results are not recomputed by what follows.

    A filter on a computed column is pushed below the projection by substituting its expression, and
    costly regular expressions then run once for the filter and again for the output. Columns that
    come out of a generator are values: predicates on them stay above it.
    """
    kept = [name for name in df.columns if name not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value, which NaN is not, in every named column.

    Joins and explodes drop the other rows anyway. Said up front, every branch that reads the table
    has the same filters, so that Spark computes the exchange they share once.
    """
    out = df
    for name in columns:
        out = out.filter(F.col(name).isNotNull())
        # A floating NaN is a missing value too.
        if name in df.columns and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            out = out.filter(~F.isnan(name))
    return out


def counted_entries(listed: Column) -> Column:
    """The distinct entries of an array with how often they occur, as structs (term, n); entries without a value are left out.

    Counted inside the row: the array is put in order, and an entry ends where the next one begins.
    """
    ordered = F.array_sort(F.filter(listed, lambda x: x.isNotNull()))

    def runs(row: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(row) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(row, i) != F.get(row, i - 1)))
        parts = F.transform(
            F.array(F.struct(row.alias("row"), starts.alias("starts"))),
            lambda s: F.zip_with(
                s["starts"], F.concat(F.slice(s["starts"], 2, F.size(s["starts"])), F.array(F.size(s["row"]))),
                lambda a, b: F.struct(F.get(s["row"], a).alias("term"), (b - a).cast("long").alias("n")),
            ),
        )
        return F.get(parts, F.lit(0))

    # A lambda's argument is a value: the array is put in order once.
    return F.get(F.transform(F.filter(F.array(ordered), lambda row: F.size(row) > 0), runs), F.lit(0))

"""Data profiling: missing values, duplicates, text lengths, column descriptions, cleaning reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions import text as tx
from reviewlake.functions.scalars import percent
from reviewlake.operators.ranks import quantiles, top_n


def _as_rows(wide: DataFrame, columns: Sequence[str], total: str = "_total") -> DataFrame:
    """(column, count, percent) from a one-row table of counts."""
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"_c{i}").alias("count"),
            percent(F.col(f"_c{i}"), F.col(total)).alias("percent"),
        )
        for i, name in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*entries)))


def missing(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Nulls per column with their share, in one pass; columns without nulls are left out."""
    counts = [F.count_if(F.col(name).isNull()).alias(f"_c{i}") for i, name in enumerate(df.columns)]
    rows = _as_rows(df.agg(F.count(F.lit(1)).alias("_total"), *counts), df.columns)
    rows = rows.filter(F.col("count") > 0) if only_missing else rows
    return rows.orderBy(F.desc("count"), "column")


def empty_strings(df: DataFrame, only_found: bool = True) -> DataFrame:
    """Empty strings per text column with their share."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = [F.count_if(F.col(name) == "").alias(f"_c{i}") for i, name in enumerate(columns)]
    rows = _as_rows(df.agg(F.count(F.lit(1)).alias("_total"), *counts), columns)
    return rows.filter(F.col("count") > 0) if only_found else rows


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the named columns of a row: what has to be shuffled to find equal rows.

    The JSON form keeps names and values apart and leaves out nulls, so different rows have different
    texts; zero has one sign.
    """
    floating = (T.FloatType, T.DoubleType)
    values = [
        (F.col(name) + 0.0).alias(name) if isinstance(df.schema[name].dataType, floating) else F.col(name)
        for name in columns
    ]
    return F.sha2(F.to_json(F.struct(*values)), 256)


def duplicates(df: DataFrame) -> DataFrame:
    """One row: rows, rows that repeat an earlier one, and their share.

    Only digests are shuffled, and copies combine map-side.
    """
    groups = df.groupBy(row_digest(df, df.columns).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    totals = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )
    return totals.withColumn("percent", percent(F.col("duplicates"), F.col("rows")))


def with_text_sizes(df: DataFrame, text: str) -> DataFrame:
    """Adds text_length and word_count."""
    return df.withColumns(
        {"text_length": tx.char_length(F.col(text)), "word_count": tx.word_count(F.col(text))}
    )


def text_stats(df: DataFrame, text: str, short: int = 10, long: int = 5000) -> DataFrame:
    """One row of text length and word count statistics."""
    sizes = with_text_sizes(df.select(text), text).select("text_length", "word_count")
    median = quantiles(sizes, [], "text_length", [0.5]).select("q0").scalar()
    stats = sizes.agg(
        F.min("text_length").alias("min_length"),
        F.max("text_length").alias("max_length"),
        F.avg("text_length").alias("mean_length"),
        F.avg("word_count").alias("mean_words"),
        F.count_if(F.col("text_length") < short).alias("very_short"),
        F.count_if(F.col("text_length") > long).alias("very_long"),
    )
    return stats.withColumn("median_length", median)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("long")
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


DESCRIBE_STATISTICS = (
    "count", "unique", "top", "freq", "mean", "std", "min", "25%", "50%", "75%", "max",
)


def describe(df: DataFrame) -> DataFrame:
    """(column, statistic, value as text) for every number and text column.

    Numbers get count, mean, std, min, quartiles and max; texts get count, unique, top and freq (the
    most frequent value, ties by value). All columns go through one long (column, value) table, so the
    number of jobs does not grow with the number of columns.
    """
    fields = df.schema.fields
    numbers = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    parts: list[DataFrame] = []
    if numbers:
        long = _melt(df, numbers, "double")
        present = long.filter(F.col("value").isNotNull())
        simple = long.groupBy("column").agg(
            F.count("value").alias("_count"),
            F.avg("value").alias("_mean"),
            F.stddev("value").alias("_std"),
            F.min("value").alias("_min"),
            F.max("value").alias("_max"),
        )
        quarters = quantiles(present, ["column"], "value", [0.25, 0.5, 0.75])
        parts.append(
            _statistic_rows(
                # One row per column of the table.
                simple.join(F.broadcast(quarters), "column", "left"),
                {
                    "count": _number_text(F.col("_count")),
                    "mean": _number_text(F.col("_mean")),
                    "std": _number_text(F.col("_std")),
                    "min": _number_text(F.col("_min")),
                    "25%": _number_text(F.col("q0")),
                    "50%": _number_text(F.col("q1")),
                    "75%": _number_text(F.col("q2")),
                    "max": _number_text(F.col("_max")),
                },
            )
        )
    if texts:
        counts = (
            _melt(df, texts, "string")
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("_n"))
        )
        present = F.col("value").isNotNull()
        summary = counts.groupBy("column").agg(
            F.coalesce(F.sum(F.when(present, F.col("_n"))), F.lit(0)).alias("_count"),
            F.count("value").alias("_unique"),
            F.max(F.when(present, F.col("_n"))).alias("_freq"),
        )
        # The tie rule needs the value itself, so only the most frequent value per column travels.
        leading = top_n(
            counts.filter(present), ["column"], [F.desc("_n"), F.col("value")], 1, "_rank"
        ).select("column", "value")
        parts.append(
            _statistic_rows(
                # One row per column of the table.
                summary.join(F.broadcast(leading), "column", "left"),
                {
                    "count": F.col("_count").cast("string"),
                    "unique": F.col("_unique").cast("string"),
                    "top": F.col("value"),
                    "freq": F.col("_freq").cast("string"),
                },
            )
        )
    if not parts:
        raise ValueError("describe needs at least one number or text column")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _melt(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    entries = [
        F.struct(F.lit(name).alias("column"), F.col(name).cast(kind).alias("value"))
        for name in columns
    ]
    return df.select(F.inline(F.array(*entries)))


def _number_text(value: Column) -> Column:
    """Six decimals at most, as plain text."""
    return F.round(value.cast("double"), 6).cast("decimal(30,6)").cast("string")


def _statistic_rows(wide: DataFrame, statistics: dict[str, Column]) -> DataFrame:
    entries = [
        F.struct(F.lit(name).alias("statistic"), value.alias("value"))
        for name, value in statistics.items()
    ]
    return wide.select("column", F.inline(F.array(*entries)))


def cleaning_funnel(
    df: DataFrame, text: str, label: str, key: Sequence[str] | None = None, min_length: int = 10
) -> DataFrame:
    """Rows left after each cleaning step: (step, name, rows, removed, removed_pct).

    Steps: all rows, without duplicate rows, without blank text, long enough, labelled. Rows meet by
    their digest in a single aggregate; every step is a running condition on the distinct rows.
    """
    columns = list(key or df.columns)
    missing_columns = {text, label} - set(df.columns)
    if missing_columns:
        raise ValueError(f"columns not in the table: {sorted(missing_columns)}")
    distinct = (
        df.withColumns(
            {
                "_text_ok": ~tx.is_blank(F.col(text)),
                "_long_ok": F.coalesce(F.length(text) >= min_length, F.lit(False)),
                "_label_ok": F.col(label).isNotNull(),
            }
        )
        .groupBy(row_digest(df, columns).alias("_row"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.bool_or("_text_ok").alias("_text_ok"),
            F.bool_or("_long_ok").alias("_long_ok"),
            F.bool_or("_label_ok").alias("_label_ok"),
        )
    )
    text_ok, long_ok, label_ok = F.col("_text_ok"), F.col("_long_ok"), F.col("_label_ok")
    counts = distinct.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_s0"),
        F.count(F.lit(1)).alias("_s1"),
        F.count_if(text_ok).alias("_s2"),
        F.count_if(text_ok & long_ok).alias("_s3"),
        F.count_if(text_ok & long_ok & label_ok).alias("_s4"),
    )
    names = ["original", "no duplicates", "with text", "long enough", "labelled"]
    entries = []
    for i, name in enumerate(names):
        before = F.col(f"_s{max(i - 1, 0)}")
        removed = before - F.col(f"_s{i}")
        entries.append(
            F.struct(
                F.lit(i).cast("long").alias("step"),
                F.lit(name).alias("name"),
                F.col(f"_s{i}").alias("rows"),
                removed.alias("removed"),
                percent(removed, F.col("_s0")).alias("removed_pct"),
            )
        )
    return counts.select(F.inline(F.array(*entries)))


def word_gate_report(df: DataFrame, text: str, min_words: int = 5) -> DataFrame:
    """One row: rows, rows with enough words, rows below."""
    enough = tx.word_count(F.col(text)) >= min_words
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(enough).alias("kept"),
        F.count_if(~enough).alias("dropped"),
    )


def stage_report(stages: dict[str, DataFrame], of: dict[str, str] | None = None) -> DataFrame:
    """(position, stage, rows, percent): the size of each stage as a share of the stage named in ``of``.

    Without an entry in ``of`` a stage is compared with the first one.
    """
    if not stages:
        raise ValueError("no stages given")
    of = of or {}
    first = next(iter(stages))
    out: DataFrame | None = None
    sizes = {name: df.agg(F.count(F.lit(1)).alias("rows")) for name, df in stages.items()}
    for i, (name, size) in enumerate(sizes.items()):
        whole = sizes[of.get(name, first)].select("rows").scalar()
        row = size.select(
            F.lit(i).cast("long").alias("position"),
            F.lit(name).alias("stage"),
            F.col("rows"),
            percent(F.col("rows"), whole).alias("percent"),
        )
        out = row if out is None else out.unionByName(row)
    return out

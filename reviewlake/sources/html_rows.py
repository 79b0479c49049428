"""Rows out of HTML documents by row and field patterns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.scalars import parse_date, parse_number
from reviewlake.operators.once import compute_once

# The named characters a title may contain; '&amp;' goes last.
ENTITIES: tuple[tuple[str, str], ...] = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"),
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, html): one row per file."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def unescape(text: Column) -> Column:
    out = text
    for name, character in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(character))
    return out


def inner_text(html: Column) -> Column:
    """Text without tags."""
    return unescape(F.regexp_replace(html, r"<[^>]*>", ""))


def extract_rows(
    df: DataFrame, key: str, html: str, row_pattern: str, fields: Mapping[str, str]
) -> DataFrame:
    """(key, position, field...): one row per match of ``row_pattern``.

    Each field is the first group of its pattern within the row, null where it does not match.
    """
    found = F.regexp_extract_all(html, F.lit(row_pattern), F.lit(0))
    listed = compute_once(df.select(key, html), {"_rows": found})
    rows = listed.select(key, F.posexplode("_rows").alias("position", "_row"))
    values = [
        F.when(F.col("_row").rlike(pattern), F.regexp_extract("_row", pattern, 1)).alias(name)
        for name, pattern in fields.items()
    ]
    return rows.select(key, F.col("position").cast("long"), *values)


def game_rows(df: DataFrame, key: str = "path", html: str = "html") -> DataFrame:
    """(appid, title, price, rating, release_date, followers) from the first table body of each page.

    Cells are counted from 0: the title is the link in cell 2; price in cents, rating, release date
    and followers are the ``data-sort`` values of cells 4 to 7. The first row of an appid counts.
    """
    body = F.regexp_extract(html, r"(?is)<tbody.*?</tbody>", 0)
    listed = compute_once(
        df.select(F.col(key).alias("_doc"), html),
        {"_rows": F.regexp_extract_all(body, F.lit(r"(?is)<tr\b.*?</tr>"), F.lit(0))},
    )
    rows = listed.select("_doc", F.posexplode("_rows").alias("_at", "_row"))
    cells = rows.select(
        "_doc",
        "_at",
        F.regexp_extract("_row", r"""(?is)^<tr\b[^>]*\bdata-appid\s*=\s*["']?(\d+)""", 1)
        .try_cast("long")
        .alias("appid"),
        F.regexp_extract_all("_row", F.lit(r"(?is)<td\b.*?</td>"), F.lit(0)).alias("_cells"),
    ).filter(F.col("appid").isNotNull())

    def sort_value(at: int) -> Column:
        return F.regexp_extract(
            F.get("_cells", F.lit(at)), r"""(?is)^<td\b[^>]*\bdata-sort\s*=\s*["']([^"']*)["']""", 1
        )

    game = F.struct(
        inner_text(F.regexp_extract(F.get("_cells", F.lit(2)), r"(?is)<a\b[^>]*>(.*?)</a>", 1)).alias("title"),
        (parse_number(sort_value(4)) / 100).alias("price"),
        parse_number(sort_value(5)).alias("rating"),
        parse_date(sort_value(6)).alias("release_date"),
        parse_number(sort_value(7)).cast("long").alias("followers"),
    )
    first = cells.groupBy("appid").agg(F.min_by(game, F.struct("_doc", "_at")).alias("_game"))
    return first.select("appid", "_game.*")

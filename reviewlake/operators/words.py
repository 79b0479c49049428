"""Base forms of words: tokens are looked up in a (word, base) table and put back in order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions import text as tx
from reviewlake.functions.porter import porter_stem
from reviewlake.operators.once import compute_once

# Documents of a chunk, on average.
CHUNK_ROWS = 256


def distinct_words(df: DataFrame, words: str) -> DataFrame:
    """(word): the distinct words of an array column; each row and each task sends a word once."""
    listed = compute_once(df.select(words), {"_words": F.array_distinct(words)})
    return listed.select(F.explode("_words").alias("word")).filter(F.col("word").isNotNull()).distinct()


def stem_table(df: DataFrame, words: str) -> DataFrame:
    """(word, base) for the distinct words of an array column, by the suffix rules."""
    return distinct_words(df, words).select("word", tx.stem(F.col("word")).alias("base"))


def porter_table(df: DataFrame, words: str) -> DataFrame:
    """(word, base) for the distinct words of an array column, by the Porter stemmer.

    Python sees a word once, however often the texts have it.
    """

    def stemmed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(base=frame["word"].map(porter_stem))

    return distinct_words(df, words).mapInPandas(stemmed, "word string, base string")


def apply_base_forms(
    df: DataFrame, key: str, words: str, forms: DataFrame, output: str = "base_text"
) -> DataFrame:
    """Adds the words joined by a space, each replaced by its base form if the table has one.

    Documents lie in chunks by the hash of their key. Only the distinct words of a chunk meet the table, so a word is one row
    per chunk and not one per document or use; how the table is joined is Spark's choice. Each chunk then gets the base
    forms of its own words, and a document is moved once, whole. The table has one base form per word.
    """
    chunks = max(1, -(-df.count() // CHUNK_ROWS))
    placed = df.withColumn("_chunk", F.pmod(F.xxhash64(key), F.lit(chunks)))
    # Dealt by chunk first: then the distinct words of a chunk are found without moving them again.
    dealt = compute_once(placed.select("_chunk", words).repartition("_chunk"), {"_words": F.array_distinct(words)})
    listed = dealt.select("_chunk", F.explode("_words").alias("word")).filter(F.col("word").isNotNull()).distinct()
    table = forms.filter(F.col("word") != F.col("base")).select("word", "base")
    found = listed.join(table, "word").select(F.col("_chunk").alias("_of"), "word", "base")
    kept = [key, *[name for name in df.columns if name != key]]

    def based(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        bases = dict(zip(pairs["word"].to_pylist(), pairs["base"].to_pylist()))
        texts = [
            " ".join([bases.get(word, word) for word in listed or () if word is not None])
            for listed in documents[words].to_pylist()
        ]
        return documents.select(kept).append_column(output, pa.array(texts, pa.string()))

    schema = T.StructType([*[df.schema[name] for name in kept], T.StructField(output, T.StringType())])
    return placed.groupBy("_chunk").cogroup(found.groupBy("_of")).applyInArrow(based, schema)


def porter_text(words: Column) -> Column:
    """The Porter stems of an array of words, joined by a space. Rows stay where they are."""

    @F.pandas_udf("string")
    def stemmed(rows: pd.Series) -> pd.Series:
        return rows.map(lambda listed: " ".join([porter_stem(word) for word in listed if word is not None]))

    return stemmed(F.coalesce(words, F.array().cast("array<string>")))


def preprocess(
    df: DataFrame,
    key: str,
    text: str,
    stop_words: Sequence[str] = (),
    forms: DataFrame | None = None,
    stem: bool = False,
    output: str = "clean_review",
    porter: bool = False,
) -> DataFrame:
    """Letters only, then stop words out, then base forms from a table, or stems by Porter's or the suffix rules."""
    words: Column = tx.remove_stop_words(tx.split_words(tx.letters_only(F.col(text))), stop_words)
    if forms is not None:
        return apply_base_forms(df.withColumn("_words", words), key, "_words", forms, output).drop("_words")
    if porter:
        return df.withColumn(output, porter_text(words))
    if stem:
        words = F.transform(words, tx.stem)
    return df.withColumn(output, F.array_join(words, " "))

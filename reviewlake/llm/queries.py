"""The registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import (
    backoff_lm, bwt_dedup, byte_bpe, debruijn, direct_codes, fim, packing, reversed_search, secrets, simhash, syncmers,
    toxicity, va_search,
)
from reviewlake.llm.registry import ORACLE, QUERIES, query, table

__all__ = ["ORACLE", "QUERIES"]


@query("op1_nnpu_toxicity")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.scored(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op2_closed_syncmers")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    found = syncmers.with_next(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    )


@query("op3_secret_ledger")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.findings(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("path").alias("doc_id"),
        *map(number, ("assign", "access", "hex")),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


@query(
    "op4_va_file_search",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return va_search.top_k(table(spark, sf, "embeddings"), "vec_id % 50 = 0")


@query("op5_backoff_automaton")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return backoff_lm.score(table(spark, sf, "documents"))


@query("op6_direct_codes")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    found = direct_codes.write_and_read(table(spark, sf, "documents"), vocabulary, end=2)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_residual_packing")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.placements(table(spark, sf, "documents"), vocabulary, end=0)


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.decode(byte_bpe.encode(table(spark, sf, "documents"), ranks), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_simhash_golay")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query("op10_merged_bwt")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    found = bwt_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op11_debruijn_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    n AS (SELECT doc_id, w, len(w) AS n_words FROM d),
    v AS (
      SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
      FROM (SELECT doc_id, w, unnest(range(1, n_words - 48)) AS i FROM n WHERE n_words >= 50)),
    f AS (SELECT k, min(doc_id) AS least FROM v GROUP BY k),
    g AS (
      SELECT doc_id, list(DISTINCT p) AS gone
      FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM v JOIN f USING (k) WHERE least < doc_id) GROUP BY doc_id),
    kept AS (
      SELECT n.doc_id, n_words, coalesce(len(gone), 0) AS n_removed, string_agg(word, ' ' ORDER BY p) AS text
      FROM n LEFT JOIN g USING (doc_id)
        LEFT JOIN (SELECT doc_id, unnest(w) AS word, unnest(range(1, n_words + 1)) AS p FROM n) u
          ON u.doc_id = n.doc_id AND NOT coalesce(list_contains(gone, p), false)
      GROUP BY n.doc_id, n_words, gone)
    SELECT doc_id, n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM kept
    """,
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    found = debruijn.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op12_reversed_search",
    r"""
    WITH t AS (
      SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM t WHERE len(w) > 0),
    f AS (
      SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM t)
      WHERE term IN (SELECT term FROM i) GROUP BY doc_id, n, term),
    g AS (
      SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, c GROUP BY term, docs),
    s AS (
      SELECT item_id, doc_id,
        CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
      FROM f JOIN g USING (term) JOIN i USING (term), c GROUP BY item_id, doc_id),
    r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
    """,
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return reversed_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query(
    "op13_displacement_fim",
    """
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
        sha256('1:' || doc_id) AS h FROM documents),
    n AS (
      SELECT *, len(t) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(t) + 1) AS a,
        CAST('0x' || h[9:16] AS BIGINT) % (len(t) + 1) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
          WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (
      SELECT *, array_to_string(t[1:least(a, b)], '') AS prefix,
        array_to_string(t[least(a, b) + 1:greatest(a, b)], '') AS middle,
        array_to_string(t[greatest(a, b) + 1:], '') AS suffix FROM n)
    SELECT doc_id, n, form,
      CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
      sha256(text) AS restored_sha256
    FROM p
    """,
)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    made = fim.restore(fim.transform(table(spark, sf, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )

"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlake.plans import summaries
from reviewlake.schemas import API_PAGE
from reviewlake.sinks import files, keyed
from reviewlake.sinks.keyed_table import KeyedTable
from reviewlake.sources import delimited, html_rows, review_pages, tables
from reviewlake.streaming import ingest
from reviewlake.workload.registry import (
    GAMES_SQL,
    REVIEWS_SQL,
    games,
    query,
    reviews,
    rounded,
    scratch,
    table,
)


@query("src1_full_scan", "SELECT * FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan(spark, f"{sf}/documents.parquet")


@query("src3_projected_scan", "SELECT doc_id, text FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan_columns(spark, f"{sf}/documents.parquet", ["doc_id", "text"])


@query(
    "src4_not_null_scan",
    "SELECT * FROM documents WHERE text IS NOT NULL ORDER BY doc_id LIMIT 500",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan_not_null(spark, f"{sf}/documents.parquet", "text", 500, ["doc_id"])


@query(
    "src5_random_sample",
    """SELECT event_id, event_type, value FROM events
       WHERE event_type IS NOT NULL AND value IS NOT NULL
       ORDER BY md5('42:' || event_id), event_id LIMIT 1000""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan_sample(spark, f"{sf}/events.parquet", ["event_type", "value"], 1000, "event_id")


@query(
    "src6_sql_query",
    f"""SELECT lang, quality, count(*) AS n, round(avg(n_chars), 6) AS mean_chars
        FROM {REVIEWS_SQL} GROUP BY lang, quality""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return tables.query(
        spark,
        """SELECT d.lang, l.quality, count(*) AS n, round(avg(d.n_chars), 6) AS mean_chars
           FROM {docs} d JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY d.lang, l.quality""",
        docs=table(spark, sf, "documents"),
        labels=table(spark, sf, "labels"),
    )


def api_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as review-API pages of up to 100 entries, passed through JSON text."""
    entry = F.struct(
        (F.col("conv_id") * 100000 + F.col("turn")).cast("string").alias("recommendationid"),
        F.struct(
            F.length("role").cast("string").alias("steamid"),
            F.length("text").cast("long").alias("num_reviews"),
            F.col("turn").alias("num_games_owned"),
            F.col("turn").alias("playtime_at_review"),
            F.length("text").cast("long").alias("playtime_forever"),
        ).alias("author"),
        F.col("text").alias("review"),
        (F.col("conv_id") * 86400 + F.lit(1700000000)).cast("string").alias("timestamp_created"),
        (F.col("role") == "user").alias("voted_up"),
        F.col("turn").alias("votes_up"),
        F.lit(0).cast("long").alias("votes_funny"),
        F.lit("0.5").alias("weighted_vote_score"),
    )
    pages = (
        table(spark, sf, "conversations")
        .groupBy(F.col("conv_id").alias("appid"), F.floor(F.col("turn") / 100).alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct("turn", entry.alias("entry")))).alias("_rows"))
    )
    body = F.to_json(
        F.struct(F.lit("*").alias("cursor"), F.transform("_rows", lambda r: r["entry"]).alias("reviews"))
    )
    parsed = F.from_json(body, API_PAGE)
    return pages.select(
        "appid", "page", parsed["cursor"].alias("cursor"), parsed["reviews"].alias("reviews")
    )


@query(
    "src7_review_rows",
    """SELECT conv_id AS appid, CAST(length(role) AS BIGINT) AS author_id, text AS review,
         strftime(DATE '2023-11-14' + CAST(conv_id AS INTEGER), '%Y-%m-%d') AS review_date,
         turn AS playtime_review, CAST(length(text) AS BIGINT) AS playtime_forever,
         CASE WHEN role = 'user' THEN 1 ELSE 0 END AS voted_up, 0 AS comment_count,
         conv_id * 100000 + turn AS recommendationid
       FROM conversations""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = review_pages.review_rows(review_pages.entries(api_pages(spark, sf)))
    return rows.withColumn("review_date", F.date_format("review_date", "yyyy-MM-dd")).select(
        "appid", "author_id", "review", "review_date", "playtime_review", "playtime_forever",
        "voted_up", F.col("comment_count").cast("int").alias("comment_count"), "recommendationid",
    )


@query(
    "src7_player_rows",
    """SELECT author_id, num_reviews, num_games FROM (
         SELECT CAST(length(role) AS BIGINT) AS author_id, CAST(length(text) AS BIGINT) AS num_reviews,
           turn AS num_games,
           row_number() OVER (PARTITION BY length(role) ORDER BY conv_id, turn) AS rn
         FROM conversations) WHERE rn = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return review_pages.player_rows(review_pages.entries(api_pages(spark, sf)))


@query(
    "src8_cap_per_app",
    """SELECT conv_id AS appid, text AS review FROM (
         SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
         FROM conversations) WHERE rn <= 3""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # A cap below most apps' number of entries, so that it is reached.
    capped = review_pages.cap_per_app(review_pages.entries(api_pages(spark, sf)), 3)
    return capped.select("appid", F.col("entry.review").alias("review"))


@query(
    "src9_html_rows",
    r"""WITH rows AS (
          SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li><a href="[^"]*">.*?</a></li>')) AS item
          FROM pages)
        SELECT page_id, regexp_extract(item, 'href="([^"]*)"', 1) AS link,
          regexp_extract(item, '(?s)">(.*?)</a>', 1) AS title FROM rows""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return html_rows.extract_rows(
        table(spark, sf, "pages"),
        "page_id",
        "html",
        r'(?s)<li><a href="[^"]*">.*?</a></li>',
        {"link": r'href="([^"]*)"', "title": r'(?s)">(.*?)</a>'},
    ).drop("position")


@query(
    "src9_game_table",
    """SELECT p_partkey AS appid, p_name AS title,
         round(CAST(round(p_retailprice * 100) AS BIGINT) / 100.0, 6) AS price,
         CAST(p_size AS DOUBLE) AS rating, '2023-11-14' AS release_date, p_partkey AS followers
       FROM part""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")

    def cell(value: Column, body: str = "") -> Column:
        return F.concat(F.lit('<td data-sort="'), value.cast("string"), F.lit(f'">{body}</td>'))

    row = F.concat(
        F.lit('<tr class="app" data-appid="'),
        F.col("p_partkey").cast("string"),
        F.lit('">\n<td>1</td><td></td><td><a href="#"><b>'),
        F.col("p_name"),
        F.lit("</b></a></td><td></td>"),
        cell(F.round(F.col("p_retailprice") * 100).cast("long")),
        cell(F.col("p_size")),
        cell(F.lit("1700000000")),
        cell(F.col("p_partkey")),
        F.lit("</tr>"),
    )
    pages = part.groupBy(F.floor(F.col("p_partkey") / 100).alias("path")).agg(
        F.concat(F.lit("<table><tbody>"), F.array_join(F.collect_list(row), "\n"), F.lit("</tbody></table>")).alias("html")
    )
    found = html_rows.game_rows(pages)
    return rounded(found, "price").withColumn("release_date", F.date_format("release_date", "yyyy-MM-dd"))


@query("src10_delimited_file", "SELECT doc_id, text, lang FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = table(spark, sf, "documents").select("doc_id", "text", "lang")
    files.write_delimited(rows, path, ";")
    return delimited.read_delimited(spark, path, rows.schema, ";")


@query("snk1_csv", "SELECT page_id, url, html FROM pages")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = table(spark, sf, "pages").select("page_id", "url", "html")
    files.write_delimited(rows, path)
    return delimited.read_delimited(spark, path, rows.schema, ",")


@query("snk2_split_tables", "SELECT doc_id, source, lang FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    files.write_splits(table(spark, sf, "documents").select("doc_id", "source", "lang"), path, "lang")
    return spark.read.parquet(path).select("doc_id", "source", "lang")


@query(
    "snk3_append",
    "SELECT doc_id, lang FROM documents UNION ALL SELECT doc_id, CAST(quality AS VARCHAR) FROM labels",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    files.append(table(spark, sf, "documents").select("doc_id", "lang"), path)
    files.append(
        table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("lang")), path
    )
    return spark.read.parquet(path)


@query(
    "snk4_insert_or_ignore",
    """SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
       UNION ALL
       SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    first = reviews(spark, sf).select("doc_id", "source")
    keyed.insert_or_ignore(first, path, "doc_id", ["source"])
    everything = table(spark, sf, "documents").select("doc_id", "source")
    again = everything.unionByName(first)
    keyed.insert_or_ignore(again, path, "doc_id", ["source"])
    keyed.insert_or_ignore(again, path, "doc_id", ["source"])
    return spark.read.parquet(path)


@query(
    "snk4_new_rows",
    "SELECT doc_id, source, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    batch = table(spark, sf, "documents").select("doc_id", "source", "text")
    return keyed.new_rows(batch.unionByName(batch), table(spark, sf, "labels"), "doc_id", ["source"])


@query("snk5_batched_write", "SELECT event_id, user_id, event_type FROM events")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    files.write_batched(table(spark, sf, "events").select("event_id", "user_id", "event_type"), path, 5000)
    return spark.read.parquet(path)


@query(
    "snk6_update_rows",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    changed = keyed.update_rows(
        orders, F.col("o_orderstatus") == "F", {"o_orderpriority": "closed", "o_totalprice": 0.0}
    )
    return changed.select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("snk6_affected_rows", "SELECT count(*) AS affected FROM orders WHERE o_orderstatus = 'F'")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.affected(table(spark, sf, "orders"), F.col("o_orderstatus") == "F")


@query(
    "snk6_update_from",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.source ELSE 'q' || l.quality END AS source
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    updates = table(spark, sf, "labels").select(
        "doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("source")
    )
    return keyed.update_from(table(spark, sf, "documents").select("doc_id", "source"), updates, "doc_id")


@query(
    "snk7_delete_rows",
    "SELECT event_id, event_type FROM events WHERE event_type <> 'error'",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return keyed.delete_rows(rows, F.col("event_type") == "error")


@query(
    "snk7_delete_duplicates",
    """SELECT min(doc_id) AS doc_id, lang, text, arg_min(source, doc_id) AS source
       FROM documents GROUP BY lang, text""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "lang", "text", "source")
    return keyed.delete_duplicates(rows, ["lang", "text"], "doc_id")


@query(
    "snk8_text_per_product",
    f"""SELECT appid AS source, 'SUMMARY FOR GAME ' || appid || chr(10) || chr(10) || total || ' reviews, '
          || positive || ' positive' || chr(10) AS value FROM {GAMES_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = games(spark, sf).select(
        F.col("appid").alias("source"),
        F.col("appid").alias("title"),
        F.concat("total", F.lit(" reviews, "), "positive", F.lit(" positive")).alias("text"),
    )
    files.write_texts(rows, path, "source", "text", "title")
    return spark.read.text(path, wholetext=True).select("source", "value")


@query(
    "snk9_json_export",
    f"""SELECT '{{"kind":"summary","appid":"' || appid || '","total":' || total || '}}' AS value FROM {GAMES_SQL}
        UNION ALL
        SELECT '{{"kind":"metadata","total_products":' || count(*) || ',"total_api_calls":' || count(*)
          || ',"total_tokens_used":' || CAST(sum(total) AS BIGINT) || '}}' FROM {GAMES_SQL}
        UNION ALL SELECT '{{"kind":"config","sample_limit":50,"max_text_length":8000}}'""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = games(spark, sf).select("appid", "total")
    statistics = summaries.cache_statistics(rows, "appid", "total").drop("estimated_cost")
    config = {"sample_limit": summaries.SAMPLE_LIMIT, "max_text_length": summaries.MAX_TEXT_LENGTH}
    files.export_json(rows, statistics, config, path)
    return spark.read.text(path)


@query("inc1_incremental_ingest", "SELECT doc_id, lang, source FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source")
    # Two arrivals with the labelled documents in both of them, and each ingest run repeated.
    files.append(reviews(spark, sf).select(*rows.columns), f"{path}/incoming")
    for _ in range(2):
        _ingest(spark, path, rows)
    files.append(rows.unionByName(rows), f"{path}/incoming")
    for _ in range(2):
        _ingest(spark, path, rows)
    return spark.read.parquet(f"{path}/target")


def _ingest(spark: SparkSession, path: str, rows: DataFrame) -> None:
    stream = ingest.parquet_stream(spark, f"{path}/incoming", rows.schema)
    ingest.ingest_stream(
        stream, f"{path}/target", f"{path}/progress", "doc_id", ["lang", "source"]
    ).awaitTermination()


def _keyed(spark: SparkSession, rows: DataFrame, key: str, name: str = "table") -> KeyedTable:
    return KeyedTable(spark, f"{scratch(spark)}/{name}", rows.schema, (key,), 16)


APPS, PAGE_SIZE = 8, 4
CHAIN_SQL = f"""(WITH e AS (
      SELECT conv_id % {APPS} AS appid, conv_id * 100000 + turn AS recommendationid, text,
        (row_number() OVER (PARTITION BY conv_id % {APPS} ORDER BY conv_id, turn) - 1) // {PAGE_SIZE} + 1 AS page
      FROM conversations),
    p AS (SELECT appid, page, CASE WHEN page = appid % 5 + 2 THEN 1 ELSE page END AS cursor FROM e GROUP BY appid, page),
    s AS (SELECT appid, page, row_number() OVER (PARTITION BY appid, cursor ORDER BY page) > 1 AS again FROM p),
    f AS (SELECT appid, min(page) AS stop FROM s WHERE again GROUP BY appid)
    SELECT e.* FROM e LEFT JOIN f USING (appid) WHERE stop IS NULL OR page < stop)"""


def page_files(spark: SparkSession, sf: str) -> str:
    """Saved API pages, one file each: a later page of every app repeats the first one's cursor, and every third file has a byte-order mark."""
    path = scratch(spark)
    app, order = (F.col("conv_id") % APPS).alias("appid"), Window.partitionBy("appid").orderBy("conv_id", "turn")
    rows = table(spark, sf, "conversations").select(
        app, "conv_id", "turn",
        F.struct(
            (F.col("conv_id") * 100000 + F.col("turn")).cast("string").alias("recommendationid"),
            F.struct(F.length("role").cast("string").alias("steamid")).alias("author"),
            F.col("text").alias("review"),
        ).alias("entry"),
    )
    page = F.floor((F.row_number().over(order) - 1) / PAGE_SIZE) + 1
    pages = rows.withColumn("page", page).groupBy("appid", "page").agg(
        F.sort_array(F.collect_list(F.struct("conv_id", "turn", "entry"))).alias("_rows")
    )
    body = F.to_json(F.struct(
        F.when(F.col("page") == F.col("appid") % 5 + 2, F.lit(1)).otherwise(F.col("page")).cast("string").alias("cursor"),
        F.transform("_rows", lambda r: r["entry"]).alias("reviews"),
        F.struct(
            F.lit("Mixed").alias("review_score_desc"), (F.col("appid") * 10 + F.col("page")).alias("total_reviews")
        ).alias("query_summary"),
    ))
    marked = F.when(F.col("page") % 3 == 0, F.concat(F.lit("\ufeff"), body)).otherwise(body)
    files.write_named(pages.select(marked.alias("value"), "appid", "page"), path, "appid", "page", "value")
    return path


@query("src7_pages_from_files", f"SELECT appid, page, recommendationid, text AS review FROM {CHAIN_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews of saved page files, as far as the cursors of an app lead on."""
    pages = review_pages.followed(review_pages.read_pages(spark, page_files(spark, sf)))
    entry = F.col("entry")
    return review_pages.entries(pages).select(
        "appid", "page", entry["recommendationid"].cast("long").alias("recommendationid"), entry["review"].alias("review")
    )


@query(
    "src7_query_summaries",
    f"""SELECT g.appid, CASE WHEN c.appid IS NULL THEN 'none' ELSE 'Mixed' END AS review_score_desc,
          CASE WHEN c.appid IS NULL THEN -1 ELSE g.appid * 10 + 1 END AS total_reviews
        FROM (SELECT unnest(range(0, {2 * APPS})) AS appid) g
          LEFT JOIN (SELECT DISTINCT conv_id % {APPS} AS appid FROM conversations) c USING (appid)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The summaries of saved pages bring a table of games up to date."""
    known = spark.range(2 * APPS).select(
        F.col("id").alias("appid"), F.lit("none").alias("review_score_desc"), F.lit(-1).cast("long").alias("total_reviews")
    )
    found = review_pages.query_summaries(review_pages.read_pages(spark, page_files(spark, sf)))
    return keyed.update_from(known, found.select("appid", "review_score_desc", "total_reviews"), "appid")


@query("inc1_page_ingest", f"SELECT appid, count(*) AS held FROM {CHAIN_SQL.replace('page < stop', 'true')} GROUP BY appid")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All saved pages through a stream into keyed tables, then the same pages with a new start: nothing is added."""
    source, target = page_files(spark, sf), scratch(spark)
    kept = ingest.ReviewTables.at(spark, target, 16)
    for run in range(2):
        ingest.ingest_review_pages(spark, source, kept, f"{target}/progress-{run}", cap=10**9).awaitTermination()
    return kept.counts.read()


@query("snk4_keyed_table", "SELECT doc_id, source FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Insert-or-ignore into buckets: the labelled documents, then all of them twice."""
    everything = table(spark, sf, "documents").select("doc_id", "source")
    target = _keyed(spark, everything, "doc_id")
    target.insert_or_ignore(reviews(spark, sf).select("doc_id", "source"), ["source"])
    for _ in range(2):
        target.insert_or_ignore(everything.unionByName(everything), ["source"])
    return target.read()


@query("inc1_keyed_ingest", "SELECT doc_id, lang, source FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The stream of ``inc1_incremental_ingest`` into a keyed table: every micro-batch reads its own buckets."""
    path = scratch(spark)
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source")
    target = _keyed(spark, rows, "doc_id")
    for arrival in (reviews(spark, sf).select(*rows.columns), rows.unionByName(rows)):
        files.append(arrival, f"{path}/incoming")
        for _ in range(2):
            stream = ingest.parquet_stream(spark, f"{path}/incoming", rows.schema)
            ingest.ingest_stream(stream, target, f"{path}/progress", "doc_id", ["lang", "source"]).awaitTermination()
    return target.read()


@query(
    "sum7_keyed_cache",
    """SELECT l_orderkey AS appid, arg_max(l_extendedprice, (l_shipdate, l_linenumber)) AS price,
         max(l_shipdate) AS at FROM lineitem GROUP BY l_orderkey""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A cache of the latest entry per key, brought up to date by three changes of it."""
    entries = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("appid"), F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("at"),
        F.col("l_linenumber").alias("line"),
    )
    cache = _keyed(spark, entries, "appid")
    for part in range(3):
        cache.upsert(entries.filter(F.col("line") % 3 == part), ["at", "line"])
    return cache.read().select("appid", "price", "at")

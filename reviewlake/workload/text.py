"""Text, number, date and score functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import porter, scalars
from reviewlake.functions import text as tx
from reviewlake.operators import words
from reviewlake.plans.summaries import joined_in_order
from reviewlake.workload import sqltext as sq
from reviewlake.workload.registry import documents, query, six, table

# A short list of words frequent in the documents, spelled out in the SQL as well.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "de", "la", "der", "die", "und", "le", "el", "que")
STOP_SQL = ", ".join(f"'{word}'" for word in STOP_WORDS)


def marked_up(spark: SparkSession, sf: str) -> DataFrame:
    """Documents wrapped in the links, tags and platform lines reviews come with."""
    return documents(spark, sf).select(
        "doc_id",
        F.concat(
            F.lit("[h1]Posted by "), "source", F.lit("[/h1] <b>See</b> https://a.b/c?d=e www.f.g "),
            "text",
            F.lit("\nPosted: 3 May\n12.5 hrs on record product RECEIVED for free early access review <br/>"),
        ).alias("text"),
    )


MARKED_UP_SQL = """(SELECT doc_id, '[h1]Posted by ' || source || '[/h1] <b>See</b> https://a.b/c?d=e www.f.g' || chr(160)
    || text || chr(10) || 'Posted: 3 May' || chr(10) || '12.5 hrs on record' || chr(8232)
    || 'product RECEIVED for free early access review <br/>' AS text FROM documents)"""


def _documents(spark: SparkSession, sf: str, value: Column, name: str = "value") -> DataFrame:
    return documents(spark, sf).select("doc_id", value.alias(name))


@query("txt1_clean_text", f"SELECT page_id, {sq.clean('html')} AS value FROM pages")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", tx.clean_text(F.col("html")).alias("value"))


@query("txt2_clean_brackets", f"SELECT doc_id, {sq.clean('text', True)} AS value FROM {MARKED_UP_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return marked_up(spark, sf).select("doc_id", tx.clean_text(F.col("text"), brackets=True).alias("value"))


@query("txt3_letters_only", f"SELECT doc_id, {sq.letters_only('text')} AS value FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf, tx.letters_only(F.col("text")))


@query(
    "txt4_words_only",
    "SELECT doc_id, "
    + sq.squeeze(sq.replace(sq.replace("lower(text)", r"\p{Nd}+"), f"[^{sq.WORD}{sq.SPACE}]"))
    + " AS value FROM documents",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf, tx.words_only(F.col("text")))


@query(
    "txt5_clean_minimal",
    "SELECT page_id, "
    + sq.squeeze(
        sq.replace(
            sq.replace(sq.replace("html", r"<[^\n]*?>"), r"\[[^\n]*?\]"), f"http[^{sq.SPACE}]+"
        )
    )
    + " AS value FROM pages",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", tx.clean_minimal(F.col("html")).alias("value"))


DROP_METADATA_SQL = sq.squeeze(
    sq.replace(
        sq.replace(
            sq.replace(
                sq.replace("text", r"(?i)Posted:[^\n]*"), rf"\p{{Nd}}+\.\p{{Nd}}+[{sq.SPACE}]*hrs on record"
            ),
            "(?i)Product received for free",
        ),
        "(?i)Early Access Review",
    )
)


@query("txt6_drop_metadata", f"SELECT doc_id, {DROP_METADATA_SQL} AS value FROM {MARKED_UP_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return marked_up(spark, sf).select("doc_id", tx.drop_metadata(F.col("text")).alias("value"))


def domain_sql() -> str:
    """Every word is put between marks first, so that word boundaries can be matched literally."""
    begin, end, digits = r"\x{1}", r"\x{2}", r"\p{Nd}{1,4}"
    hours = "{b}{d}({e}[{s}]{b})?{w}{e}"
    patterns = [
        hours.format(b=begin, e=end, d=digits, s=sq.SPACE, w="hrs?"),
        hours.format(b=begin, e=end, d=digits, s=sq.SPACE, w="hours?"),
    ]
    plain = [
        "play(ed|ing)?", "update", "patch", "devs?", "dev(eloper)?s?", "early access",
        "refund(ed|ing)?", "recommend(ed|ing)?", "not recommend(ed|ing)?", "worth it", "price",
        "performance", "fps", "lag", "crash(es|ed)?",
    ]
    patterns += [begin + p.replace(" ", f"{end} {begin}") + end for p in plain]
    out = f"regexp_replace(text, '([{sq.WORD}]+)', chr(1) || '\\1' || chr(2), 'g')"
    for pattern in patterns:
        out = sq.replace(out, f"(?i){pattern}", " ")
    listed = f"regexp_extract_all(lower({out}), '\\x{{1}}([a-z]{{3,}})\\x{{2}}', 1)"
    return f"array_to_string({listed}, ' ')"


PLAYED_SQL = """(SELECT doc_id, '10 hrs played, 3hours NOT recommended; Early Access worth it, fps-crashes ' || text
    AS text FROM documents)"""


@query("txt7_drop_domain_terms", f"SELECT doc_id, {domain_sql()} AS value FROM {PLAYED_SQL}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    played = F.concat(
        F.lit("10 hrs played, 3hours NOT recommended; Early Access worth it, fps-crashes "), "text"
    )
    return _documents(spark, sf, tx.drop_domain_terms(played))


def _without_stop_words(words_sql: str) -> str:
    return f"array_to_string(list_filter({words_sql}, lambda w: w NOT IN ({STOP_SQL})), ' ')"


@query(
    "txt8_remove_stop_words",
    f"SELECT doc_id, {_without_stop_words(sq.word_list(sq.letters_only('text')))} AS value FROM documents",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf, tx.remove_stop_words_text(tx.letters_only(F.col("text")), STOP_WORDS))


@query(
    "txt9_remove_stop_words_split",
    f"SELECT doc_id, {_without_stop_words(sq.word_list('lower(text)'))} AS value FROM documents",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf, tx.remove_stop_words_text(F.lower("text"), STOP_WORDS))


def base_forms(spark: SparkSession, sf: str) -> DataFrame:
    """A word table made from the benchmark passages: the base form of a word is the word and a mark."""
    name = F.explode(tx.tokens(F.col("text"))).alias("word")
    distinct = table(spark, sf, "benchmark").select(name).distinct()
    return distinct.select("word", F.concat("word", F.lit("_")).alias("base"))


@query(
    "txt10_base_forms",
    f"""WITH forms AS (SELECT DISTINCT unnest({sq.tokens('text')}) AS word FROM benchmark),
          words AS (SELECT doc_id, {sq.tokens('text')} AS ws FROM documents),
          placed AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM words)
        SELECT d.doc_id, coalesce(t.base_text, '') AS base_text FROM documents d LEFT JOIN (
          SELECT doc_id, string_agg(CASE WHEN f.word IS NULL THEN p.word ELSE p.word || '_' END, ' ' ORDER BY pos) AS base_text
          FROM placed p LEFT JOIN forms f USING (word) GROUP BY doc_id) t USING (doc_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf, tx.tokens(F.col("text")), "words")
    return words.apply_base_forms(docs, "doc_id", "words", base_forms(spark, sf)).drop("words")


STEM_SQL = """CASE
    WHEN word SIMILAR TO '.*sses' THEN left(word, length(word) - 2)
    WHEN word SIMILAR TO '.*ies' AND length(word) >= 5 THEN left(word, length(word) - 2)
    WHEN word SIMILAR TO '.*[^s]s' AND length(word) >= 4 THEN left(word, length(word) - 1)
    WHEN word SIMILAR TO '.*ing' AND length(word) >= 6 THEN left(word, length(word) - 3)
    WHEN word SIMILAR TO '.*ed' AND length(word) >= 5 THEN left(word, length(word) - 2)
    ELSE word END"""


@query(
    "txt10_stem_table",
    f"""SELECT word, {STEM_SQL} AS base FROM
        (SELECT DISTINCT unnest({sq.tokens('text')}) AS word FROM documents)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf, tx.tokens(F.col("text")), "words")
    return words.stem_table(docs, "words")


def _sounds_sql(word: str) -> str:
    """V or C for every letter; a run of y is resolved from its left, one letter in each pass."""
    out = f"regexp_replace(regexp_replace(regexp_replace({word}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g'), '^y', 'C')"
    for _ in range(4):
        out = f"regexp_replace(regexp_replace({out}, 'Vy', 'VC', 'g'), 'Cy', 'CV', 'g')"
    return out


def _porter_sql(words: str) -> str:
    """(word, base) of the query ``words`` (word), one step after another."""

    def left(n: int) -> str:
        return f"left(w, length(w) - {n})"

    def measure(n: int) -> str:
        return f"len(regexp_extract_all(left(c, length(c) - {n}), 'V+C+'))"

    def short(n: int) -> str:
        kinds = f"left(c, length(c) - {n})"
        return f"({kinds} = 'VC' OR ({kinds} SIMILAR TO '.*CVC' AND {left(n)} NOT SIMILAR TO '.*[wxy]'))"

    def step(name: str, before: str, cases: list[tuple[str, str]]) -> str:
        chosen = " ".join(f"WHEN {when} THEN {then}" for when, then in cases)
        return f"{name} AS (SELECT word, w, {_sounds_sql('w')} AS c FROM (SELECT word, CASE {chosen} ELSE w END AS w FROM {before}))"

    def ends(ending: str) -> str:
        return f"w LIKE '%{ending}'"

    def rules(pairs, condition) -> list[tuple[str, str]]:
        return [(ends(e), f"CASE WHEN {condition(e)} THEN {left(len(e))} || '{by}' ELSE w END") for e, by in pairs]

    irregular = " ".join(f"WHEN '{word}' THEN '{stem}'" for word, stem in porter.IRREGULAR.items())
    steps = [
        f"p0 AS (SELECT word, word AS w, {_sounds_sql('word')} AS c FROM ({words}))",
        step("p1", "p0", [
            (f"{ends('ies')} AND length(w) = 4", left(1)), (ends("ies"), left(2)), (ends("sses"), left(2)),
            (f"{ends('s')} AND NOT {ends('ss')}", left(1)),
        ]),
        f"""p2 AS (SELECT word, w, {_sounds_sql('w')} AS c, cut FROM (SELECT word, CASE
            WHEN {ends('ied')} AND length(w) = 4 THEN {left(1)} WHEN {ends('ied')} THEN {left(2)}
            WHEN {ends('eed')} THEN CASE WHEN {measure(3)} > 0 THEN {left(1)} ELSE w END
            WHEN {ends('ed')} AND left(c, length(c) - 2) LIKE '%V%' THEN {left(2)}
            WHEN {ends('ing')} AND left(c, length(c) - 3) LIKE '%V%' THEN {left(3)} ELSE w END AS w,
          NOT {ends('ied')} AND NOT {ends('eed')} AND (({ends('ed')} AND left(c, length(c) - 2) LIKE '%V%')
            OR ({ends('ing')} AND left(c, length(c) - 3) LIKE '%V%')) AS cut FROM p1))""",
        step("p3", "p2", [
            (f"cut AND ({ends('at')} OR {ends('bl')} OR {ends('iz')})", "w || 'e'"),
            ("cut AND length(w) > 1 AND right(w, 1) = left(right(w, 2), 1) AND c LIKE '%C'",
             f"CASE WHEN right(w, 1) IN ('l', 's', 'z') THEN w ELSE {left(1)} END"),
            (f"cut AND {measure(0)} = 1 AND {short(0)}", "w || 'e'"),
        ]),
        step("p4", "p3", [(f"{ends('y')} AND length(w) > 2 AND left(c, length(c) - 1) LIKE '%C'", f"{left(1)} || 'i'")]),
        step("p5", "p4", [(f"{ends('alli')} AND {measure(4)} > 0", left(2))]),
        step("p6", "p5", rules(porter.SECOND, lambda e: f"{measure(3 if e == 'logi' else len(e))} > 0")),
        step("p7", "p6", rules(porter.THIRD, lambda e: f"{measure(len(e))} > 0")),
        step("p8", "p7", rules([(e, "") for e in porter.FOURTH], lambda e: f"{measure(len(e))} > 1"
             + (f" AND {left(3)} SIMILAR TO '.*[st]'" if e == "ion" else ""))),
        step("p9", "p8", [(f"{ends('e')} AND ({measure(1)} > 1 OR ({measure(1)} = 1 AND NOT {short(1)}))", left(1))]),
        step("p10", "p9", [(f"{ends('ll')} AND {measure(1)} > 1", left(1))]),
    ]
    return f"""(WITH {', '.join(steps)}
        SELECT word, CASE word {irregular} ELSE CASE WHEN length(word) <= 2 THEN word ELSE w END END AS base FROM p10)"""


@query(
    "txt10_porter_stems",
    f"SELECT word, base FROM {_porter_sql(f'SELECT DISTINCT unnest({sq.tokens("text")}) AS word FROM documents')}",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf, tx.tokens(F.col("text")), "words")
    return words.porter_table(docs, "words")


@query(
    "txt11_preprocess_porter",
    f"""WITH kept AS (SELECT doc_id, list_filter({sq.word_list(sq.letters_only('text'))},
            lambda w: w NOT IN ({STOP_SQL})) AS ws FROM documents),
          placed AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM kept),
          stems AS {_porter_sql('SELECT DISTINCT word FROM placed')}
        SELECT d.doc_id, coalesce(t.clean_review, '') AS clean_review FROM documents d LEFT JOIN (
          SELECT doc_id, string_agg(base, ' ' ORDER BY pos) AS clean_review FROM placed JOIN stems USING (word)
          GROUP BY doc_id) t USING (doc_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return words.preprocess(docs, "doc_id", "text", STOP_WORDS, porter=True).drop("text")


@query(
    "txt11_preprocess",
    f"""WITH kept AS (SELECT doc_id, list_filter({sq.word_list(sq.letters_only('text'))},
            lambda w: w NOT IN ({STOP_SQL})) AS ws FROM documents),
          placed AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM kept)
        SELECT d.doc_id, coalesce(t.clean_review, '') AS clean_review FROM documents d LEFT JOIN (
          SELECT doc_id, string_agg({STEM_SQL}, ' ' ORDER BY pos) AS clean_review FROM placed GROUP BY doc_id) t
        USING (doc_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return words.preprocess(docs, "doc_id", "text", STOP_WORDS, stem=True).drop("text")


@query(
    "txt12_text_sizes",
    f"""SELECT doc_id, CAST(len({sq.word_list('text')}) AS BIGINT) AS word_count,
          CAST(length(text) AS BIGINT) AS text_length FROM documents""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id",
        tx.word_count(F.col("text")).alias("word_count"),
        tx.char_length(F.col("text")).alias("text_length"),
    )


@query(
    "txt13_shorten",
    """SELECT doc_id, left(text, 8000) AS t8000, left(text, 500) AS t500, left(text, 300) AS t300,
         left(text, 150) || '...' AS t150 FROM documents""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.shorten(text, 8000).alias("t8000"),
        tx.shorten(text, 500).alias("t500"),
        tx.shorten(text, 300).alias("t300"),
        tx.shorten(text, 150, "...").alias("t150"),
    )


@query(
    "txt14_join_list",
    """SELECT role, string_agg(text, chr(10) || '- ' ORDER BY rn) AS value FROM (
         SELECT role, text, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rn
         FROM conversations) GROUP BY role""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    placed = rows.withColumn("rank", F.struct("conv_id", "turn"))
    return placed.groupBy("role").agg(joined_in_order("rank", "text", "\n- ").alias("value"))


@query(
    "txt15_last_segment",
    "SELECT event_id, split_part('score_' || event_type, '_', -1) AS value FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    label = F.concat(F.lit("score_"), "event_type")
    return table(spark, sf, "events").select("event_id", tx.last_segment(label).alias("value"))


@query(
    "txt16_sections",
    """WITH s AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'HIGHLIGHTS, pain points and the verdict'
          WHEN 'click' THEN 'Top 3 highlights, Verdict' WHEN 'error' THEN 'pain points' ELSE props END AS summary
          FROM events),
        f AS (SELECT event_id, lower(summary) LIKE '%highlights%' AS h, lower(summary) LIKE '%pain points%' AS p,
          lower(summary) LIKE '%verdict%' AS v FROM s)
       SELECT event_id, h AND p AND v AS complete,
         concat_ws(', ', CASE WHEN NOT h THEN 'Highlights' END, CASE WHEN NOT p THEN 'Pain Points' END,
           CASE WHEN NOT v THEN 'Verdict' END) AS missing FROM f""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    summary = (
        F.when(kind == "view", "HIGHLIGHTS, pain points and the verdict")
        .when(kind == "click", "Top 3 highlights, Verdict")
        .when(kind == "error", "pain points")
        .otherwise(F.col("props"))
    )
    return table(spark, sf, "events").select(
        "event_id", tx.has_sections(summary).alias("complete"), tx.missing_sections(summary).alias("missing")
    )


@query("txt17_token_estimate", "SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS value FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf, tx.token_estimate(F.col("text")))


@query(
    "num1_parse_number",
    r"""WITH t AS (SELECT event_id, CASE event_type WHEN 'view' THEN replace(CAST(value AS VARCHAR), '.', ',')
          WHEN 'error' THEN '-1' WHEN 'click' THEN 'n/a' ELSE props END AS s FROM events),
        n AS (SELECT event_id, regexp_extract(s, '-?\d+([.,]\d+)?') AS m FROM t)
       SELECT event_id, CASE WHEN m IN ('', '-1') THEN NULL ELSE TRY_CAST(replace(m, ',', '.') AS DOUBLE) END AS value
       FROM n""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")))
        .when(kind == "error", "-1")
        .when(kind == "click", "n/a")
        .otherwise(F.col("props"))
    )
    return table(spark, sf, "events").select("event_id", scalars.parse_number(text).alias("value"))


@query(
    "dat1_parse_date",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN '0' WHEN event_type = 'error' THEN NULL
         ELSE NULL END AS dropped,
         CASE WHEN event_type IN ('view', 'error') THEN NULL
           ELSE strftime(DATE '1970-01-01' + CAST((1600000000 + event_id * 4321) // 86400 AS INTEGER), '%Y-%m-%d')
         END AS day FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", "0")
        .when(kind == "error", "abc")
        .otherwise((F.col("event_id") * 4321 + 1600000000).cast("string"))
    )
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "view", "0").alias("dropped"),
        F.date_format(scalars.parse_date(text), "yyyy-MM-dd").alias("day"),
    )


@query(
    "mth1_transforms",
    """SELECT event_id, round(exp(value / 100), 6) AS exp_value,
         round(log10(value), 6) AS log_value, round(sign(value - 50) * pow(abs(value - 50), 2), 6) AS power_value
       FROM events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        six(F.exp(value / 100)).alias("exp_value"),
        six(scalars.log10(value)).alias("log_value"),
        six(scalars.signed_power(value - 50, 2)).alias("power_value"),
    )


@query(
    "mth2_best_column",
    """WITH s AS (SELECT event_id, nullif(value, 0.01) AS a, CASE WHEN event_type <> 'error' THEN user_id * 1.0 END AS b,
          CASE WHEN event_type = 'view' THEN value END AS c FROM events)
       SELECT event_id, CASE WHEN a = greatest(a, b, c) THEN 'a' WHEN b = greatest(a, b, c) THEN 'b'
         WHEN c = greatest(a, b, c) THEN 'c' END AS best FROM s""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id",
        F.nullif("value", F.lit(0.01)).alias("a"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("double")).alias("b"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("c"),
    )
    return events.select("event_id", scalars.best_column(["a", "b", "c"]).alias("best"))


@query(
    "mth3_l2_normalise",
    """WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
        n AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS norm FROM e GROUP BY vec_id)
       SELECT vec_id, CAST(pos AS BIGINT) AS pos, round(CAST(x AS DOUBLE) / norm, 6) AS value FROM e JOIN n USING (vec_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    unit = table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(scalars.l2_normalise(F.col("embedding"))).alias("pos", "value")
    )
    return unit.select("vec_id", F.col("pos").cast("long").alias("pos"), six("value").alias("value"))

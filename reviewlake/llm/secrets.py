"""Secret scans with an incremental ledger of content-addressed blobs, in DataFrame expressions alone.

Every version of every path is addressed by the SHA-256 of its text. The ledger has a row for each blob and rule
version that was scanned, also where nothing was found; only pairs it doesn't have are scanned, and the findings of
all blobs are joined back to the paths that hold them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import free_names, scratch


@dataclass(frozen=True)
class Rule:
    """``pattern``'s leftmost non-overlapping matches whose group ``group`` has ``least`` characters or more.

    ``hint`` is a cheaper pattern found in every text that can have a finding.
    """

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str


#: The rules, in the order in which findings at one place are listed. A run of hexadecimal digits or of
#: key characters is as long as it can be, so the least length can stand in the pattern.
#: A key runs from its BEGIN line to the next END line. Without one before the next five dashes, it has the header lines,
#: runs of 40 key characters and whole lines of key characters that follow; line ends may be written as \n or \r.
_NEXT = r"""(?:\s|\\[nr]|["'+,])"""
_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_NEXT}++(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+"
    rf"(?:{_NEXT}*+[A-Za-z0-9+/]{{40,}}+={{0,2}}|[ \t\x22'+,]*+(?:[\r\n]|\\[nr]){_NEXT}*+[A-Za-z0-9+/]++={{0,2}}(?=[ \t]*+(?:[\x22'\r\n]|\\[nr]|\Z)))*+)"
)
_NAMES = "(?i:(password|passwd|secret|token|api_?key))"
RULES = (
    Rule("assign", 1, _NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, _NAMES + r"""["']?\x20*[:=]"""),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20, r"AKIA[A-Z0-9]{16}"),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
    Rule("pem", 2, _KEY, 0, 1, r"-----BEGIN"),
)
LEDGER = "blob binary, kind string, rule_version int, spans array<struct<start: long, end: long>>"


def _matches(text: Column, rule: Rule, unseen: Column) -> Column:
    """(gap before, length, whether it counts) of each match, in order; lengths in code points."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    rows = F.zip_with(
        F.slice(gaps, 1, F.size(found)),
        F.zip_with(found, values, lambda a, b: F.struct(F.length(a).alias("n"), F.length(b).alias("v"))),
        lambda gap, m: F.struct(gap.alias("gap"), m["n"].alias("length"), (m["v"] >= rule.least).alias("counts")),
    )
    return F.when(unseen & F.rlike(text, F.lit(rule.hint)), rows)


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, version, blob, spans) of every row of ``versions`` (path, version, text), with the ledger brought up to date.

    ``spans`` is an array of (start, place, kind, end), by start and then by the rules' order; start and end count code
    points. Null texts count as empty; null paths and versions, and repeated rows, stay as they are. ``ledger`` is a
    folder that all executors share; it is made if it isn't there. An empty table gives an empty table.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = versions.select("path", "version", F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"), text.alias("text"))
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    known = spark.read.schema(LEDGER).parquet(ledger)
    wanted = [F.concat_ws("/", F.lit(rule.kind), F.lit(rule.version)) for rule in rules]
    seen = known.groupBy("blob").agg(F.collect_set(F.concat_ws("/", "kind", "rule_version")).alias("seen"))
    # Map tasks send one row per blob, so copies are neither moved nor scanned.
    blobs = held.select("blob", "text").dropDuplicates(["blob"]).join(seen, "blob", "left")
    lacking = [~F.coalesce(F.array_contains("seen", name), F.lit(False)) for name in wanted]
    scanned = blobs.select(
        "blob",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("rule"), unseen.alias("unseen"), _matches(F.col("text"), rule, unseen).alias("found")
                    )
                    for i, (rule, unseen) in enumerate(zip(rules, lacking))
                ]
            )
        ),
    ).filter("unseen")
    rows = scanned.select("blob", "rule", F.posexplode_outer("found").alias("place", "match"))
    so_far = Window.partitionBy("blob", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("match.gap") + F.col("match.length")).over(so_far)
    placed = rows.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.col("match.length"))
    span = F.when(F.col("match.counts"), F.struct("start", "end"))
    entries = placed.groupBy("blob", "rule").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    numbers = F.array(*[F.lit(rule.version) for rule in rules])
    entries.select(
        "blob", F.get(kinds, F.col("rule")).alias("kind"), F.get(numbers, F.col("rule")).alias("rule_version"), "spans"
    ).write.mode("append").parquet(ledger)

    place = F.array_position(F.array(*wanted), F.concat_ws("/", "kind", "rule_version")) - 1
    current = spark.read.schema(LEDGER).parquet(ledger).withColumn("place", place).filter("place >= 0")
    # Runs beside each other may both have scanned a blob.
    current = current.dropDuplicates(["blob", "place"])
    with_any = current.filter(F.size("spans") > 0).select("blob", "place", "kind", F.explode("spans").alias("span"))
    findings = with_any.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("span.start", "place", "kind", "span.end"))).alias("spans")
    )
    empty = F.array().cast("array<struct<start: bigint, place: bigint, kind: string, end: bigint>>")
    return held.select("path", "version", "blob").join(findings, "blob", "left").select(
        "path", "version", "blob", F.coalesce("spans", empty).alias("spans")
    )


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def findings(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """``scan`` over documents (doc_id, text), each the only version of its path."""
    versions = docs.select(F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text")
    return scan(versions, ledger or scratch(docs.sparkSession, "ledger"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span, or run of overlapping ones, replaced by ``mark``; n_chars follows the text.

    Rows are matched by their text, so null and repeated doc_ids are redacted as well. Null texts stay null. Columns of any
    other names stay as they are.
    """
    name, spans, held = free_names(docs, "blob", "spans", "state")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blob = F.unhex(F.sha2(text.cast("binary"), 256))
    found = (
        findings(docs).filter(F.size("spans") > 0).select(F.col("blob").alias(name), F.col("spans").alias(spans))
    )
    found = found.dropDuplicates([name])
    # The furthest end before each span, and the mark where a span begins beyond it.
    reach = "array<struct<from: bigint, start: bigint>>"
    state = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("end"), F.array().cast(reach).alias("cuts")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            F.when(
                (s["start"] >= acc["end"]) , F.concat(acc["cuts"], F.array(F.struct(acc["end"].alias("from"), s["start"].alias("start"))))
            ).otherwise(acc["cuts"]).alias("cuts"),
        ),
    )
    kept = F.transform(
        F.col(held)["cuts"],
        lambda c: F.concat(F.substring(F.col("text"), c["from"].cast("int") + 1, (c["start"] - c["from"]).cast("int")), F.lit(mark)),
    )
    rest = F.substring(F.col("text"), F.col(held)["end"].cast("int") + 1, F.lit(2**31 - 1))
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), rest))
    out = docs.withColumn(name, blob).join(found, name, "left").withColumn(held, state)
    out = out.withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select([F.col(f"`{column}`") for column in docs.columns])

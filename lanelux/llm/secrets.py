"""Secret scans with an incremental ledger of text versions.

Every version of a document is a blob named by the SHA-256 of its text. The ledger has a row
for each blob and rule version that was scanned, with what was found. A scan looks at pairs of
blob and rule version that the ledger does not have, adds them, and joins what the ledger knows
back to every path (document) that has the blob. All of it is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.llm.common import table
from lanelux.session import scratch_path, settle


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern``, kept if ``group`` has ``least`` characters or more.

    A changed rule gets a new version, so all blobs are unseen for it.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


# The three rules of the contract.
ASSIGN = Rule(
    "assign",
    1,
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    group=2,
    least=8,
)
ACCESS = Rule("access", 1, r"AKIA[A-Z0-9]+", least=16)
#: A run of 32 or more: the same spans as all runs of which the short ones are dropped.
HEX = Rule("hex", 1, r"[0-9a-f]{32,}", least=32)
BASE = (ASSIGN, ACCESS, HEX)
#: Rules beyond the base.
JWT = Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")
#: A whole key: header fields and base64 to its last line, or without one the base64 lines that follow. The text of a
#: key holds no sign that begins another, so each place is read once.
WHOLE_KEY = Rule(
    "pem",
    3,
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
    r"""(?:(?:[\x20\t]*\r?\n[A-Za-z][A-Za-z0-9-]{0,40}:[^\r\n]{0,100}){0,8}[A-Za-z0-9+/=\x20\t\r\n,>#*|"'\\]*?"""
    r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----|(?:[\x20\t\r\n]++[A-Za-z0-9+/=]{20,}+)*+)",
)
RULES = (*BASE, WHOLE_KEY, JWT)

_FIELD = r"[A-Za-z][A-Za-z0-9-]{0,40}+:(?:(?!-----)[^\r\n\\])*+"
_TRAIL = r"""[\x20\t"',;+]*+"""
_BREAK = rf"""{_TRAIL}(?:(?:\\+[rn])++|\r\n?|\n)[\x20\t>#*|"']*+"""
_BASE64 = r"[A-Za-z0-9+/=]"
#: What a private key leaves to hide: from its first line over fields and base64 to its last line. Without a last
#: line, fields and then base64 lines (real or escaped line breaks), or base64 that goes on in the same line.
KEY = Rule(
    "pem",
    2,
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
    rf"""(?:(?:{_FIELD}|[A-Za-z0-9+/=\s>#*|"',;\\])*+-----END [A-Z0-9 ]{{0,40}}PRIVATE KEY(?: BLOCK)?-----"""
    rf"|(?:(?:[\x20\t]*+{_BASE64}{{20,}}+)++(?:[\x20\t]++{_BASE64}++(?=\s|\z))?)?"
    rf"(?:{_BREAK}{_FIELD})*+(?:(?:{_BREAK})++{_BASE64}++(?={_TRAIL}(?:[\r\n\\]|\z)))*+)",
)
#: Rules of ``redact``, which also take keys in quoted and commented lines without a last one.
REDACTED = (*BASE, KEY, JWT)

LEDGER = {"blob": "binary", "kind": "string", "version": "int", "spans": "array<struct<start:bigint,end:bigint>>"}
_SCHEMA = ", ".join(f"{n} {t}" for n, t in LEDGER.items())


def spans(text: Column, rule: Rule) -> Column:
    """The rule's spans in a text, as code points, end exclusive: an array of (start, end), null without a match.

    The text is split at the matches, so lengths of the pieces and the matches give the places.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    sized = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    pieces = F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("b"), F.length(m).alias("m")))
    empty = F.array().cast("array<struct<start:long,end:long>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def step(state, piece):
        at = state["at"] + piece["b"]
        end = at + F.coalesce(piece["m"], F.lit(0))
        own = F.array(F.struct(at.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct(end.cast("long").alias("at"), F.concat(state["out"], own).alias("out"))

    placed = F.aggregate(F.slice(pieces, F.lit(1), F.size(found)), start, step, lambda s: s["out"])
    kept = F.filter(
        F.zip_with(placed, sized, lambda p, g: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.length(g).alias("n"))),
        lambda x: x["n"] >= rule.least,
    )
    plain = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return F.when(F.regexp_like(text, pattern), plain)


def blobs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text`` (null: empty) and ``_blob``, the SHA-256 of it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("_text", text).withColumn("_blob", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)))


def open_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """The ledger at ``path``; an empty one if there is none yet."""
    if path:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(hadoop):
            return spark.read.schema(_SCHEMA).parquet(path)
    return spark.range(0).select(*(F.lit(None).cast(t).alias(n) for n, t in LEDGER.items()))


def update_ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, path: str | None = None) -> DataFrame:
    """Scan blobs of ``docs`` (doc_id, text) that the ledger at ``path`` has not seen under ``rules``; returns the ledger.

    Each unseen blob is scanned once, in one of the rows that have it, and only by the rules that
    have not seen it. New entries are appended in one write, which a lost executor does not spoil.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "secret-ledger")
    named = blobs(docs.select("doc_id", "text"))
    # a row is told from others with its text by a hash of its id; rows with equal ids and texts are equal
    place = F.xxhash64("doc_id")
    keys = named.select("_blob", place.alias("_place"))
    first = keys.groupBy("_blob").agg(F.min("_place").alias("_place"))
    pairs = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    seen = open_ledger(spark, path).select("blob", "kind", "version")
    seen = seen.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("_seen"))  # one entry per rule version
    unseen = first.join(seen, first["_blob"] == seen["blob"], "left").drop("blob")
    unseen = unseen.withColumn("_rules", F.array_except(pairs, F.coalesce("_seen", F.array().cast(seen.schema["_seen"].dataType))))
    unseen = settle(unseen.where(F.size("_rules") > 0).select("_blob", "_place", "_rules"), "unseen-blobs")
    texts = named.select("_blob", place.alias("_place"), "_text")
    scanned = texts.join(unseen.hint("shuffle_hash"), ["_blob", "_place"])
    entries = F.array(
        *(
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("version"),
                F.when(F.array_contains("_rules", F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))), spans(F.col("_text"), r)).alias("spans"),
            )
            for r in rules
        )
    )
    rows = scanned.select("_blob", "_rules", entries.alias("_entries"))
    rows = rows.select("_blob", "_rules", F.explode("_entries").alias("e"))
    rows = rows.where(F.array_contains("_rules", F.struct("e.kind", "e.version")))
    rows.select(F.col("_blob").alias("blob"), "e.kind", "e.version", "e.spans").write.mode("append").parquet(path)
    return spark.read.schema(_SCHEMA).parquet(path)


def found(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``_found``: an array of (start, kind, end) by start and then the order of ``rules``; null without a span."""
    order = {(r.kind, r.version): k for k, r in enumerate(rules)}
    known = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(v).alias("version"), F.lit(n).alias("n")) for (k, v), n in order.items()))
    hits = ledger.where("spans is not null and size(spans) > 0").distinct()
    hits = hits.withColumn(
        "n", F.get(F.filter(known, lambda x: (x["kind"] == F.col("kind")) & (x["version"] == F.col("version"))), F.lit(0))["n"]
    )
    hits = hits.where("n is not null")
    each = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("n").alias("n"), F.col("kind"), s["end"].alias("end")))
    per_blob = hits.select("blob", each.alias("own")).groupBy("blob")  # one row per rule
    per_blob = per_blob.agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("_found"))
    named = blobs(docs).drop("_text")
    per_blob = per_blob.select(F.col("blob").alias("_of"), "_found")
    return named.join(per_blob, F.col("_blob") == F.col("_of"), "left").drop("_of", "_blob")


def _joined(spans_: Column) -> Column:
    empty = F.array().cast("array<struct<start:long,n:int,kind:string,end:long>>")
    return F.array_join(
        F.transform(F.coalesce(spans_, empty), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, path: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts of base spans, a digest of them, and all spans.

    A null text is empty; empty texts have no spans. Repeated rows and null ids stay, and rows with
    the same text have the same spans. An empty table gives no rows. Other columns are not read.
    """
    ledger = update_ledger(docs, rules, path)
    rows = found(docs.select("doc_id", "text"), ledger, rules)
    base = F.filter("_found", lambda s: s["kind"].isin([r.kind for r in BASE]))
    count = lambda kind: F.coalesce(F.size(F.filter("_found", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")
    return rows.select(
        "doc_id",
        *(count(r.kind).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("_found")).alias("spans"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = REDACTED, path: str | None = None, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by ``mark`` (spans that overlap or touch by one) and n_chars, if there, renewed."""
    ledger = update_ledger(docs, rules, path)
    rows = found(docs, ledger, rules)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state, span):
        more = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        new = span["start"] > state["at"]
        first = (state["at"] == 0) & (span["start"] == 0)
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(new | first, F.concat(state["out"], F.when(new, more).otherwise(F.lit("")), F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    clean = F.aggregate(
        F.col("_found"), start, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.length("text")))
    )
    out = rows.withColumn("text", F.when(F.col("_found").isNotNull(), clean).otherwise(F.col("text"))).drop("_found")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(docs.columns)


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spans of secrets in all documents, by a new ledger."""
    return report(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH rules(ord, kind, pattern, grp, least) AS (VALUES
    (0, 'assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
    (1, 'access', 'AKIA[A-Z0-9]+', 0, 16),
    (2, 'hex', '[0-9a-f]+', 0, 32),
    (3, 'pem', '-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----'
      || '(?:(?:[\x20\t]*\r?\n[A-Za-z][A-Za-z0-9-]{0,40}:[^\r\n]{0,100}){0,8}[A-Za-z0-9+/=\x20\t\r\n,>#*|"''\\]*?'
      || '-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----|(?:[\x20\t\r\n]+[A-Za-z0-9+/=]{20,})*)', 0, 1),
    (4, 'jwt', 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}', 0, 1)
), d AS (
    SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
    SELECT place, 0 AS ord, regexp_extract_all(t, (SELECT pattern FROM rules WHERE ord = 0), 0) AS found,
           regexp_extract_all(t, (SELECT pattern FROM rules WHERE ord = 0), 2) AS sized,
           string_split_regex(t, (SELECT pattern FROM rules WHERE ord = 0)) AS pieces FROM d
    UNION ALL
    SELECT place, ord, regexp_extract_all(t, pattern, 0), regexp_extract_all(t, pattern, 0), string_split_regex(t, pattern)
    FROM d CROSS JOIN rules WHERE ord > 0
), k AS (
    SELECT *, unnest(range(1, len(found) + 1)) AS k FROM m
), s AS (
    SELECT k.place, k.ord, rules.kind,
           (list_sum(list_transform(pieces[:k], lambda x: len(x))) + coalesce(list_sum(list_transform(found[:k - 1], lambda x: len(x))), 0))::BIGINT AS a,
           len(found[k]) AS n
    FROM k JOIN rules USING (ord) WHERE len(sized[k]) >= rules.least
), g AS (
    SELECT place, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
           string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, ord) FILTER (ord < 3) AS base,
           string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, ord) AS spans
    FROM s GROUP BY place
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (place)
"""

"""Quality rules: one ledger of measurements and failure bits, many policies over it.

Every rule is evaluated once per document. The ledger keeps what was measured and one
bit per failed rule; a policy is a named and numbered mask of rules, so a changed policy
or an ablation reads the ledger and no text. The ledger also keeps each rule's version: a bit
of another version than the rule in force is made again from the measurements.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.llm.common import steps, table
from lanelux.session import settle

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alpha_words")
_SYMBOLS = b"#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """A rule's bit is its place in ``RULES``; ``fails`` is a condition on the measurements.

    A changed condition gets the next version, so bits of the one before are not taken for its own.
    """

    name: str
    fails: str
    version: int = 1


#: Rules are only ever added at the end, so a stored bit keeps its meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 2 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 16 * n_words"),
    Rule("few_letters", "10 * n_alpha_words < 6 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A document is kept if none of the policy's rules failed."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask(self.rules)


def mask(rules: tuple[str, ...]) -> int:
    place = {r.name: k for k, r in enumerate(RULES)}
    return sum(1 << place[name] for name in rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))


def measure(text: str | None) -> tuple[int, ...]:
    """``MEASURES`` of a whole text; all zero for a null or empty one."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode()
    words = raw.split()
    n = len(words)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    alpha = np.fromiter((w.isalpha() or any(c.isalpha() for c in w.decode()) for w in known), bool, len(known))
    repeated = 0
    if n > _WINDOW:
        # two steps of renumbering keep the numbers of windows exact for any number of words
        pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
        _, window, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
        again = counts[window] > 1
        covered = np.zeros(n, bool)
        for k in range(_WINDOW):
            covered[k : n - _WINDOW + 1 + k] |= again
        repeated = int(covered.sum())
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (
        n,
        len(text) - sum(map(text.count, _SPACES)),
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        int(alpha[ids].sum()) if n else 0,
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text"):
        rows = np.array([measure(t) for t in batch["text"].to_pylist()], np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(rows[:, k]) for k in range(len(MEASURES)))], ["doc_id", *MEASURES]
        )


def failures(rules: tuple[Rule, ...] = RULES) -> Column:
    """One long with a bit for each rule that fails."""
    return _joined([F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(rules)])


def _joined(bits: list[Column]) -> Column:
    whole = bits[0]
    for bit in bits[1:]:
        whole = whole.bitwiseOR(bit)
    return whole.cast("long")


def _versions(rules: tuple[Rule, ...]) -> Column:
    return F.array(*(F.lit(r.version) for r in rules))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, ``MEASURES``, ``failed`` (bits of ``rules``) and ``versions`` (of the rules) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no words and zero measurements. Repeated rows and null ids stay. An
    empty table gives no rows. Other columns are not read. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInArrow(_measured, schema).withColumns({"failed": failures(rules), "versions": _versions(rules)})


def in_force(entries: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with the bits of ``rules``: stored ones of the same version, the others made from the measurements.

    Rules that were added since the entry was stored are among the others. No text is read.
    """
    bits = []
    for k, r in enumerate(rules):
        stored = F.col("failed").bitwiseAND(F.lit(1 << k).cast("long"))
        now = F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
        bits.append(F.when(F.get("versions", F.lit(k)) == r.version, stored).otherwise(now))
    return entries.withColumns({"failed": _joined(bits), "versions": _versions(rules)})


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the policy's ``kept``, name and version, by the rules in force."""
    return in_force(entries, RULES).withColumns(
        {
            "kept": F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")) == 0,
            "policy": F.lit(policy.name),
            "policy_version": F.lit(policy.version),
        }
    )


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents it fails, and those it alone fails (kept again without it)."""
    failed = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long"))
    counted = in_force(entries, RULES).groupBy(failed.alias("bits")).agg(F.count(F.lit(1)).alias("n"))  # at most one row per set of rules
    rules = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(mask((name,))).cast("long").alias("bit")) for name in policy.rules))
    each = counted.select("bits", "n", F.explode(rules).alias("r"))
    own = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("n_alone"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standard policy over the stored ledger of all documents."""
    entries = settle(ledger(table(spark, sf_dir, "documents")), "quality-ledger")
    base = F.col("failed").bitwiseAND(F.lit(BASE.mask).cast("long")) != 0
    return apply_policy(entries, STANDARD).select(
        "doc_id", *MEASURES[:5], base.alias("base_failed"), "kept", "failed"
    )


OP8_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), i AS (
    SELECT place, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2
), g AS (
    SELECT place, i, count(*) OVER (PARTITION BY place, w[i], w[i + 1], w[i + 2]) AS n FROM i
), r AS (
    SELECT place, count(DISTINCT i + k) AS n_repeat_words FROM g, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY place
), m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(lines) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_alpha_words
    FROM d LEFT JOIN r USING (place)
), f AS (
    SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
        + 8 * (n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines)::INT
        + 16 * (word_chars < 2 * n_words OR word_chars > 16 * n_words)::INT + 32 * (10 * n_alpha_words < 6 * n_words)::INT)::BIGINT AS failed
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
FROM f
"""

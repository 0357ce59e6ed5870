"""URL filter: rules first, then a character language-model ratio.

URLs that rules allow or block are the accepted and rejected text of two variable-order
Markov models over bytes. Counts of contexts and of contexts with the next byte are added up
over all such URLs in a table with one row per n-gram, which grows with the URLs; the probability
of a byte mixes all orders, each smoothed towards the next lower one. URLs are scored in blocks:
the different n-grams of a block are joined to the table, and what is found goes back to the block.
A URL's score is the difference of its log likelihoods per byte. The threshold is set on a fifth of
the ruled URLs that was not counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanelux.llm.common import steps, table
from lanelux.session import settle


@dataclass(frozen=True)
class Rule:
    """``place`` is a host, a slash and the start of a path; it fits the host and all subdomains."""

    verdict: str
    place: str


# The rules of the contract.
RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)
ALLOW, BLOCK = "allow", "block"
ORDER = 5
#: Bytes of URLs in a block.
BLOCK_BYTES = 1 << 19
#: Weight of the lower order in counts.
PRIOR = 4.0
HELD_OUT = 5
BINS, WIDEST = 2000, 4.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url and one without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The number of the longest rule that fits (of equals: a block before an allow), or null."""
    out = F.lit(None).cast("int")
    order = sorted(range(len(rules)), key=lambda k: (len(rules[k].place), rules[k].verdict == BLOCK))
    for k in order:
        name, _, start = rules[k].place.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        out = F.when(fits, F.lit(k)).otherwise(out)
    return out


def _symbols(urls: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all URLs as numbers from 1, the URLs they belong to, and their places in these.

    A-Z are lower-cased and digits are one letter, so numbers weigh as numbers. The end of a URL is a
    byte of its own.
    """
    digits = bytes.maketrans(b"123456789" + _UPPER.encode(), b"000000000" + _LOWER.encode())
    raw = [u.encode().translate(digits) + b"\n" for u in urls]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(raw)), sizes)
    return data, owner, np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _grams(urls: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all bytes of all URLs: the keys of their contexts and of contexts with the byte, per order; owners.

    A key is exact: nine bits a byte, the last byte lowest (0 in a context), and the order above them.
    """
    data, owner, place = _symbols(urls)
    packed = np.zeros(len(data), np.uint64)
    contexts, joints = [], []
    for k in range(ORDER + 1):
        if k:
            packed = packed | (np.where(place >= k, np.roll(data, k), np.uint64(0)) << np.uint64(9 * k))
        contexts.append(packed | np.uint64(k << 9 * (ORDER + 1)))
        joints.append(contexts[-1] | data)
    return np.array(contexts, np.int64), np.array(joints, np.int64), owner


def _ratios(counts: Callable[[int], tuple[np.ndarray, np.ndarray]], owner: np.ndarray, n: int) -> np.ndarray:
    """Scores of ``n`` URLs; ``counts`` gives an order's counts of contexts and joints, per class and byte."""
    chance = np.full((2, len(owner)), 1 / 257)
    for k in range(ORDER + 1):
        seen, both = counts(k)
        chance = (both + PRIOR * chance) / (seen + PRIOR)
    logs = np.log(chance)
    return np.bincount(owner, logs[1] - logs[0], n) / np.maximum(1, np.bincount(owner, minlength=n))


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with ``_block``: neighbours in a task, at most ``BLOCK_BYTES`` of URLs or one URL."""
    first = TaskContext.get().partitionId() << 32
    for k, batch in enumerate(steps(batches, "url", BLOCK_BYTES)):
        block = pa.array(np.full(batch.num_rows, first + k, np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns, block], [*batch.schema.names, "_block"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different n-grams of a few URLs at a time, with their counts."""
    for batch in steps(batches, "url", BLOCK_BYTES):
        contexts, joints, owner = _grams(batch["url"].to_pylist())
        allowed = np.asarray(batch["allowed"])[owner]
        for own, kind in ((allowed, True), (~allowed, False)):
            keys, n = np.unique(np.concatenate([contexts[:, own], joints[:, own]], axis=None), return_counts=True)
            none = np.zeros(len(n), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n if kind else none), pa.array(none if kind else n)], ["key", "allowed", "blocked"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different n-grams of each block (again if a block comes in several batches)."""
    for batch in steps(batches, "url", BLOCK_BYTES):
        blocks = np.asarray(batch["_block"])
        for block in np.unique(blocks).tolist():
            urls = batch["url"].filter(pa.array(blocks == block))
            keys = np.unique(np.concatenate(_grams(pc.fill_null(urls, "").to_pylist())[:2], axis=None))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(keys)], ["_block", "key"])


def _scored(rows: pa.Table, found: pa.Table) -> pa.Table:
    """A block's rows with their scores, from the counts of its n-grams."""
    keys = found["key"].to_numpy()
    order = np.argsort(keys)
    keys = np.append(keys[order], np.iinfo(np.int64).max)
    numbers = np.array([np.append(found[c].to_numpy()[order], 0) for c in ("blocked", "allowed")])
    urls = pc.fill_null(rows["url"], "").to_pylist()
    contexts, joints, owner = _grams(urls)

    def counted(wanted):
        at = np.searchsorted(keys, wanted)
        return np.where(keys[at] == wanted, numbers[:, at], 0)

    scores = _ratios(lambda k: (counted(contexts[k]), counted(joints[k])), owner, len(urls))
    return rows.append_column("_score", pa.array(scores))


def _with_scores(rows: DataFrame, model: DataFrame) -> DataFrame:
    """``rows`` (url, _block and others) with ``_score``."""
    asked = rows.select("_block", "url").mapInArrow(_asked, "_block long, key long")
    found = asked.join(model.hint("merge"), "key").select("_block", "key", "allowed", "blocked")
    schema = T.StructType([*rows.schema.fields, T.StructField("_score", T.DoubleType())])
    return rows.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(_scored, schema)


def fit(labelled: DataFrame) -> tuple[DataFrame, float] | None:
    """Model and threshold from all rows of ``labelled`` (url, allowed, _block); None if a class has no row.

    The model has a row per n-gram: key, allowed, blocked. Only the bins of the scores come to the driver.
    """
    rows = labelled.where("url is not null and url <> ''")
    rows = rows.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0)
    counted = rows.where("not held").select("url", "allowed").mapInArrow(_counted, "key long, allowed long, blocked long")
    model = settle(counted.groupBy("key").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")), "url-counts")
    both = model.agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked")).first()
    if not both["allowed"] or not both["blocked"]:
        return None
    scored = _with_scores(rows.where("held").select("url", "allowed", "_block"), model)
    bins = F.least(F.greatest(F.floor((F.col("_score") + WIDEST) / (2 * WIDEST) * BINS), F.lit(0)), F.lit(BINS - 1))
    table_ = np.zeros((2, BINS))
    for r in scored.groupBy("allowed", bins.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect():
        table_[int(r["allowed"]), r["bin"]] = r["n"]
    shares = table_ / np.maximum(1, table_.sum(axis=1, keepdims=True))
    # accepted URLs under the threshold and rejected ones over it, each as a share of its class
    wrong = np.concatenate([[0], np.cumsum(shares[1])]) + 1 - np.concatenate([[0], np.cumsum(shares[0])])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    middle = float(best[0] + best[-1]) / 2 if table_.sum() else BINS / 2
    return model, middle / BINS * 2 * WIDEST - WIDEST


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict and score (null where a rule decides).

    Without a rule that fits, a URL is blocked if its score is under the threshold. If no URL is
    blocked (or none allowed) by rules, there is no model, and all others are allowed. A null or
    empty URL is blocked. Repeated rows and null ids stay. An empty table gives no rows. Other
    columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rows = rows.withColumn("_rule", ruled(F.col("host"), F.col("path"), rules))
    rows = settle(rows.mapInArrow(_blocked, T.StructType([*rows.schema.fields, T.StructField("_block", T.LongType())])), "ruled-urls")
    verdicts = F.array(*(F.lit(r.verdict) for r in rules)) if rules else F.array().cast("array<string>")
    places = F.array(*(F.lit(r.place) for r in rules)) if rules else F.array().cast("array<string>")
    verdict = F.get(verdicts, F.col("_rule"))
    fitted = fit(rows.where("_rule is not null").select("url", (verdict == ALLOW).alias("allowed"), "_block")) if rules else None
    if fitted:
        model, threshold = fitted
        decided = rows.where("_rule is not null").withColumn("_score", F.lit(None).cast("double"))
        scored = _with_scores(rows.where("_rule is null"), model).unionByName(decided)
        own = F.when(F.col("_score") < threshold, BLOCK).otherwise(ALLOW)
    else:
        scored, own = rows.withColumn("_score", F.lit(None).cast("double")), F.lit(ALLOW)
    own = F.when(F.coalesce(F.col("url"), F.lit("")) == "", F.lit(BLOCK)).otherwise(own)
    return scored.select(
        "page_id",
        "host",
        "path",
        F.get(places, F.col("_rule")).alias("rule"),
        F.coalesce(verdict, own).alias("verdict"),
        F.when(F.col("_rule").isNull(), F.col("_score")).alias("score"),
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    return judge(table(spark, sf_dir, "pages"))

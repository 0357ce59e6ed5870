"""Ranked lexical search by presence masks.

A query's documents fall into groups by the set of its terms that they hold, written as a bit mask.
All documents of a mask share a largest possible score, the sum of their terms' largest shares, so
masks are taken by falling bounds and their documents scored until no further mask can reach the
query's k-th score.

Queries come in blocks of bounded vocabulary. For each block one pass over the documents stores
postings of the block's terms, in blocks of documents; sums over them give the corpus statistics
(over all documents); a second pass over the postings ranks within blocks of documents. Only the
best rows of each task are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanelux.llm.common import sized, steps, table
from lanelux.llm.runs import LOWER, UPPER, runs, text_bytes
from lanelux.session import settle

#: Fixed value: the terms of the contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 10
#: Documents and postings in a block, different terms in a block of queries (on average), documents scored at first.
BLOCK_DOCS, BLOCK_POSTINGS, BLOCK_TERMS, FIRST_DOCS = 32_768, 4 << 20, 50_000, 64

_INSIDE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])

_BLOCK = pa.schema(
    [
        ("n_docs", pa.int64()),
        ("n_terms", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.int32())),
        ("docs", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int64())),
    ]
)
_BLOCK_DDL = "n_docs long, n_terms long, ids array<long>, sizes array<long>, terms array<int>, docs array<int>, counts array<long>"
_BEST = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: Column) -> Column:
    """The different terms of a text, sorted; none for null."""
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))
    return F.coalesce(F.array_sort(F.array_distinct(found)), F.array().cast("array<string>"))


def _postings(batches: Iterator[pa.RecordBatch], vocabulary: list[str]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: how many have a term, all their terms, and the postings of ``vocabulary``.

    Postings are sorted by term and document. Documents without a term of the vocabulary count but are not listed.
    """
    known = pa.array([t.encode() for t in vocabulary], pa.large_binary())
    parts: list[tuple] = []
    listed = posted = n_docs = n_terms = 0

    def block() -> pa.RecordBatch:
        ids = pa.concat_arrays([p[0] for p in parts]) if parts else pa.array([], pa.int64())
        sizes, terms, docs, counts = (
            np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(1, 5)
        )
        order = np.argsort(terms, kind="stable")
        columns = (ids, sizes, terms[order].astype(np.int32), docs[order].astype(np.int32), counts[order])
        lists = [
            pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c, _BLOCK.field(k + 2).type.value_type))
            for k, c in enumerate(columns)
        ]
        return pa.RecordBatch.from_arrays([pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()), *lists], schema=_BLOCK)

    for batch in steps(batches, "text"):
        data, bounds = text_bytes(batch["text"])
        words = runs(data, bounds, _INSIDE[data])
        sizes = np.bincount(words.row, minlength=batch.num_rows)
        n_docs, n_terms = n_docs + int(np.count_nonzero(sizes)), n_terms + int(sizes.sum())
        term = pc.index_in(words.array(), value_set=known)
        hit = term.is_valid().to_numpy(zero_copy_only=False)
        term = term.drop_null().to_numpy().astype(np.int64)
        pairs, counts = np.unique(words.row[hit] * len(known) + term, return_counts=True)
        row, term = np.divmod(pairs, max(1, len(known)))
        with_hit, doc = np.unique(row, return_inverse=True)
        parts.append((batch["doc_id"].take(pa.array(with_hit)), sizes[with_hit], term, doc + listed, counts))
        listed, posted = listed + len(with_hit), posted + len(pairs)
        if listed >= BLOCK_DOCS or posted >= BLOCK_POSTINGS:
            yield block()
            parts, listed, posted, n_docs, n_terms = [], 0, 0, 0, 0
    if n_docs:
        yield block()


def _list(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch[name][row].values.to_numpy(zero_copy_only=False)


def _frequencies(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """How many documents of the task's blocks hold each term."""
    own = np.zeros(n_terms, np.int64)
    for batch in batches:
        for row in range(batch.num_rows):
            own += np.bincount(_list(batch, "terms", row), minlength=n_terms)
    held = np.flatnonzero(own)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(own[held], pa.int64())], ["term", "df"])


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, terms of all documents, and the weight of each term of the vocabulary."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    def share(self, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What a weight is multiplied with: grows with the term's count and falls with the document's size."""
        m = 100 - 90 + 90 * sizes * self.n_docs // self.n_terms
        return 1_000_000_000 * counts // (1000 * counts + 8 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def masks(places: list[np.ndarray], n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents that hold any of the terms, grouped by the mask of terms that they hold.

    ``places`` has the documents of each term. Returns the different masks (rows of 64-bit words), the
    documents ordered by mask, and where each mask's documents begin (one more than masks).
    """
    mask = np.zeros((n_docs, max(1, -(-len(places) // 64))), np.uint64)
    for t, docs in enumerate(places):
        mask[docs, t // 64] |= np.uint64(1 << (t % 64))
    held = np.flatnonzero(mask.any(axis=1))
    mask = np.ascontiguousarray(mask[held])
    keys = mask[:, 0] if mask.shape[1] == 1 else mask.view(np.dtype((np.void, 8 * mask.shape[1]))).ravel()
    _, at, group, sizes = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return mask[at], held[np.argsort(group, kind="stable")], np.concatenate([[0], np.cumsum(sizes)])


def _best(ids: np.ndarray, null: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id, null ids last."""
    order = np.lexsort((ids, null, -scores))
    return order[: k or None]


class Block:
    """Postings of a block of documents; ranks a query by its masks."""

    def __init__(self, batch: pa.RecordBatch, row: int, statistics: Statistics):
        ids = batch["ids"][row].values
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.sizes, self.docs, self.counts = (_list(batch, name, row) for name in ("sizes", "docs", "counts"))
        self.terms, starts = np.unique(_list(batch, "terms", row), return_index=True)
        self.starts = np.append(starts, len(self.docs))
        self.statistics = statistics
        #: The largest share of each term: its largest count in the smallest of its documents bounds all.
        most = np.maximum.reduceat(self.counts, starts) if len(starts) else np.zeros(0, np.int64)
        least = np.minimum.reduceat(self.sizes[self.docs], starts) if len(starts) else np.zeros(0, np.int64)
        self.tops = statistics.weights[self.terms] * statistics.share(most, least)

    def rank(self, query: np.ndarray, best: tuple[np.ndarray, np.ndarray, np.ndarray], k: int):
        """``best`` (ids, null, scores) with this block's documents added; also how many documents were scored."""
        at = np.searchsorted(self.terms, query)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)] if len(self.terms) else at[:0]
        at = at[self.tops[at] > 0]
        spans = [(self.starts[t], self.starts[t + 1]) for t in at.tolist()]
        if not spans:
            return best, 0
        found, docs, starts = masks([self.docs[a:b] for a, b in spans], len(self.ids))
        bounds = np.zeros(len(found), np.int64)
        for t, top in enumerate(self.tops[at].tolist()):
            bounds += top * ((found[:, t // 64] >> np.uint64(t % 64)) & np.uint64(1)).astype(np.int64)
        order = np.argsort(-bounds, kind="stable")
        sizes = np.diff(starts)[order]
        done, take, scored = 0, FIRST_DOCS, 0
        while done < len(order) and (len(best[2]) < k or bounds[order[done]] >= best[2][-1]):
            end = done + max(1, int(np.searchsorted(np.cumsum(sizes[done:]), take, "right")))
            own = np.sort(np.concatenate([docs[starts[g] : starts[g + 1]] for g in order[done:end].tolist()]))
            scores = np.zeros(len(own), np.int64)
            for (a, b), term in zip(spans, self.terms[at].tolist(), strict=True):
                place = np.searchsorted(self.docs[a:b], own)
                there = place < b - a
                there[there] = self.docs[a + place[there]] == own[there]
                share = self.statistics.share(self.counts[a + place[there]], self.sizes[own[there]])
                scores[there] += self.statistics.weights[term] * share
            own, scores = own[scores > 0], scores[scores > 0]
            joined = tuple(np.concatenate(x) for x in zip(best, (self.ids[own], self.null[own], scores), strict=True))
            top = _best(*joined, k)
            best = tuple(x[top] for x in joined)
            done, take, scored = end, 2 * take, scored + len(own)
        return best, scored


def _rank(batches: Iterator[pa.RecordBatch], queries: list[np.ndarray], statistics: Statistics, k: int):
    """The task's k best documents of each query."""
    best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in queries]
    for batch in batches:
        for row in range(batch.num_rows):
            block = Block(batch, row, statistics)
            for number, query in enumerate(queries):
                best[number], _ = block.rank(query, best[number], k)
    numbers = np.repeat(np.arange(len(best), dtype=np.int32), [len(b[0]) for b in best])
    ids, null, scores = (np.concatenate([b[i] for b in best]) if best else np.zeros(0, np.int64) for i in range(3))
    yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(scores)], schema=_BEST)


def _ranked(docs: DataFrame, queries: list[list[str]], k: int) -> DataFrame:
    """For queries of one block (lists of different terms): query (place in the list), doc_id, score, k of each task."""
    vocabulary = sorted({t for q in queries for t in q})
    number = {t: i for i, t in enumerate(vocabulary)}
    blocks = settle(docs.mapInArrow(partial(_postings, vocabulary=vocabulary), _BLOCK_DDL), "postings")
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    counted = blocks.select("terms").mapInArrow(partial(_frequencies, n_terms=len(vocabulary)), "term int, df long")
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in counted.groupBy("term").agg(F.sum("df")).collect():  # as many rows as the block has terms
        weights[term] = weight(n_docs, df)
    own = [np.array(sorted(number[t] for t in q), np.int64) for q in queries]
    rank = partial(_rank, queries=own, statistics=Statistics(n_docs, n_terms, weights), k=k)
    return blocks.mapInArrow(rank, "query int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents (doc_id, text) for each row of ``items`` (item_id, text): item_id, rank, doc_id, score.

    All documents with a term are searched and count; null and empty texts have none. Equal scores go
    by rising doc_id, null ids last; repeated rows are documents of their own. Items with the same text
    are searched once and each get the rows; a null item_id is an item; an item without a term gets none.
    An empty table on either side gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = settle(items.select("item_id", F.col("text").cast("string").alias("_text")), "items")
    asked = items.select("_text").distinct().withColumn("_terms", terms_of(F.col("_text"))).where("size(_terms) > 0")
    asked = settle(asked, "queries")
    total = asked.agg(F.sum(F.size("_terms"))).first()[0] or 0
    blocks = -(-total // block_terms)
    best = spark.createDataFrame([], "_text string, doc_id long, score long")
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("_text"), F.lit(blocks)) == block).collect()  # bounded by block_terms
        if own:
            texts = spark.createDataFrame([(n, r["_text"]) for n, r in enumerate(own)], "query int, _text string")
            found = settle(_ranked(docs, [r["_terms"] for r in own], k), "found")
            best = best.unionByName(found.join(texts, "query").select("_text", "doc_id", "score"))
    place = Window.partitionBy("_text").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return items.join(top, "_text").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each item of the benchmark."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH found AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
held AS (SELECT d, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM found WHERE len(t) > 0),
corpus AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM held),
items AS (
  SELECT row_number() OVER () AS i, item_id,
    list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
asked AS (SELECT i, item_id, unnest(t) AS term FROM items),
words AS (SELECT d, doc_id, n, unnest(t) AS term FROM held),
postings AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM words
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term),
scored AS (
  SELECT i, item_id, d, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY ALL),
placed AS (
  SELECT item_id, doc_id, score,
    CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""

"""Exact top-k search by inner product, a block of vectors at a time.

A term is a dimension and a sign, so all weights are positive and a block's largest weight
of each term bounds what a query can score in it: the sum over the query's terms. For each
query, blocks are taken in the order of these bounds and scored through the block's vectors
until the next bound falls below the query's k-th score.

Vectors are ordered so that similar ones share blocks, which makes bounds tight; blocks are
ranges of that order. Ranges of blocks are table rows. Queries are first scored in the range
that holds themselves, which gives each a k-th score to start from. Batches of queries then meet
a small table of block maxima, and only the queries that a range's bounds leave go to its vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanelux.llm.common import parallelism, table
from lanelux.session import settle

SCALE = 256
#: Vectors in a block, bytes of vectors in a range of blocks, and bytes of queries in a batch.
BLOCK, RANGE_BYTES, BATCH_BYTES = 128, 4 << 20, 1 << 20
#: Bytes of block maxima in a row, and about how many batches of queries share one copy of a range.
MAXIMA_BYTES, SHARED = 4 << 20, 8
#: Scores up to here are whole numbers that doubles hold exactly.
EXACT = float(1 << 53)
LONGEST = (1 << 63) - 1


def scaled(vector: Column) -> Column:
    """floor(256 * x) of each component as double, or null for a vector that takes no part."""
    whole = F.transform(vector, lambda x: F.when(F.abs(x.cast("double")) < float("inf"), x.cast("double")))
    ok = vector.isNotNull() & ~F.exists(whole, lambda x: x.isNull() | F.isnan(x))
    return F.when(ok, F.transform(whole, lambda x: _floor(F.lit(float(SCALE)) * x)))


def _floor(x: Column) -> Column:
    """floor as double, for doubles of any size."""
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)


def _order(vector: Column) -> Column:
    """Where a vector goes: its largest components' places and signs, so similar vectors come together."""
    size = F.transform(vector, lambda x, i: F.struct((-F.abs(x)).alias("a"), i.alias("i"), (x < 0).alias("s")))
    top = F.slice(F.array_sort(size), 1, 3)
    return F.transform(top, lambda t: 2 * t["i"] + t["s"].cast("int"))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of equal width; a shorter vector has zeros behind."""
    sizes = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, int)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _small(matrix: np.ndarray) -> tuple[bytes, int]:
    """The matrix in 16-bit integers if they hold it, else in doubles."""
    kind = np.int16 if np.abs(matrix).max(initial=0) <= 32767 else np.float64
    return matrix.astype(kind).tobytes(), np.dtype(kind).itemsize


def _unpacked(raw: bytes, item: int, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, np.int16 if item == 2 else np.float64).reshape(rows, width).astype(np.float64)


def _product(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products; whole numbers of any size if doubles can't hold them."""
    width = min(queries.shape[1], vectors.shape[1])
    queries, vectors = queries[:, :width], vectors[:, :width]
    if np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * width < EXACT:
        return queries @ vectors.T
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return whole(queries).dot(whole(vectors).T)


def _maxima(vectors: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest and the smallest component of each block, per dimension."""
    starts = np.arange(0, len(vectors), block)
    if not vectors.shape[1]:
        return np.zeros((len(starts), 0)), np.zeros((len(starts), 0))
    return np.maximum.reduceat(vectors, starts, axis=0), np.minimum.reduceat(vectors, starts, axis=0)


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What each query can score in each block at most."""
    width = min(queries.shape[1], high.shape[1])
    # the query's positive weights meet the block's largest components, its negative ones the smallest
    signed = np.hstack([np.maximum(queries[:, :width], 0), np.minimum(queries[:, :width], 0)])
    return _product(signed, np.hstack([high[:, :width], low[:, :width]]))


def search(
    queries: np.ndarray, own: np.ndarray, least: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int = BLOCK
) -> tuple[list[np.ndarray], list[list], int]:
    """Each query's best k ids and scores in a range of blocks that reach ``least``; how many block scores were made.

    ``own`` are the queries' ids, which are no candidates; an id counts once, with its best score.
    """
    starts = np.arange(0, len(ids), block)
    bounds = _bounds(queries, *_maxima(vectors, block))
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_ids: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    best: list[list] = [[] for _ in range(len(queries))]
    kth = list(least)
    scored = 0
    alive = np.arange(len(queries))
    for rank in range(len(starts)):
        at = order[alive, rank]
        keep = np.array([bounds[q, b] >= kth[q] for q, b in zip(alive, at, strict=True)], bool)
        alive, at = alive[keep], at[keep]
        if not len(alive):
            break
        for b in np.unique(at).tolist():
            rows = alive[at == b]
            span = slice(starts[b], starts[b] + block)
            scores, names = _product(queries[rows], vectors[span]), ids[span]
            if scores.dtype == object:
                scores = np.minimum(np.maximum(scores, -LONGEST - 1), LONGEST)
            scored += len(rows)
            for q, line in zip(rows.tolist(), scores, strict=True):
                good = np.flatnonzero((line >= kth[q]) & (names != own[q]))
                if not len(good):
                    continue
                merged: dict[int, float] = dict(zip(best_ids[q].tolist(), best[q], strict=True))
                if len(good) > 4 * k:
                    # of many, only those at least as good as the k-th id in score and id order matter
                    cut = np.lexsort((names[good], -line[good].astype(np.float64)))
                    good = _first_ids(good[cut], names, k)
                for name, score in zip(names[good].tolist(), line[good].tolist(), strict=True):
                    if name not in merged or score > merged[name]:
                        merged[name] = score
                top = sorted(merged.items(), key=lambda x: (-x[1], x[0]))[:k]
                best_ids[q] = np.array([n for n, _ in top], np.int64)
                best[q] = [s for _, s in top]
                if len(top) == k:
                    kth[q] = max(kth[q], best[q][-1])
    return best_ids, best, scored


def _at_most(score) -> float:
    """The score as a double; one that doubles can't hold is lowered to the next."""
    return float(np.nextafter(float(score), -np.inf)) if abs(score) >= EXACT else float(score)


def _first_ids(places: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """The first of ``places`` until they name ``k`` ids."""
    _, first = np.unique(names[places], return_index=True)
    return places[np.sort(first)[:k]]


_RANGES = (
    "range long, width int, rows int, item int, ids binary, vectors binary, blocks int, m_item int, maxima binary, "
    "q_rows int, q_ids binary, q_vectors binary, q_item int, q_least array<double>"
)
_QUERIES = "q_width int, q_rows int, q_ids binary, q_vectors binary, q_item int, q_least array<double>"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}


def _row(schema: str, *values) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array([v], _ARROW[kind]) for v, (_, kind) in zip(values, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _ranges(batches: Iterator[pa.RecordBatch], k: int, range_bytes: int, block: int):
    """Ranges of blocks with their maxima, each with its queries and the k-th score they have in it."""
    from pyspark import TaskContext

    first, made = TaskContext.get().partitionId() << 32, 0

    def row(batch: pa.RecordBatch):
        nonlocal made
        matrix, ids, asks = _matrix(batch["v"]), batch["vec_id"].to_numpy(), np.asarray(batch["asks"])
        own = np.flatnonzero(asks)
        least = np.full(len(own), -np.inf)
        if len(own):
            _, best, _ = search(matrix[own], ids[own], least, ids, matrix, k, block)
            least = np.array([_at_most(b[-1]) if len(b) == k else -np.inf for b in best])
        raw, item = _small(matrix)
        high, low = _maxima(matrix, block)
        maxima, m_item = _small(np.concatenate([high, low]))
        q_raw, q_item = _small(matrix[own])
        made += 1
        return _row(
            _RANGES, first + made - 1, matrix.shape[1], len(ids), item, ids.tobytes(), raw, len(high), m_item, maxima,
            len(own), ids[own].tobytes(), q_raw, q_item, least.tolist(),
        )

    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            width = max(1, len(batch["v"][at].values) if batch["v"][at].is_valid else 1)
            room = max(1, (range_bytes - size) // (2 * width))
            piece = batch.slice(at, room)
            at += piece.num_rows
            size += 2 * width * piece.num_rows
            waiting.append(piece)
            if size >= range_bytes:
                yield row(pa.concat_batches(waiting))
                waiting, size = [], 0
    if waiting:
        yield row(pa.concat_batches(waiting))


def _batched(batches: Iterator[pa.RecordBatch], batch_bytes: int):
    """Queries of several ranges together."""
    waiting: list[dict] = []

    def row():
        width = max(w["width"] for w in waiting)
        parts = []
        for w in waiting:
            own = _unpacked(w["q_vectors"], w["q_item"], w["width"], w["q_rows"])
            parts.append(np.pad(own, ((0, 0), (0, width - w["width"]))))
        raw, item = _small(np.concatenate(parts))
        own_ids, own_least = b"".join(w["q_ids"] for w in waiting), [x for w in waiting for x in w["q_least"]]
        return _row(_QUERIES, width, sum(w["q_rows"] for w in waiting), own_ids, raw, item, own_least)

    size = 0
    for batch in batches:
        for w in batch.to_pylist():
            waiting.append(w)
            size += len(w["q_vectors"])
            if size >= batch_bytes:
                yield row()
                waiting, size = [], 0
    if waiting:
        yield row()


_MAXIMA = "range long, width int, blocks int, m_item int, maxima binary"


def _gathered(batches: Iterator[pa.RecordBatch], limit: int):
    """Block maxima of many ranges as one row: a list of structs."""
    names = [f.split()[0] for f in _MAXIMA.split(", ")]
    waiting: list[dict] = []
    size = 0

    def row():
        kinds = [_ARROW[f.split()[1]] for f in _MAXIMA.split(", ")]
        kind = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))
        return pa.RecordBatch.from_arrays([pa.array([waiting], kind)], ["of"])

    for batch in batches:
        for w in batch.to_pylist():
            waiting.append(w)
            size += len(w["maxima"])
            if size >= limit:
                yield row()
                waiting, size = [], 0
    if waiting:
        yield row()


def _left(batches: Iterator[pa.RecordBatch]):
    """For each batch of queries and each range of a row of maxima: the queries whose bound reaches their k-th score."""
    for batch in batches:
        for j in range(batch.num_rows):
            r = {n: batch[n][j].as_py() for n in batch.schema.names}
            queries = _unpacked(r["q_vectors"], r["q_item"], r["q_width"], r["q_rows"])
            own, least = np.frombuffer(r["q_ids"], np.int64), np.array(r["q_least"])
            for of in r["of"]:
                maxima = _unpacked(of["maxima"], of["m_item"], of["width"], 2 * of["blocks"])
                bounds = _bounds(queries, maxima[: of["blocks"]], maxima[of["blocks"] :])
                stay = np.flatnonzero((bounds.max(axis=1) >= least).astype(bool))
                if len(stay):
                    raw, item = _small(queries[stay])
                    row = (r["q_width"], len(stay), own[stay].tobytes(), raw, item, least[stay].tolist())
                    yield _row(f"range long, part int, {_QUERIES}", of["range"], r["part"], *row)


def _searched(asks: pa.Table, vectors: pa.Table, k: int, block: int) -> pa.Table:
    """The queries that came to a range, searched in it."""
    names = ["query_id", "vec_id", "score"]
    out = []
    r = {n: vectors[n][0].as_py() for n in vectors.schema.names}
    ids, matrix = np.frombuffer(r["ids"], np.int64), _unpacked(r["vectors"], r["item"], r["width"], r["rows"])
    for j in range(asks.num_rows):
        q = {n: asks[n][j].as_py() for n in asks.schema.names}
        own = np.frombuffer(q["q_ids"], np.int64)
        queries = _unpacked(q["q_vectors"], q["q_item"], q["q_width"], q["q_rows"])
        best_ids, best, _ = search(queries, own, np.array(q["q_least"]), ids, matrix, k, block)
        scores = [int(s) for b in best for s in b]
        found = np.concatenate([np.zeros(0, np.int64), *best_ids])
        columns = [pa.array(np.repeat(own, [len(b) for b in best])), pa.array(found), pa.array(scores, pa.int64())]
        out.append(pa.table(columns, names))
    return pa.concat_tables(out)


def vector_ranges(vectors: DataFrame, k: int, every: int, range_bytes: int = RANGE_BYTES, block: int = BLOCK) -> DataFrame:
    """The ranges as stored rows: vectors, block maxima, and the queries among them with a k-th score to start from."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("v"))
    rows = rows.where("vec_id is not null and v is not null")
    rows = rows.select("vec_id", "v", (F.col("vec_id") % every == 0).alias("asks"), _order(F.col("v")).alias("place"))
    dealt = rows.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id").select("vec_id", "v", "asks")
    return settle(dealt.mapInArrow(partial(_ranges, k=k, range_bytes=range_bytes, block=block), _RANGES), "vector-ranges")


def left_queries(ranges: DataFrame, batch_bytes: int = BATCH_BYTES, maxima_bytes: int = MAXIMA_BYTES) -> DataFrame:
    """For each range, the queries that its block maxima do not rule out: range, part (of the batches) and the queries.

    Batches of queries meet the rows of maxima by an equality join on lanes; no vector of a range is read.
    """
    spark = ranges.sparkSession
    asked = ranges.where("q_rows > 0").select("width", "q_rows", "q_ids", "q_vectors", "q_item", "q_least")
    batches = settle(asked.mapInArrow(partial(_batched, batch_bytes=batch_bytes), _QUERIES), "query-batches")
    small = ranges.select(*(f.split()[0] for f in _MAXIMA.split(", ")))
    kind = ", ".join(f.replace(" ", ": ") for f in _MAXIMA.split(", "))
    maxima = settle(small.mapInArrow(partial(_gathered, limit=maxima_bytes), f"of array<struct<{kind}>>"), "block-maxima")
    lanes = max(1, min(parallelism(spark), maxima.count()))
    parts = max(1, batches.count() // SHARED)
    maxima = maxima.withColumn("lane", F.expr(f"cast(pmod(monotonically_increasing_id(), {lanes}) as int)"))
    each = batches.withColumn("part", F.pmod(F.xxhash64("q_ids"), F.lit(parts)).cast("int"))
    each = each.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return each.join(maxima, "lane").drop("lane").mapInArrow(_left, f"range long, part int, {_QUERIES}")


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, range_bytes: int = RANGE_BYTES, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """The ``k`` best vectors of ``vectors`` (vec_id, embedding) for each whose vec_id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id, score: inner products of floor(256 * x), ties to smaller
    vec_id, all candidates if there are fewer than k. Vectors that are null or hold a null or
    non-finite component take no part, nor do null ids. A row is no candidate for its own id.
    Repeated ids count once, with the best score. Of vectors of different length the common
    components count; an empty vector scores 0 with all. Scores beyond a long are the nearest long and tie there.
    An empty table gives no rows. Other columns are not read.
    """
    ranges = vector_ranges(vectors, k, every, range_bytes)
    left = left_queries(ranges, batch_bytes)
    # a range is sent once for each part that has queries for it; bounds are cheap, so they are made again for the queries
    wanted = settle(left.select("range", "part").distinct(), "wanted-ranges")
    used = wanted.join(ranges.select("range", "width", "rows", "item", "ids", "vectors"), "range")
    pairs = left.groupBy("range", "part").cogroup(used.groupBy("range", "part"))
    found = pairs.applyInArrow(lambda asks, own: _searched(asks, own, k, BLOCK), "query_id long, vec_id long, score long")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every fiftieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), p AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
    FROM p
)
SELECT * FROM r WHERE rank <= 5
"""

import random
from collections import defaultdict

import numpy as np
import pytest

from lanelux.llm import topk

NAN, INF = float("nan"), float("inf")


def plain(rows, k, every):
    import math

    used = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    best = defaultdict(dict)
    for q, a in used:
        if q % every == 0:
            for i, b in used:
                if i != q:
                    score = sum(x * y for x, y in zip(a, b, strict=False))
                    score = max(-(1 << 63), min((1 << 63) - 1, score))
                    best[q][i] = max(score, best[q].get(i, score))
    out = set()
    for q, own in best.items():
        for rank, (i, s) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.add((q, rank, i, s))
    return out


@pytest.mark.parametrize("range_bytes,batch_bytes", [(4 << 20, 1 << 20), (600, 100)])
@pytest.mark.parametrize("kind", ["random", "groups", "ties", "large"])
def test_brute_force(spark, kind, range_bytes, batch_bytes):
    rng = random.Random(kind)
    centers = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(400):
        if kind == "random":
            v = [rng.gauss(0, 0.3) for _ in range(8)]
        elif kind == "groups":
            v = [x + rng.gauss(0, 0.05) for x in centers[i % 5]]
        elif kind == "large":
            v = [rng.choice([1e6, -3e7, 5e9, 0.5]) for _ in range(4)]
        else:
            v = centers[0] if i % 3 else [float(rng.randrange(2)) for _ in range(8)]
        rows.append((i, v))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(df, k=5, every=20, range_bytes=range_bytes, batch_bytes=batch_bytes)
    assert {tuple(r) for r in got.collect()} == plain(rows, 5, 20)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [2.0, 0.0]), (50, [3.0]), (1, None), (2, [1.0, None]), (3, [NAN]), (None, [1.0]),
        (4, [1e300, 1.0]), (5, []), (6, [-1.0, -2.0, 7.0]), (7, [INF]), (-50, [0.5, 0.5]), (8, [1.0, 2.0]), (8, [1.0, 3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as rank", "3 as v", "4 as lane")
    got = topk.top_k(df).collect()
    assert {tuple(r) for r in got} == plain(rows, 5, 50) and len(got) == len(plain(rows, 5, 50))
    assert topk.top_k(df.limit(0)).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one).count() == 0


def test_blocks_are_skipped():
    rng = np.random.default_rng(1)
    vectors = np.repeat(rng.integers(-200, 200, (20, 16)), 64, axis=0) + rng.integers(-5, 5, (1280, 16))
    vectors = vectors.astype(float)
    ids = np.arange(1280)
    queries = vectors[::100]
    _, best, scored = topk.search(queries, ids[::100], np.full(13, -np.inf), ids, vectors, 5, block=64)
    for q, own in zip(range(13), best, strict=True):
        scores = vectors @ queries[q]
        scores[100 * q] = -np.inf
        assert own == sorted(scores, reverse=True)[:5]
    assert scored < 13 * 20 / 3


def test_few_pairs_are_shipped(spark):
    """Of clustered vectors, a query goes to few ranges, and results are those of brute force all the same."""
    rng = random.Random(5)
    centers = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(40)]
    rows = [(i, [x + rng.gauss(0, 0.02) for x in centers[i % 40]]) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    ranges = topk.vector_ranges(df, 5, 20, range_bytes=40 * 32)
    n_ranges, n_queries = ranges.count(), ranges.selectExpr("sum(q_rows)").first()[0]
    shipped = topk.left_queries(ranges, batch_bytes=600, maxima_bytes=500).selectExpr("sum(q_rows)").first()[0]
    assert n_ranges >= 100 and n_queries == 200
    assert n_queries <= shipped < n_queries * n_ranges / 5
    got = topk.top_k(df, k=5, every=20, range_bytes=40 * 32, batch_bytes=600)
    assert {tuple(r) for r in got.collect()} == plain(rows, 5, 20)

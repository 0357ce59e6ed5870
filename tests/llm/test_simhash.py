import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lanelux.llm import components, simhash

from .conftest import words


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """For each (id, print): the smallest id that is not null and can be reached."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array([p for _, p in prints], np.uint64)
    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= distance).tolist():
            a, b = find(k), find(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(prints):
        root = find(k)
        if i is not None and (least.get(root) is None or i < least[root]):
            least[root] = i
        least.setdefault(root, None)
    return [least[find(k)] for k in range(len(prints))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \n\t\x0b\x85é\u00a0", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_long_text(monkeypatch):
    text = " ".join(words(random.Random(1), 500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def near_rows(rng, n):
    """Groups of texts with a few words changed."""
    rows, base = [], words(rng, 60)
    for k in range(n):
        if k % 9 == 0:
            base = words(rng, 60)
        own = list(base)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(60)] = "edit"
        rows.append((1000 + k, " ".join(own), "en", "s"))
    return rows


@pytest.mark.parametrize("distance", [4, 12])
def test_components(spark, made, odd, distance):
    rows = near_rows(random.Random(2), 150) + odd
    prints = [(i, plain_fingerprint(t)) for i, t, *_ in rows]
    want = Counter((i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints, distance), strict=True))
    got = simhash.near_duplicates(made(rows), distance=distance, blocks=distance + 2).collect()
    assert Counter(map(tuple, got)) == want


def test_parts_of_large_entries(spark):
    rng = random.Random(3)
    center = rng.getrandbits(64)
    prints = sorted({center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 6))) for _ in range(300)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    want = plain_components(list(enumerate(prints)), 4)
    for tile in (16, 1024):
        roots = {r["u"]: r["v"] for r in components.roots(simhash.links(df, tile=tile)).collect()}
        got = [roots.get(p, p) for p in signed]
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_forest():
    rng = random.Random(5)
    a = np.array([rng.getrandbits(7) for _ in range(60)], np.int64)
    u, v = simhash.forest(a, None, 1)
    assert (np.bitwise_count((u ^ v).view(np.uint64)) <= 1).all()
    assert len(u) == len(np.unique(a)) - len(set(plain_components(list(enumerate(np.unique(a).tolist())), 1)))


def test_one_row_of_each_component(spark, made, odd):
    rows = near_rows(random.Random(6), 60) + odd
    docs = made(rows)
    kept = simhash.kept(docs)
    assert kept.columns == docs.columns
    components_ = simhash.near_duplicates(docs).collect()
    want = Counter(r["component_id"] for r in components_ if r["component_id"] is not None)
    got = Counter(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert got.keys() == want.keys() and set(got.values()) == {1}


def test_empty(spark, made):
    assert simhash.near_duplicates(made([])).count() == 0
    assert simhash.kept(made([])).count() == 0


def test_long_chain(spark):
    n = 200
    df = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(3, 3), (None, 4)], "u long, v long")
    assert {r["v"] for r in components.roots(df).collect()} == {0}
    assert components.roots(df).count() == n

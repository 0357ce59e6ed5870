import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanelux.llm import spelling
from lanelux.llm.spelling import Index, near

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(docs):
    total = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            total[run if h % 31 else run[:at] + run[at + 1 :]] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def plain(docs):
    counts = plain_counts(docs)
    out = {}
    for w, n in counts.items():
        own = [v for v in counts if one_edit(v, w)]
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 10 * n else None
        out[w] = [w, form, w, n, len(own), counts[form] if form else None]
    for row in out.values():
        while out[row[2]][1]:
            row[2] = out[row[2]][1]
    return sorted(map(tuple, out.values()))


def run(docs, **more):
    return sorted(map(tuple, spelling.variants(docs, **more).select("word", "form", "root", "n", "n_near", "form_n").collect()))


def pairs(words, asked):
    """All (asked, word) one edit apart that the two searches find."""
    out = []
    for backwards in (False, True):
        own = sorted(w[::-1] if backwards else w for w in words)
        index = Index(own)
        for member in (True, False):
            queries = sorted(q[::-1] if backwards else q for q in asked if (q in words) is member)
            if queries:
                sizes = np.array([len(q) for q in queries])
                halves = sizes - sizes // 2 if backwards else sizes // 2
                found = near(index, queries, np.full(len(queries), member), halves, backwards)
                got = [(queries[a], own[b]) for a, b in zip(*(f.tolist() for f in found), strict=True)]
                out += [(a[::-1], b[::-1]) for a, b in got] if backwards else got
    return out


@settings(max_examples=150, deadline=None)
@given(
    st.sets(st.text(alphabet="abé", min_size=7, max_size=10), min_size=1, max_size=40),
    st.sets(st.text(alphabet="abéz", min_size=7, max_size=10), max_size=20),
)
def test_search(words, more):
    words, more = ({w.encode("latin-1") for w in own} for own in (words, more))
    got = pairs(words, words | more)
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words | more for b in words if one_edit(a, b)}


def test_suffix_ranks():
    words = sorted({bytes(random.Random(n).choices(b"abc", k=9)) for n in range(50)})
    index = Index(words)
    low, high = index.extend(np.array([0]), np.array([index.n]), index.codes(np.frombuffer(b"b", np.uint8)))
    assert int(high[0] - low[0]) == sum(w[:1] == b"b" for w in words)


@pytest.fixture(scope="module")
def case(odd):
    rng = random.Random(12)
    docs = [(i, t) for i, t, _, _ in odd]
    bases = ["".join(rng.choice("aeiorstnéÉ") for _ in range(rng.randrange(7, 12))) for _ in range(30)]
    for base, often in zip(bases, [1, 12, 150] * 10, strict=True):
        at = rng.randrange(len(base))
        near_words = [base, base[:at] + base[at + 1 :], base[:at] + "x" + base[at:], base[:at] + "y" + base[at + 1 :]]
        for n, word in enumerate(near_words):
            docs += [(rng.randrange(500), f"{word.capitalize()}, {word}!")] * max(1, often // 12**n)
    docs += [(900, "x" * 5000 + "y"), (901, "x" * 5000 + "y"), (902, "x" * 5000), (903, "x" * 5000), (904, "×" * 8 + " " + "×" * 8)]
    return docs


@pytest.mark.parametrize("shard", [spelling.SHARD_WORDS, 8, 2])
def test_plain(made, case, shard):
    rows = made([(i, t, None, None) for i, t in case]).selectExpr("*", "'x' as word", "'x' as shard", "'x' as form")
    assert run(rows, shard_words=shard) == plain(case)


def test_chain(made):
    docs = [(n, " ".join(["abcdefgh"] * 1200 + ["abcdefgx"] * 100 + ["abcdexgx"] * 8)) for n in (1, 2)]
    got = {r[0]: r[1:3] for r in run(made([(i, t, None, None) for i, t in docs]))}
    assert got["abcdexgx"] == ("abcdefgx", "abcdefgh") and got["abcdefgh"] == (None, "abcdefgh")


def test_empty(made):
    docs = made([(1, None, "en", "a"), (2, "", None, None), (3, "short words", None, None)])
    assert run(docs) == [] and run(docs.limit(0)) == []


def test_routes_cover_long_halves():
    """Bounds are cut, so a shard may be asked in vain but is never missed."""
    words = ["a" * 100 + c for c in "bcdefg"] + ["a" * 63 + "b" * 10]
    words.sort()
    routes = spelling.Routes([(False, n, w[:64], w[:64]) for n, w in enumerate(words)])
    for n, word in enumerate(words):
        home, places = routes.of(False, n, word)
        assert home == n
        assert {m for m, w in enumerate(words) if w.startswith(word[: len(word) // 2])} <= set(places)

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lanelux.llm import lexical

from .conftest import words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return re.findall(lexical.TERM, (text or "").translate(FOLD))


def plain(docs, items, k=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    held = [(i, found(t)) for i, t in docs if found(t)]
    big_n, big_l = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, t in held:
            m, score = 10 + 90 * len(t) * big_n // big_l, 0
            for term in set(found(text)):
                if tf := t.count(term):
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def run(spark, docs, items, **more):
    return sorted(map(tuple, lexical.search(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as rank", "'x' as _text", "'x' as query")


@pytest.fixture(scope="module")
def case(odd):
    rng = random.Random(11)
    docs = [(i, t) for i, t, _, _ in odd]
    docs += [(100 + n, " ".join(words(rng, rng.randrange(1, 60)))) for n in range(150)]
    docs += [(300 + n, "ba co di") for n in range(40)]  # ties
    items = [(n, " ".join(words(rng, 12))) for n in range(12)]
    items += [(50, None), (51, ""), (52, "!!! ---"), (None, "ba co"), (53, "ba co"), (53, "ba co"), (54, "É 日本語 12")]
    items += [(55, " ".join(sorted({w for _, t in docs[:10] for w in (t or "").split()})[:150]))]  # masks of three words
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_plain(spark, made, case, monkeypatch, small):
    docs, items = case
    more = {}
    if small:
        monkeypatch.setattr(lexical, "BLOCK_DOCS", 16)
        more = {"block_terms": 40}
    got = run(spark, made([(i, t, None, None) for i, t in docs]).withColumn("_text", lexical.F.lit(1)), items_of(spark, items), **more)
    assert got == sorted(plain(docs, items), key=str)


def test_empty(spark, made):
    docs, items = made([(1, "ba", "en", "a")]), items_of(spark, [(1, "ba")])
    assert run(spark, docs.limit(0), items) == []
    assert run(spark, docs, items.limit(0)) == []
    assert run(spark, docs.withColumn("text", lexical.F.lit("..")), items) == []


def block_of(texts, vocabulary):
    table = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    batch = next(lexical._postings(iter([table]), vocabulary))
    df = next(lexical._frequencies(iter([batch]), len(vocabulary)))
    weights = np.zeros(len(vocabulary), np.int64)
    for term, n in zip(df["term"].to_pylist(), df["df"].to_pylist(), strict=True):
        weights[term] = lexical.weight(batch["n_docs"][0].as_py(), n)
    return lexical.Block(batch, 0, lexical.Statistics(batch["n_docs"][0].as_py(), batch["n_terms"][0].as_py(), weights))


def test_masks_group_documents():
    mask, docs, starts = lexical.masks([np.array([0, 2, 5]), np.array([2, 3])], 6)
    groups = {int(m[0]): docs[a:b].tolist() for m, a, b in zip(mask, starts, starts[1:], strict=False)}
    assert groups == {1: [0, 5], 3: [2], 2: [3]}


def test_stops_before_low_masks():
    """Few documents hold rare terms; the many with a common one alone are never scored."""
    texts = ["common " + "fill " * 9] * 5000 + ["common rare word " + "fill " * n for n in range(20)]
    vocabulary = ["common", "rare", "word"]
    block = block_of(texts, vocabulary)
    none = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
    best, scored = block.rank(np.arange(3), none, 10)
    assert best[0].tolist() == list(range(5000, 5010))
    assert scored <= 20

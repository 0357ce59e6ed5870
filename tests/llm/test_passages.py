import random
from collections import Counter, defaultdict

import pytest

from lanelux.llm import passages

from .conftest import words


def plain(rows):
    """Spans covered by windows of 50 words that occur in two different documents."""
    seen, texts = defaultdict(set), {}
    for i, t in {(i, t) for i, t, *_ in rows if t is not None}:
        texts[i, t] = t.encode().split()
        for a in range(len(texts[i, t]) - 49):
            seen[tuple(texts[i, t][a : a + 50])].add((i, t))
    out = Counter()
    for (i, t), found in texts.items():
        spans = []
        for a in range(len(found) - 49):
            if len(seen[tuple(found[a : a + 50])]) > 1:
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = a + 50
                else:
                    spans.append([a, a + 50])
        out.update((i, a, b) for a, b in spans)
    return out


def check(rows, made):
    got = passages.repeated_passages(made(rows)).collect()
    assert Counter(tuple(r)[:3] for r in got) == plain(rows)
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(t)
    for r in got:
        assert r["n_words"] == r["end_word"] - r["start_word"]
        assert r["other_doc_id"] in texts
        assert r["other_doc_id"] != r["doc_id"] or len(set(texts[r["doc_id"]])) > 1


@pytest.fixture(params=["as is", "many partitions", "small batches"])
def cut(request, spark):
    """Classes of equal heads go on in the next partition or the next batch."""
    settings = {
        "as is": {},
        "many partitions": {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "23"},
        "small batches": {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"},
    }[request.param]
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(spark, made, odd, cut, seed):
    rng = random.Random(seed)
    bases = [words(rng, rng.choice([55, 70, 150])) for _ in range(5)]
    rows = list(odd)
    for k in range(20, 120):
        base = list(rng.choice(bases))
        a = rng.randrange(0, 25)
        own = base[a : a + rng.randrange(40, 160)]
        for _ in range(rng.choice([0, 0, 1, 3])):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(3)}"
        more = rng.choice([0, 1, 30])
        rows.append((k, " ".join(words(rng, rng.randrange(0, 1 + more)) + own + words(rng, rng.randrange(0, 1 + more))), "en", "s"))
    rows += [(200, rows[30][1], "en", "s"), (201, " ".join(bases[0] + bases[0]), "en", "s"), (30, rows[30][1], "en", "s")]
    check(rows, made)


def test_repeats_inside_a_text_alone(spark, made):
    rng = random.Random(9)
    line = words(rng, 60)
    rows = [(1, " ".join(line * 4), "en", "s"), (2, " ".join(words(rng, 300)), "en", "s"), (3, "a " * 500, "en", "s"), (4, "a " * 499, "en", "s")]
    check(rows, made)


def test_hot_passage(spark, made):
    rng = random.Random(10)
    hot = words(rng, 52)
    short = words(rng, 45)
    rows = [(k, " ".join(words(rng, 30) + (hot if k % 3 else short) + words(rng, 30)), "en", "s") for k in range(300)]
    check(rows, made)


def test_empty(spark, made):
    assert passages.repeated_passages(made([])).count() == 0

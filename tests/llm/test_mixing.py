import random
from collections import defaultdict

import pytest

from lanelux.llm import mixing

from .conftest import words


def plan(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len((t or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped = set()
    while True:
        free = [s for s in names if s not in capped]
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if level * weight[s] > most * sizes[s]}
        if not more:
            return {s: (sizes[s], most * sizes[s] if s in capped else level * weight[s]) for s in names}
        capped |= more


def test_targets_and_takes(spark, made, odd):
    rng = random.Random(1)
    rows = [(k, " ".join(words(rng, rng.randrange(0, 90))), "en", rng.choice(["a", "b", "B", "ä", None, "z", ""])) for k in range(600)]
    docs = made(rows + odd)
    mixed = mixing.mix(docs, mixing.plan_mix(docs))
    assert mixed.columns == [*docs.columns, "_mix"]
    got = mixed.collect()
    want = plan(rows + odd)
    taken = defaultdict(int)
    for r in got:
        m = r["_mix"]
        assert m["size"] == len((r["text"] or "").encode().split())
        assert m["source_size"] == want[r["source"]][0]
        assert m["target"] == pytest.approx(want[r["source"]][1])
        assert m["taken"] == m["copies"] * m["size"] and 0 <= m["copies"] <= 2
        taken[r["source"]] += m["taken"]
    assert len(got) == len(rows + odd)
    for s, (_, target) in want.items():
        if s in ("B", "z", "ä"):
            assert abs(taken[s] - target) <= 5
    again = mixing.mix(docs.repartition(7), mixing.plan_mix(docs.repartition(5)))
    key = lambda r: (str(r["doc_id"]), r["text"] or "", r["_mix"]["taken"])
    assert sorted(map(key, again.collect())) == sorted(map(key, got))


def test_empty_and_sizes_of_zero(spark, made):
    assert mixing.mix(made([]), mixing.plan_mix(made([]))).count() == 0
    docs = made([(1, None, None, None), (2, "", None, "a"), (3, " ", None, "b")])
    assert [r["_mix"]["taken"] for r in mixing.mix(docs, mixing.plan_mix(docs)).collect()] == [0, 0, 0]


def test_many_sources(spark, made):
    rows = [(k, "a b c " * (1 + k % 3), "en", f"s{k % 97}") for k in range(400)]
    want = plan(rows)
    got = {r["key"]: (r["source_size"], r["target"]) for r in mixing.plan_mix(made(rows)).collect()}
    assert len(got) == 97
    for s, (size, target) in want.items():
        assert got["a" + s][0] == size and got["a" + s][1] == pytest.approx(target)


def test_refill_passes_a_very_long_document(spark, made):
    rng = random.Random(3)
    plain = 0
    for seed in (1, 2, 3):
        rows = [(k, " ".join(words(rng, rng.randrange(1, 90))), "en", rng.choice("ab")) for k in range(700)]
        rows += [(1000 + seed, "x " * 14_000, "en", "a"), (2000 + seed, "x " * 16_000, "en", "b")]
        docs = made(rows)
        off = {}
        for refill in (False, True):
            got = mixing.mix(docs, mixing.plan_mix(docs, (1, 1), 0.4, seed=seed, refill=refill), seed=seed).collect()
            assert all(r["_mix"]["copies"] <= 1 for r in got)
            for s in "ab":
                own = [r["_mix"] for r in got if r["source"] == s]
                off[refill, s] = own[0]["target"] - sum(m["taken"] for m in own)
                if refill:
                    # nothing that was not taken fits
                    assert not [m for m in own if not m["copies"] and 0 < m["size"] <= off[refill, s]]
        plain += sum(off[False, s] > 90 for s in "ab")
        assert all(abs(off[True, s]) <= 5 for s in "ab"), off
    assert plain

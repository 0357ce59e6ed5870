import random
from collections import Counter

import numpy as np

from lanelux.llm import urls


def parse(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    rest = rest[end:]
    return host, rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]


def rule(host, path):
    best = None
    for r in urls.RULES:
        name, _, start = r.place.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            best = r if best is None or len(r.place) > len(best.place) else best
    return best


ODD = [
    None, "", "nohost", "http://Example.COM/en/x?y", "http://example.com", "http://com/", "https://a.www.example.com/en/#",
    "x://y.net/es/1", "http://net/fr", "http://é.org/?://", "http://ycom/", "a://b://c.com/x", "://", "http://É.COM/", "http://x.net/fr/\n?",
]


def made(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string")
    return df.selectExpr("*", "'h' as host", "'p' as path", "'v' as verdict", "'r' as rule", "1 as score", "2 as allowed")


def test_rules(spark):
    rows = list(enumerate(ODD)) + [(None, ODD[3]), (3, ODD[3])]
    got = urls.judge(made(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is None:
            continue
        u = ODD[r["page_id"]]
        own = rule(*parse(u))
        assert (r["host"], r["path"], r["rule"]) == (*parse(u), own and own.place)
        if own:
            assert r["verdict"] == own.verdict and r["score"] is None
        if not u:
            assert r["verdict"] == "block"
    assert urls.judge(made(spark, [])).count() == 0
    only = urls.judge(made(spark, [(1, "http://a.com/"), (2, "http://b.org/")])).collect()
    assert {r["verdict"] for r in only} == {"allow"}


def test_models_tell_kinds_apart(spark):
    rng = random.Random(1)
    name = lambda letters: "".join(rng.choice(letters) for _ in range(8))
    rows = [(k, f"http://{name('aeiou')}.com/{name('aeiou')}") for k in range(300)]
    rows += [(300 + k, f"http://{name('xzqkv')}.net/es/{name('xzqkv')}") for k in range(300)]
    rows += [(600 + k, f"http://{name('aeiou' if k % 2 else 'xzqkv')}.org/{name('aeiou' if k % 2 else 'xzqkv')}") for k in range(200)]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(made(spark, rows)).collect()}
    right = sum(got[600 + k] == ("allow" if k % 2 else "block") for k in range(200))
    assert right >= 190


def test_probabilities_sum_to_one():
    """Over all next bytes, whatever was counted of a context."""
    rng = np.random.default_rng(4)
    chance = np.full(257, 1 / 257)
    for _ in range(urls.ORDER + 1):
        both = rng.integers(0, 9, 257) * rng.integers(0, 2, 257)
        logs = [
            urls._ratios(lambda k, n=n: (np.array([[0.0], [both.sum()]]), np.array([[0.0], [n]])), np.zeros(1, int), 1)[0]
            for n in both
        ]
        # The first class has no count, so its chance stays that of the lowest order.
        step = [(n + urls.PRIOR * c) / (both.sum() + urls.PRIOR) for n, c in zip(both, chance, strict=True)]
        assert abs(sum(step) - 1) < 1e-12
        assert np.argmax(logs) == np.argmax(both)
        chance = np.array(step)


def test_scores_are_those_of_exact_counts(spark):
    """So many different n-grams that collisions of hashed counts would show."""
    rng = random.Random(2)
    name = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz-_") for _ in range(n))
    rows = [(k, f"http://{name(8)}.{'com' if k % 2 else 'net/es'}/{name(90)}") for k in range(5000)]
    rows += [(5000 + k, f"http://{name(8)}.org/{rows[k][1][20:60] if k % 3 else name(30)}7") for k in range(60)]
    rows.append((5060, "http://é.org/"))
    df = made(spark, rows)
    held = {r["page_id"] for r in df.where(f"pmod(xxhash64(url), {urls.HELD_OUT}) = 0").collect()}
    counts = [Counter(), Counter()]

    def grams(u):
        raw = "".join("0" if c in "123456789" else c for c in u.lower()).encode() + b"\n"
        for i in range(len(raw)):
            yield [((" " * urls.ORDER).encode().replace(b" ", b"\0") + raw)[urls.ORDER + i - k : urls.ORDER + i + 1] for k in range(urls.ORDER + 1)]

    for k, u in rows[:5000]:
        if k not in held:
            for own in grams(u):
                for j, g in enumerate(own):
                    counts[k % 2][g] += 1
                    counts[k % 2][j, g[:-1]] += 1
    assert len(counts[0]) > 1 << 17

    def score(u):
        total, n = 0.0, 0
        for own in grams(u):
            chance = [1 / 257, 1 / 257]
            for j, g in enumerate(own):
                chance = [(c[g] + urls.PRIOR * p) / (c[j, g[:-1]] + urls.PRIOR) for c, p in zip(counts, chance, strict=True)]
            total, n = total + np.log(chance[1] / chance[0]), n + 1
        return total / n

    got = {r["page_id"]: r["score"] for r in urls.judge(df).collect()}
    assert len(got) == len(rows)
    for k, u in rows[5000:]:
        assert abs(got[k] - score(u)) < 1e-9

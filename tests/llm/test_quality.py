import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lanelux.llm import quality

from .conftest import words


def plain(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(found, found[1:], found[2:], strict=False))
    counts, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {k, k + 1, k + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab# \n\x85é|\r", max_size=80))
def test_measures(text):
    assert quality.measure(text)[:5] == plain(text)


def test_ledger_and_policies(spark, made, odd):
    rng = random.Random(3)
    line = " ".join(words(rng, 12))
    rows = odd + [
        (100, " ".join(words(rng, 200)), "en", "s"),
        (101, "\n".join([line] * 30), "en", "s"),
        (102, " ".join(w + "%%%" for w in words(rng, 100)), "en", "s"),
    ]
    entries = quality.ledger(made(rows))
    got = quality.apply_policy(entries, quality.STANDARD).collect()
    assert Counter((r["doc_id"], *(r[m] for m in quality.MEASURES[:5])) for r in got) == Counter((i, *plain(t)) for i, t, *_ in rows)
    for r in got:
        fails = [x.name for k, x in enumerate(quality.RULES) if r["failed"] >> k & 1]
        values = {m: r[m] for m in quality.MEASURES}
        assert fails == [x.name for x in quality.RULES if eval(x.fails, {}, values)]  # noqa: S307
        assert r["kept"] == (not fails)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert kept[100] and not kept[101] and not kept[102]
    alone = {r["rule"]: (r["n_failed"], r["n_alone"]) for r in quality.ablations(entries, quality.STANDARD).collect()}
    for k, rule in enumerate(quality.RULES):
        assert alone[rule.name] == (sum(r["failed"] >> k & 1 for r in got), sum(r["failed"] == 1 << k for r in got))
    assert quality.ledger(made([])).count() == 0


def test_stored_bits_of_other_versions_are_not_reused(spark, made, odd, monkeypatch):
    """A changed rule and an added one are judged anew from stored measurements; bits of unchanged rules are taken."""
    docs = made(odd)
    entries = quality.ledger(docs)
    changed = quality.Rule("few_words", "n_words < 90", 2)
    added = quality.Rule("many_words", "n_words > 1000")
    rules = (changed, *quality.RULES[1:], added)
    key = lambda r: (str(r["doc_id"]), r["n_words"], r["n_lines"], r["failed"])
    anew = quality.ledger(docs, rules).collect()
    got = quality.in_force(entries, rules).collect()
    assert sorted(map(key, got)) == sorted(map(key, anew)) != sorted(map(key, entries.collect()))
    assert {tuple(r["versions"]) for r in got} == {(2, 1, 1, 1, 1, 1, 1)}
    # Bits of the version in force are the stored ones, whatever the measurements say.
    turned = quality.in_force(entries.withColumn("failed", F.lit(63).cast("long")))
    assert {r["failed"] for r in turned.collect()} == {63}
    monkeypatch.setattr(quality, "RULES", rules)
    kept = {(r["doc_id"], r["n_words"]): r["kept"] for r in quality.apply_policy(entries, quality.Policy("short", 2, ("few_words",))).collect()}
    assert all(ok == (n >= 90) for (_, n), ok in kept.items()) and any(50 <= n < 90 for _, n in kept)

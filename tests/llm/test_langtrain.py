import random

import numpy as np
import pytest

from lanelux.llm import langid, langtrain

from .test_langid import rows_of, text


def plain_sizes(rows, names):
    """Characters of the words that tell, with one end each, per label."""
    sizes = dict.fromkeys(names, 0)
    for _, t, lang, _ in rows:
        sizes[lang] += sum(len(w.strip(langid._PUNCTUATION) or w) + 1 for w in langtrain._telling(t.lower()))
    return [sizes[n] for n in names]


@pytest.mark.parametrize("share", [16_000_000, 30_000])
def test_all_labelled_texts_are_learned_and_counted(spark, made, monkeypatch, share):
    """More texts than a sample of 250 a label; one task or many give the same counts and as good a model."""
    monkeypatch.setattr(langtrain, "SHARE_CHARS", share)
    rows = rows_of(1200)
    model = langtrain.fit_all(made(rows), calibrated=True)
    keys, counts = model["trigrams"].tables[0]
    assert counts.sum(axis=0).tolist() == plain_sizes(rows, model["names"])
    for keys, counts in model["trigrams"].tables:
        assert (np.diff(keys) > 0).all() and counts.sum(axis=0).tolist() == plain_sizes(rows, model["names"])
    fresh = rows_of(150, seed=2)
    got = {r["doc_id"]: r for r in langid.predict(made(fresh), model).collect()}
    assert sum(got[i]["_lang_pred"] == lang for i, _, lang, _ in fresh) >= 147
    assert all(r["_lang_fits"] for r in got.values())
    rng = random.Random(3)
    switched = text(rng, "en", 20) + " " + text(rng, "fr", 20)
    best = langid.Tagger(model).words([switched])[0].argmax(axis=1)
    want = [model["names"].index("en")] * 20 + [model["names"].index("fr")] * 20
    assert sum(a == b for a, b in zip(best.tolist(), want, strict=True)) >= 36


def test_order_of_rows_does_not_matter_and_rare_labels_count(spark, made):
    rng = random.Random(8)
    rows = [(k, text(rng, "en", 40), "en", "s") for k in range(400)] + [(1000 + k, text(rng, "fr", 30), "fr", "s") for k in range(6)]
    one, two = (langtrain.fit_all(made(r).repartition(p), calibrated=True) for r, p in ((rows, 1), (rows[::-1], 5)))
    assert one["weights"] == pytest.approx(two["weights"], abs=1e-6) and one["limit"] == pytest.approx(two["limit"])
    fresh = [(k, text(rng, ("en", "fr")[k % 2], 30), None, "s") for k in range(60)]
    got = {r["doc_id"]: r["_lang_pred"] for r in langid.predict(made(fresh), one).collect()}
    assert sum(got[k] == ("en", "fr")[k % 2] for k in got) >= 58


def test_odd_rows(spark, made, odd, monkeypatch):
    docs = made(odd + rows_of(60))
    model = langtrain.fit_all(docs, calibrated=True)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(odd) + 60
    assert all((r["_lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in got)
    assert langtrain.fit_all(made([])) is None
    assert langtrain.fit_all(made([(1, "a", None, None), (2, None, "en", None)])) is None
    for blank in (" \n", "12 34"):
        model = langtrain.fit_all(made([(1, blank, "en", "s")]), calibrated=True)
        assert model["names"] == ["en"] and model["limit"] == -np.inf
        assert langid.predict(docs, model).count() == len(got)
    monkeypatch.setattr(langid, "MOST_LABELS", 2)
    with pytest.raises(ValueError, match="labels"):
        langtrain.fit_all(docs)

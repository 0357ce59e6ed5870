import random
import zlib
from collections import Counter

import corpus_pipeline as pipeline
from lanelux.llm import secrets, simhash, tokens

from .conftest import words
from .test_langid import rows_of, text
from .test_secrets import TEXTS, base_spans
from .test_simhash import plain_components, plain_fingerprint


def stored(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages(spark, made, odd, tmp_path):
    rng = random.Random(1)
    rows = odd + [(100 + k, " ".join(words(rng, rng.randrange(20, 90))), "en", rng.choice("ab")) for k in range(60)]
    rows += [(300 + k, " ".join(words(rng, 40)) + " " + t, "en", "c") for k, t in enumerate(TEXTS)]
    rows += [(400 + k, rows[20][1], "en", "a") for k in range(5)]
    docs = made(rows)
    names = [n for n, _ in pipeline.STAGES]
    assert len(names) == 5
    out = {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        docs = stored(spark, stage(spark, docs, ""), tmp_path / str(k))
        out[name] = docs.collect()
        if k < 4:
            assert docs.columns == list(pipeline.COLUMNS)
    clean = out["language ID"]
    assert Counter(r["text"] for r in clean) == Counter(t for _, t, *_ in rows if any(c.isalpha() for c in t or ""))
    assert all(r["lang"] is not None for r in clean)
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in clean]
    want = {c for c in plain_components(prints, 4) if c is not None}
    kept = out["SimHash near-dedup"]
    assert Counter(r["doc_id"] for r in kept) == Counter(want)
    redacted = out["secret scans"]
    assert len(redacted) == len(kept)
    for r in redacted:
        assert r["n_chars"] == len(r["text"])
        assert not [s for s in base_spans(r["text"]) if s[0] != "assign"]
    times = Counter(r["doc_id"] for r in out["mixing"])
    assert set(times.values()) <= {1, 2} and times.keys() <= {r["doc_id"] for r in redacted}
    n = sum(len(tokens.encoder(tokens.BYTE_BPE)._whole(r["text"])) // 4 + 1 for r in out["mixing"])
    assert sum(r["length"] for r in out["packing"]) == n
    assert {r["doc_id"] for r in out["packing"]} == times.keys()


def test_empty(spark, made, tmp_path):
    docs = made([])
    for k, (_, stage) in enumerate(pipeline.STAGES):
        docs = stored(spark, stage(spark, docs, ""), tmp_path / str(k))
    assert docs.count() == 0


def test_run(spark):
    rows = pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and max(r["offset"] + r["length"] for r in rows) <= 1024
    assert all(r["ids_crc32"] != zlib.crc32(b"") for r in rows)
    assert simhash.DISTANCE == 4 and simhash.SHINGLE == 4 and secrets.RULES[:3] == secrets.BASE


def test_language_rejects_what_fits_no_language(spark, made):
    rng = random.Random(6)
    junk = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    other = lambda n: " ".join("".join(rng.choice(["szcz", "ło", "ny", "prz", "ka", "ów"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    for langs in (("en", "fr", "de"), ("en", "fr"), ("en",)):
        labelled = [r for r in rows_of(240, seed=7) if r[2] in langs]
        clean = [(1000 + k, text(rng, langs[k % len(langs)], rng.randrange(4, 60)), None, "s") for k in range(60)]
        clean.append((1060, "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde " + text(rng, langs[0], 8), None, "s"))
        bad = [(2000 + k, (junk, other)[k % 2](rng.randrange(8, 60)), None, "s") for k in range(60)]
        bad += [(2100, "これは日本語の文章です。" * 9, None, "s"), (2101, "Это русский текст без метки языка", None, "s")]
        got = {r["doc_id"] for r in pipeline.language(spark, made(labelled + clean + bad), "").collect()}
        assert {r[0] for r in labelled} <= got, langs
        assert {r[0] for r in clean} <= got, langs
        assert not {r[0] for r in bad} & got, langs

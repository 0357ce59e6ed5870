import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanelux.llm import frames, packing, token_files, tokens

from .conftest import words


@pytest.mark.parametrize("vocabulary", [tokens.WORD_BPE, tokens.BYTE_BPE])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aéB'.,!$1 \n\t\r\x01\x0b\u00a0\u3000日\u0301s", max_size=30), max_size=4))
def test_units_give_the_ids_of_whole_texts(vocabulary, texts):
    encoder = tokens.encoder(vocabulary)
    assert encoder.encode(texts) == [encoder._whole(t) for t in texts]


@pytest.mark.parametrize("vocabulary", [tokens.WORD_BPE, tokens.BYTE_BPE])
def test_small_memory(vocabulary):
    rng = random.Random(1)
    encoder = tokens.Encoder(tokens.public_tokenizers.path(vocabulary[0]), *vocabulary[1:], keep=50, joined=3)
    texts = [rng.choice([" ", "\n", ", "]).join(words(rng, 40)) + "." for _ in range(30)] + [None, "", "<|endoftext|>"]
    for text in texts:
        assert encoder.encode([text]) == [encoder._whole(text or "")]


def test_a_worker_cuts_few_bytes_of_text_at_once(monkeypatch):
    encoder, sizes = tokens.Encoder(tokens.public_tokenizers.path(tokens.BYTE_BPE[0]), *tokens.BYTE_BPE[1:]), []
    inner = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda joined, bounds: sizes.append(len(joined)) or inner(joined, bounds))
    texts = ["ab cd " * 50_000 + str(k) for k in range(30)]
    assert encoder.encode(texts) == [encoder._whole(t) for t in texts[:1]] + [encoder.encode([t])[0] for t in texts[1:]]
    assert max(sizes) <= 3 << 20 and sum(sizes[:-29]) == sum(map(len, texts))


def test_frames_round_trip():
    rng = np.random.default_rng(2)
    docs = [(i, rng.integers(0, 50_000, n).astype("<u4").tobytes()) for i, n in enumerate([0, 1, 5000, 3, 70_000, 0, 2])]
    docs[3] = (None, docs[3][1])
    out = io.BytesIO()
    out.close = lambda: None
    writer = frames.Writer(out, frame_bytes=8 << 10)
    for i, ids in docs:
        writer.add(i, ids)
    writer.close()
    raw = out.getvalue()
    reader = frames.Reader(pa.BufferReader(raw))
    assert reader.doc_ids == [i for i, _ in docs]
    assert [reader.document(k) for k in range(len(docs))] == [d for _, d in docs]
    assert list(reader.checksums()) == [zlib.crc32(d) for _, d in docs]
    damaged = bytearray(raw)
    damaged[20] ^= 1
    with pytest.raises(Exception):  # noqa: B017
        list(frames.Reader(pa.BufferReader(bytes(damaged))).checksums())


def ids_of(text, vocabulary, end):
    return np.frombuffer(tokens.encoder(vocabulary)._whole(text or "") + end.to_bytes(4, "little"), "<u4")


def test_token_files(spark, made, odd, tmp_path):
    docs = made(odd)
    files = token_files.write_token_files(docs, str(tmp_path / "t"), file_bytes=20_000)
    got = [tuple(r) for r in token_files.read_token_files(files, str(tmp_path / "t")).orderBy("start").collect()]
    ids = {}
    for i, t, *_ in odd:
        own = ids_of(t, tokens.WORD_BPE, 2)
        ids.setdefault(i, []).append((len(own), zlib.crc32(own.tobytes())))
    assert [r[0] for r in got] == sorted((i for i, *_ in odd), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])[:-1]]).tolist()
    for i, own in ids.items():
        assert sorted(own) == sorted((r[2], r[3]) for r in got if r[0] == i)
    none = token_files.write_token_files(made([]), str(tmp_path / "none"))
    assert token_files.read_token_files(none, str(tmp_path / "none")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_first_fit_decreasing(sizes):
    want: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        for own in want:
            if sum(sizes[i] for i in own) + sizes[item] <= 32:
                own.append(item)
                break
        else:
            want.append([item])
    assert packing.first_fit_decreasing(sizes, 32) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 31), min_size=1, max_size=60), st.integers(1, 4))
def test_gaps(sizes, least):
    bins = [[(i, 0, sizes[i]) for i in own] for own in packing.first_fit_decreasing(sizes, 32)]
    out = packing.fill_gaps(bins, 32, least)
    seen = sorted(p for own in out for p in own)
    for i, size in enumerate(sizes):
        at = 0
        for _, start, length in (p for p in seen if p[0] == i):
            assert start == at and length > 0
            at += length
        assert at == size
    fills = [sum(p[2] for p in own) for own in out]
    assert max(fills) <= 32 and all(packing.padding(f, 32) < least for f in fills)


@pytest.mark.parametrize("group_docs", [2, 2048])
def test_packing(spark, made, odd, group_docs):
    rows = packing.pack(made(odd), length=64, group_docs=group_docs, with_ids=True).collect()
    want = sorted((i is not None, i or 0, ids_of(t, tokens.BYTE_BPE, 0).tobytes()) for i, t, *_ in odd)
    sequences, documents = {}, {}
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(len(r["ids"]) for r in rows) == sum(len(w[2]) for w in want)
    by_size = {(i, len(w) // 4): w for _, i, w in want if i}
    for (i, n), own in documents.items():
        if i and i != 5:
            assert b"".join(x for _, x in sorted(own)) == by_size[i, n]
    assert packing.pack(made([])).count() == 0

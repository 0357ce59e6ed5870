"""Language models learned from all labelled texts, by tasks that each train on a share of them.

Labelled texts are dealt by a hash of id and text. Each task takes adaptive gradient steps on the chains'
likelihood over its share, from zero; the model is the mean of the tasks' weights by their words (parameter mixing).
Words of rare labels weigh more (``BALANCE``). The trigram models are counts over all labelled texts, and the
limit of a text's mean comes from all of them: texts are halved by a hash, and each is measured by the other half's models.
What reaches the driver is the model, bounded by ``WEIGHT_BITS``, ``GRAM_BITS`` and ``MOST_LABELS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanelux.llm import langid
from lanelux.llm.common import steps
from lanelux.session import settle

#: Characters of one task's share. Smaller tables are read up to ``ROUNDS`` times, so that as many steps are taken.
SHARE_CHARS, ROUNDS = 16_000_000, 14
#: Pieces of a step, a quarter of them if texts are read more than once, and pieces that are put in mixed order together.
STEP_PIECES, MIXED_PIECES = 4000, 16_000
#: Keys of an n-gram table are folded to this many bits; less with more than four labels.
GRAM_BITS = 21
#: Words of a label weigh as this power of its share; at 1 all labels would weigh the same.
BALANCE = 0.5
#: Means are counted at this many decimals for their quantiles.
DECIMALS = 4

# Kinds of rows that tasks give, beside 0 to 5 for the n-gram tables.
_WEIGHTS, _MOVES, _FIRST, _WORDS = 10, 11, 12, 13
_ROWS = "kind int, key long, value array<double>"


class _Trainer:
    """Adaptive gradient steps over pieces of one label each, as ``langid.train`` takes them."""

    def __init__(self, scales: np.ndarray, pieces: int, seed: int, rate: float = 0.35, decay: float = 2e-6):
        size = len(scales)
        self._scales, self._pieces, self._rate, self._decay, self._rng = scales, pieces, rate, decay, np.random.default_rng(seed)
        # a row per label, so that each is read and written as one array
        self.weights, self.moves, self.first = np.zeros((size, 1 << langid.WEIGHT_BITS)), np.zeros((size, size)), np.zeros(size)
        self._squares = [np.full_like(a, 1e-8) for a in (self.weights, self.moves, self.first)]

    def sizes(self) -> Iterator[int]:
        """Words of the pieces, without end."""
        while True:
            yield from self._rng.integers(6, 40, 4096).tolist()

    def learn(self, pieces: list[tuple[list[str], int]]) -> None:
        order = self._rng.permutation(len(pieces))
        for part in np.array_split(order, max(1, len(order) // self._pieces)):
            self._step([pieces[k] for k in part])

    def _step(self, chosen: list[tuple[list[str], int]]) -> None:
        tokens = [w for own, _ in chosen for w in own]
        known = {w: k for k, w in enumerate(dict.fromkeys(tokens))}
        words = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        sizes = [len(own) for own, _ in chosen]
        gold = np.repeat([y for _, y in chosen], sizes)
        lengths = np.array([sum(sizes[k : k + 3]) for k in range(0, len(sizes), 3)])  # three pieces make a chain
        flat, owner, counts = langid._table(list(known))
        scaled = 1 / np.sqrt(np.maximum(1, counts))
        scores = np.stack([(np.bincount(owner, own[flat], len(known)) * scaled)[words] for own in self.weights], axis=1)
        gradient, wanted, first = langid.chain_gradients(scores, gold, lengths, self.moves, self.first)
        gradient *= self._scales[gold][:, None]
        step = self.weights * (-self._decay * len(words))
        for k in range(len(step)):
            per_word = np.bincount(words, gradient[:, k], len(known)) * scaled
            step[k] += np.bincount(flat, per_word[owner], step.shape[1])
        for value, by, squares in zip((self.weights, self.moves, self.first), (step, wanted, first), self._squares, strict=True):
            squares += by * by
            value += self._rate * by / np.sqrt(squares)


class _Grams:
    """Counts of n-grams of words by label and half."""

    def __init__(self, columns: int, bits: int):
        self._columns, self._bits = columns, bits
        self.tables = [(np.zeros(0, np.int64), np.zeros((0, columns))) for _ in range(6)]

    def add(self, texts: list[tuple[list[str], int]]) -> None:
        """``texts``: the words of a text that speak for its language, and its column."""
        known: dict[str, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for own, _ in texts for w in own], np.int64)
        if not len(ids):
            return
        column = np.repeat([c for _, c in texts], [len(own) for own, _ in texts])
        times = np.bincount(ids * self._columns + column, minlength=len(known) * self._columns).reshape(-1, self._columns)
        grams, owner = langid._grams(list(known))
        for k, row in enumerate(langid.folded(grams, self._bits)):
            keys, at = np.unique(row, return_inverse=True)
            counts = np.stack([np.bincount(at, times[owner, c], len(keys)) for c in range(self._columns)], axis=1)
            old_keys, old = self.tables[k]
            both, at = np.unique(np.concatenate([old_keys, keys]), return_inverse=True)
            sums = np.zeros((len(both), self._columns))
            sums[at[: len(old_keys)]] += old
            sums[at[len(old_keys) :]] += counts
            self.tables[k] = (both, sums)


def _telling(text: str) -> list[str]:
    """The words of a text that speak for its language: those with a letter and no digit, or all with a letter."""
    lettered = [w for c in langid._chains(text) for w in c if langid._lettered(w)]
    return [w for w in lettered if langid._plain(w)] or lettered


def _pieces(text: str, label: int, sizes: Iterator[int]) -> Iterator[tuple[list[str], int]]:
    for words in langid._chains(text):
        at = 0
        while at < len(words):
            step = next(sizes)
            yield words[at : at + step], label
            at += step


def _learned(batches: Iterator[pa.RecordBatch], names: list[str], scales: np.ndarray, rounds: int, bits: int | None) -> Iterator[pa.RecordBatch]:
    """A task's weights times its words, its words, and with ``bits`` its counts of n-grams."""
    trainer, index = _Trainer(scales, STEP_PIECES if rounds == 1 else STEP_PIECES // 4, seed=5), {n: k for k, n in enumerate(names)}
    sizes = trainer.sizes()
    grams = None if bits is None else _Grams(2 * len(names), bits)
    kept: list[tuple[str, int]] = []
    pieces: list[tuple[list[str], int]] = []
    n_words = 0
    for batch in steps(batches, "text"):
        rows = [(t, index[y]) for t, y in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True)]
        if grams:
            grams.add([(_telling(t), 2 * y + h) for (t, y), h in zip(rows, batch["half"].to_pylist(), strict=True)])
        kept += rows if rounds > 1 else []
        for text, label in rows:
            for piece in _pieces(text, label, sizes):
                n_words += len(piece[0])
                pieces.append(piece)
            if len(pieces) >= MIXED_PIECES:
                trainer.learn(pieces)
                pieces = []
    if pieces:
        trainer.learn(pieces)
    for _ in range(rounds - 1):
        pieces = []
        for text, label in kept:
            pieces += _pieces(text, label, sizes)
            if len(pieces) >= MIXED_PIECES:
                trainer.learn(pieces)
                pieces = []
        if pieces:
            trainer.learn(pieces)
    if not n_words:
        return
    used = np.flatnonzero(trainer.weights.any(axis=0))
    parts = [
        (_WEIGHTS, used, trainer.weights[:, used].T * n_words),
        (_MOVES, np.arange(len(names)), trainer.moves * n_words),
        (_FIRST, np.zeros(1, np.int64), trainer.first[None] * n_words),
        (_WORDS, np.zeros(1, np.int64), np.full((1, 1), float(n_words))),
        *((k, keys, counts) for k, (keys, counts) in enumerate(grams.tables if grams else [])),
    ]
    for kind, keys, values in parts:
        for k in range(0, len(keys), 10_000):
            some = values[k : k + 10_000]
            lists = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * some.shape[1], pa.array(some.ravel()))
            columns = [pa.array(np.full(len(some), kind, np.int32)), pa.array(keys[k : k + 10_000].astype(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "key", "value"])


def _means(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Per text with a letter its mean log probability under the models of the other half."""
    models = shared.value
    for batch in steps(batches, "text", langid.TAG_STEP):
        texts = [_telling(t) for t in batch["text"].to_pylist()]
        half = batch["half"].to_numpy()
        means = []
        for h in (0, 1):
            own = [t for t, is_one in zip(texts, half == h, strict=True) if is_one and t]
            known: dict[str, int] = {}
            ids = np.array([known.setdefault(w, len(known)) for t in own for w in t], np.int64)
            if len(ids):
                logs, owner = models[1 - h].of(list(known))[ids], np.repeat(np.arange(len(own)), list(map(len, own)))
                means.append(langid._mean(np.stack([np.bincount(owner, logs[:, k], len(own)) for k in (0, 1)], axis=1)))
        if means:
            yield pa.RecordBatch.from_arrays([pa.array(np.round(np.concatenate(means), DECIMALS))], ["mean"])


def _limit(dealt: DataFrame, halves: list[langid.Trigrams]) -> float:
    """As ``langid.calibrate`` sets it: under the lowest hundredth of the means by its distance to the median, 1 at least."""
    shared = dealt.sparkSession.sparkContext.broadcast(halves)
    counted = dealt.mapInArrow(partial(_means, shared=shared), "mean double").groupBy("mean").count().collect()
    if not counted:
        return -np.inf
    values, times = np.array(sorted(tuple(r) for r in counted)).T
    low, middle = (values[np.searchsorted(np.cumsum(times), q * (times.sum() - 1), "right")] for q in (0.01, 0.5))
    return float(low - max(1.0, middle - low))


def fit_all(docs: DataFrame, calibrated: bool = False) -> dict | None:
    """A model of all labelled texts of ``docs`` (doc_id, text, lang), whole; None if no row has a label and a text.

    ``calibrated`` also gives trigram models and the limit. More than ``MOST_LABELS`` labels raise.
    """
    rows, sizes = langid.labelled_rows(docs)
    if not sizes:
        return None
    names = sorted(sizes)
    chars = np.array([sizes[n][1] for n in names], float)
    shares = max(1, -(-int(chars.sum()) // SHARE_CHARS))
    rounds = int(min(ROUNDS, max(1, SHARE_CHARS // chars.sum())))
    bits = GRAM_BITS - max(0, (len(names) - 1).bit_length() - 2)
    dealt = rows.select("lang", "text", F.xxhash64("doc_id", "text").alias("chance"), F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"))
    dealt = dealt.repartition(shares, "chance").sortWithinPartitions("chance", "lang").drop("chance")
    learn = partial(_learned, names=names, scales=(chars.mean() / chars) ** BALANCE, rounds=rounds, bits=bits if calibrated else None)
    width = len(names) * (2 if calibrated else 1)
    sums = dealt.mapInArrow(learn, _ROWS).groupBy("kind", "key").agg(*[F.sum(F.get("value", F.lit(k))).alias(f"v{k}") for k in range(width)])
    got = settle(sums, "language-model").toArrow()
    kind, key = (got[n].to_numpy() for n in ("kind", "key"))
    values = np.stack([got[f"v{k}"].fill_null(0.0).to_numpy() for k in range(width)], axis=1)

    def of(wanted: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(kind == wanted)
        at = at[np.argsort(key[at])]
        return key[at], values[at]

    n_words = max(1.0, of(_WORDS)[1][:, 0].sum())
    model = {"names": names, "weights": np.zeros((1 << langid.WEIGHT_BITS, len(names)), np.float32)}
    model |= {"moves": np.zeros((len(names), len(names))), "first": np.zeros(len(names))}
    for name, wanted in (("weights", _WEIGHTS), ("moves", _MOVES)):
        at, sums_of = of(wanted)
        model[name][at] = sums_of[:, : len(names)] / n_words
    model["first"] += of(_FIRST)[1][:, : len(names)].sum(axis=0) / n_words
    if not calibrated:
        return model
    tables = [of(k) for k in range(6)]
    if not len(tables[0][0]):
        return model | {"trigrams": None, "limit": -np.inf}
    halves = [langid.Trigrams.counted([(k, v[:, h::2]) for k, v in tables], bits) for h in (0, 1)]
    whole = langid.Trigrams.counted([(k, v[:, 0::2] + v[:, 1::2]) for k, v in tables], bits)
    both = all(tables[0][1][:, h::2].any() for h in (0, 1))
    return model | {"trigrams": whole, "limit": _limit(dealt, halves) if both else -np.inf}

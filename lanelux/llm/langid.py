"""Language of each word and text by a linear-chain conditional random field.

A text is cut into chains of words. A word's scores come from its affixes, character n-grams
and the lexicon (the word itself), all hashed to a fixed number of weights; learned transitions
join neighbouring words. Forward-backward gives each word's probabilities, so code-switched
texts get a language per word; a text's language is the one with most probability over all its
words that have a letter.

Whether a text is in any of the languages is a measure of its own: the mean log probability of its
characters under trigram models of the languages, for each word the best one's, against a limit from
the labelled sample.

Training: labelled texts, cut into short pieces that are chained in mixed order, so transitions between
languages are seen. ``langtrain.fit_all`` learns from all of them, as the queries do; ``fit`` is a quick model of a bounded
sample. Prediction reads whole texts.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanelux.llm.common import steps, table

#: Weights are hashed to this many rows; a bound of the model's size.
WEIGHT_BITS = 17
#: Training sample: at most this many texts and words per language, and characters of a text.
SAMPLE_TEXTS, SAMPLE_WORDS, SAMPLE_CHARS = 250, 60_000, 20_000
#: Texts and characters of all languages together; many languages have fewer of each.
ALL_TEXTS, ALL_CHARS = 16_000, 40_000_000
#: Languages whose weights fit the driver and a task; more are an error.
MOST_LABELS = 128
#: Chains of a text are at most this long, so one long text is many chains.
CHAIN_WORDS = 256
#: Words whose scores a worker keeps.
KEEP_WORDS = 120_000
#: Bytes of text that a worker tags at once; each word takes some hundred bytes meanwhile.
TAG_STEP = 1 << 20
UNKNOWN = "und"
#: Trigram models: weight of the shorter context in counts, chance of a character never seen, and what a mean
#: over n characters is given for chance (over the root of n).
BACK, RARE, SHORT = 2.0, 1e-5, 3.0


_PUNCTUATION = string.punctuation
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_TURN = np.uint64(0xA0761D6478BD642F)
_LONGEST = 40


def _hashed(kind: int, parts: list[np.ndarray]) -> np.ndarray:
    """Weight rows of features of one kind, each made of the characters at the same place of ``parts``."""
    mixed = np.full(len(parts[0]), kind * 0x51ED270B, np.uint64)
    for k, part in enumerate(parts):
        mixed = (mixed + part) * _ODD[k]
    return (((mixed ^ (mixed >> np.uint64(31))) * _TURN) >> np.uint64(64 - WEIGHT_BITS)).astype(np.int64)


def _table(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all words (weight rows), the words they belong to, and how many each word has.

    A word is taken in lower case, without ASCII signs around it; lower case may make it a little longer
    than ``_LONGEST`` characters. It has a lexicon entry, prefixes and suffixes of one to four characters, and the pairs and triples of
    its characters with marks for its ends.
    """
    low = [w.lower() for w in words]
    cores = [w.strip(_PUNCTUATION) or w for w in low]
    sizes = np.fromiter(map(len, cores), np.int64, len(cores)) + 2
    marked = f"\x02{'\x03\x02'.join(cores)}\x03" if cores else ""
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum(sizes)
    starts, number = ends - sizes, np.arange(len(cores))
    owner = np.repeat(number, sizes)
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    left = np.repeat(sizes, sizes) - place
    flat, owners = [], []
    if len(cores):
        powers = np.multiply.accumulate(np.full(int(sizes.max()), _ODD[0]))
        flat.append(_hashed(1, [np.add.reduceat(codes * powers[place], starts)]))
        owners.append(number)
    for k in (1, 2, 3, 4):
        ok = sizes - 2 >= k
        for kind, first in ((10 + k, starts[ok] + 1), (20 + k, ends[ok] - 1 - k)):
            flat.append(_hashed(kind, [codes[first + j] for j in range(k)]))
            owners.append(number[ok])
    for k in (2, 3):
        first = np.flatnonzero(left >= k)
        flat.append(_hashed(30 + k, [codes[first + j] for j in range(k)]))
        owners.append(owner[first])
    all_owners = np.concatenate(owners)
    return np.concatenate(flat), all_owners, np.bincount(all_owners, minlength=len(cores))


def _scores(weights: np.ndarray, flat: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> np.ndarray:
    # a label's weights in one array are read faster than a column
    sums = np.stack([np.bincount(owner, own[flat], len(counts)) for own in np.ascontiguousarray(weights.T)], axis=1)
    return sums / np.sqrt(np.maximum(1, counts))[:, None]


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Word probabilities of many chains at once, their sums over neighbours, and log likelihood's norm.

    ``scores`` holds the chains' words one after another. Chains are put side by side, longest first,
    and all take a step together; each step is scaled to sum to one.
    """
    n, size = len(lengths), scores.shape[1]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0]) if n else 0
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), "right")  # chains with a word at each step
    top = scores.max(axis=1, keepdims=True)
    local = np.exp(scores - top)
    move, start = np.exp(moves), np.exp(first)
    forward, scale = np.empty_like(local), np.empty(len(local))
    for t in range(longest):
        at = starts[: active[t]] + t
        now = (start if t == 0 else forward[at - 1] @ move) * local[at]
        total = now.sum(axis=1)
        forward[at] = now / total[:, None]
        scale[at] = total
    backward = np.ones_like(local)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        backward[at] = ((backward[at + 1] * local[at + 1]) @ move.T) / scale[at + 1][:, None]
    return forward * backward, forward, backward, local, scale, float((np.log(scale) + top[:, 0]).sum())


def chain_gradients(scores: np.ndarray, gold: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Gradients of the chains' log likelihood by word scores, transitions and start weights."""
    posterior, forward, backward, local, scale, _ = forward_backward(scores, lengths, moves, first)
    gradient = -posterior
    gradient[np.arange(len(gold)), gold] += 1
    ends = np.zeros(len(gold), bool)
    ends[np.cumsum(lengths) - 1] = True
    here = np.flatnonzero(~ends)
    wanted = np.bincount(gold[here] * len(moves) + gold[here + 1], minlength=moves.size).reshape(moves.shape).astype(float)
    after = backward[here + 1] * local[here + 1] / scale[here + 1][:, None]
    wanted -= np.exp(moves) * (forward[here].T @ after)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return gradient, wanted, gradient[begin].sum(axis=0)


def _chains(text: str) -> list[list[str]]:
    """Chains of words; lines end a chain, long lines are cut.

    A word of more than ``_LONGEST`` characters, as in scripts without spaces, is consecutive words of
    at most that many, so all of it has features and weight.
    """
    out = []
    for line in text.split("\n"):
        words = line.split()
        if words and max(map(len, words)) > _LONGEST:
            words = [w[k : k + _LONGEST] for w in words for k in range(0, len(w), _LONGEST)]
        out += [words[k : k + CHAIN_WORDS] for k in range(0, len(words), CHAIN_WORDS)]
    return out


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per character of all words and the end of each: exact keys of contexts and n-grams of one to three; owners.

    The first array has the orders' contexts and n-grams, six rows: 0, c, b, bc, ab, abc.
    """
    cores = [low.strip(_PUNCTUATION) or low for low in map(str.lower, words)]
    sizes = np.fromiter(map(len, cores), np.int64, len(cores)) + 1
    codes = np.frombuffer("".join([c + "\x03" for c in cores]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(cores)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    one = np.where(place >= 1, np.roll(codes, 1), 2)
    two = np.where(place >= 2, np.roll(codes, 2), 2)
    # 21 bits a character; a context has 0 in place of the last one
    rows = [np.zeros_like(codes), codes, one << 21, one << 21 | codes, two << 42 | one << 21, two << 42 | one << 21 | codes]
    return np.stack(rows), owner


def folded(grams: np.ndarray, bits: int) -> np.ndarray:
    """Keys of ``_grams`` hashed to so many bits, so that their tables are bounded."""
    mixed = grams.astype(np.uint64) * _ODD[0]
    return (((mixed ^ (mixed >> np.uint64(31))) * _TURN) >> np.uint64(64 - bits)).astype(np.int64)


class Trigrams:
    """Character models of languages: how well words fit the best of them."""

    #: Bits of folded keys; 0 if keys are exact.
    bits = 0

    def __init__(self, words: list[str], labels: np.ndarray, languages: int):
        """``labels``: the language of each of ``words``."""
        known: dict[str, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
        times = [np.bincount(ids[labels == k], minlength=len(known)) for k in range(languages)]
        grams, owner = _grams(list(known))
        self.tables = []
        for row in grams:
            keys, at = np.unique(row, return_inverse=True)
            counts = np.stack([np.bincount(at, n[owner], len(keys)) for n in times], axis=1)
            none = np.zeros((1, languages))
            self.tables.append((np.append(keys, np.iinfo(np.int64).max), np.append(counts, none, axis=0).astype(np.float32)))

    @classmethod
    def counted(cls, tables: list[tuple[np.ndarray, np.ndarray]], bits: int) -> Trigrams:
        """From sorted keys and counts per language of the six rows of ``_grams``, keys folded to ``bits``."""
        made = cls.__new__(cls)
        made.bits = bits
        made.tables = [
            (np.append(keys, np.iinfo(np.int64).max), np.append(counts, np.zeros((1, counts.shape[1])), axis=0).astype(np.float32))
            for keys, counts in tables
        ]
        return made

    def of(self, words: list[str]) -> np.ndarray:
        """Per word the log probability under the best language, and its characters with the end."""
        parts = [self._of(words[k : k + 8192]) for k in range(0, len(words), 8192)]
        return np.concatenate([np.zeros((0, 2)), *parts])

    def _of(self, words: list[str]) -> np.ndarray:
        grams, owner = _grams(words)
        if self.bits:
            grams = folded(grams, self.bits)
        chance: float | np.ndarray = RARE
        for k in range(0, 6, 2):
            seen, both = (self._counts(grams[j], *self.tables[j]) for j in (k, k + 1))
            chance = (both + BACK * chance) / (seen + BACK)
        logs = np.log(chance)
        sums = np.stack([np.bincount(owner, logs[:, k], len(words)) for k in range(logs.shape[1])], axis=1)
        return np.stack([sums.max(axis=1), np.bincount(owner, minlength=len(words))], axis=1)

    @staticmethod
    def _counts(wanted: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at = np.searchsorted(keys, wanted)
        return np.where((keys[at] == wanted)[:, None], counts[at], 0.0)


def _lettered(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def _plain(word: str) -> bool:
    """A word with a letter and no digit; keys, hashes and addresses often have one and say nothing of a language."""
    return _lettered(word) and not any(map(str.isdigit, word))


def _mean(sums: np.ndarray) -> np.ndarray:
    """Mean log probability from sums of logs and characters; few characters are given more, as chance weighs more."""
    n = np.maximum(1, sums[..., 1])
    return sums[..., 0] / n + SHORT / np.sqrt(n)


def calibrate(texts: list[str], labels: list[str]) -> dict:
    """Trigram models of the sample, and the mean log probability per character that a text must have.

    Every second text is measured by the models of the others. The limit is the lowest hundredth of these
    means less its distance to their median (1 at least), so it is under what labelled texts have. Without
    texts to compare there is no limit.
    """
    names = sorted(set(labels))
    left = dict.fromkeys(names, SAMPLE_WORDS)
    words: list[tuple[list[str], int]] = []
    for text, label in zip(texts, labels, strict=True):
        lettered = [w for c in _chains(text) for w in c if _lettered(w)]
        own = [w for w in lettered if _plain(w)] or lettered
        if own and left[label] > 0:
            left[label] -= len(own)
            words.append((own, names.index(label)))

    def models(chosen: list[tuple[list[str], int]]) -> Trigrams:
        return Trigrams([w for own, _ in chosen for w in own], np.repeat([y for _, y in chosen], [len(own) for own, _ in chosen]), len(names))

    limit = -np.inf
    if len(words) > 1:
        means = [_mean(by.of(own).sum(axis=0)) for k in (0, 1) for by in [models(words[1 - k :: 2])] for own, _ in words[k::2]]
        low, middle = np.quantile(means, [0.01, 0.5])
        limit = float(low - max(1.0, middle - low))
    return {"trigrams": models(words) if words else None, "limit": limit}


def train(texts: list[str], labels: list[str], rounds: int = 14, rate: float = 0.35, decay: float = 2e-6, seed: int = 5) -> dict:
    """Weights, transitions and start weights by adaptive gradient steps on the chains' likelihood."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    known: dict[str, int] = {}
    pieces: list[tuple[np.ndarray, int]] = []
    left = dict.fromkeys(names, SAMPLE_WORDS)
    for text, label in zip(texts, labels, strict=True):
        for words in _chains(text):
            if left[label] <= 0:
                break
            left[label] -= len(words)
            ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
            at = 0
            while at < len(ids):
                step = int(rng.integers(6, 40))
                pieces.append((ids[at : at + step], names.index(label)))
                at += step
    size = len(names)
    weights = np.zeros((1 << WEIGHT_BITS, size))
    moves, first = np.zeros((size, size)), np.zeros(size)
    if pieces:
        flat, owner, counts = _table(list(known))
        scaled = 1 / np.sqrt(np.maximum(1, counts))
        squares, move_squares, first_squares = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8), np.full(size, 1e-8)
        for _ in range(rounds):
            order = rng.permutation(len(pieces))
            for part in np.array_split(order, max(1, len(order) // 4000)):
                chosen = [pieces[k] for k in part]
                words = np.concatenate([p for p, _ in chosen])
                gold = np.repeat([y for _, y in chosen], [len(p) for p, _ in chosen])
                # three pieces make a chain
                lengths = np.array([sum(len(p) for p, _ in chosen[k : k + 3]) for k in range(0, len(chosen), 3)])
                scores = _scores(weights, flat, owner, counts)[words]
                gradient, wanted, first_gradient = chain_gradients(scores, gold, lengths, moves, first)
                per_word = np.stack([np.bincount(words, gradient[:, k], len(known)) for k in range(size)], axis=1)
                per_word *= scaled[:, None]
                step = np.stack(
                    [np.bincount(flat, per_word[owner, k], len(weights)) for k in range(size)], axis=1
                ) - decay * len(words) * weights
                squares += step**2
                weights += rate * step / np.sqrt(squares)
                move_squares += wanted**2
                moves += rate * wanted / np.sqrt(move_squares)
                first_squares += first_gradient**2
                first += rate * first_gradient / np.sqrt(first_squares)
    return {"names": names, "weights": weights.astype(np.float32), "moves": moves, "first": first}


def labelled_rows(docs: DataFrame) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """Rows with a label and a text, and per label their number and characters. More than ``MOST_LABELS`` raise."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    labelled = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    counts = {r["lang"]: (r["n"], r["chars"]) for r in labelled.limit(MOST_LABELS + 1).collect()}
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    return rows, counts


def fit(docs: DataFrame, texts_per_label: int = SAMPLE_TEXTS, seed: int = 3, calibrated: bool = False) -> dict | None:
    """A model of ``docs`` (doc_id, text, lang), also ``calibrated``; None if no row has a label and a text.

    The sample is bounded: of each label, the first ``texts_per_label`` texts in the order of a hash
    of id and text; of a text over ``SAMPLE_CHARS`` characters, a piece of that many, by the hash. Many labels
    have fewer and shorter texts each, so that all together stay under ``ALL_TEXTS`` and ``ALL_CHARS``; no label with
    a text goes. More than ``MOST_LABELS`` labels raise. Only the sample comes to the driver.
    """
    rows, sizes = labelled_rows(docs)
    counts = {k: n for k, (n, _) in sizes.items()}
    if not counts:
        return None
    texts_per_label = min(texts_per_label, ALL_TEXTS // len(counts))
    chars = min(SAMPLE_CHARS, ALL_CHARS // (texts_per_label * len(counts)))
    chance = F.xxhash64(F.lit(seed), "doc_id", "text").bitwiseAND(F.lit((1 << 40) - 1))
    # by far most rows are left out by their hash, before any sort; three times the sample stays
    most = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1 << 40, (3 * texts_per_label << 40) // n))))
    some = rows.withColumn("chance", chance).where(F.col("chance") < most[F.col("lang")])
    pieces = F.ceil(F.length("text") / F.lit(chars))
    some = some.withColumn("text", F.substring("text", (F.col("chance") % pieces * chars + 1).cast("int"), F.lit(chars)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("chance", "text"))
    sample = some.select("lang", "text", "chance", place.alias("place")).where(F.col("place") <= texts_per_label)
    own = sorted((r["lang"], r["place"], r["text"]) for r in sample.select("lang", "place", "text").collect())
    if not own:
        return None
    texts, labels = [t for _, _, t in own], [y for y, _, _ in own]
    return train(texts, labels) | (calibrate(texts, labels) if calibrated else {})


class Tagger:
    """Languages of words and texts under a model; keeps the scores of words met before."""

    def __init__(self, model: dict):
        self._model, self.names = model, model["names"]
        self._known: dict[str, int] = {}
        self._scores = np.zeros((0, len(self.names)))
        self._letters = np.zeros(0, bool)
        self._trigrams = model.get("trigrams")
        self._logs, self._plain = np.zeros((0, 2)), np.zeros(0, bool)

    def _learn(self, new: list[str]) -> None:
        more = _scores(self._model["weights"], *_table(new))
        letters = np.fromiter(map(_lettered, new), bool, len(new))
        if self._trigrams:
            self._logs = np.concatenate([self._logs, self._trigrams.of(new)])
            self._plain = np.concatenate([self._plain, np.fromiter(map(_plain, new), bool, len(new))])
        at = len(self._known)
        self._known.update(zip(new, range(at, at + len(new)), strict=True))
        self._scores, self._letters = np.concatenate([self._scores, more]), np.concatenate([self._letters, letters])

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of all words of the texts, whether each has a letter, and the texts' word counts."""
        return self._tagged(texts)[:3]

    def _tagged(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``words``, and the words' places in what is kept."""
        chains = [_chains(t) for t in texts]
        tokens = list(chain.from_iterable(chain.from_iterable(chains)))
        new = set(tokens)
        if len(self._known) > KEEP_WORDS:
            self._known.clear()
            self._scores, self._letters = self._scores[:0], self._letters[:0]
            self._logs, self._plain = self._logs[:0], self._plain[:0]
        new.difference_update(self._known)
        self._learn(list(new))
        known = self._known
        ids = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        lengths = np.array([len(c) for own in chains for c in own], np.int64)
        counts = np.array([sum(map(len, own)) for own in chains], np.int64)
        if not len(ids):
            return np.zeros((0, len(self.names))), np.zeros(0, bool), counts, ids
        posterior = forward_backward(self._scores[ids], lengths, self._model["moves"], self._model["first"])[0]
        return posterior / posterior.sum(axis=1, keepdims=True), self._letters[ids], counts, ids

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """Per text and language, the mean probability of its words with a letter; zeros without such a word."""
        return self.measured(texts)[0]

    def measured(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ``shares``, and whether each text is in any of the languages, by a calibrated model."""
        posterior, letters, counts, ids = self._tagged([t or "" for t in texts])
        owner = np.repeat(np.arange(len(texts)), counts)[letters]
        fits = np.ones(len(texts), bool)
        if self._trigrams:
            logs, plain = self._logs[ids[letters]], self._plain[ids[letters]]
            # a text without a plain word is measured by all that have a letter
            plain |= np.bincount(owner[plain], minlength=len(texts))[owner] == 0
            sums = np.stack([np.bincount(owner[plain], logs[plain, k], len(texts)) for k in (0, 1)], axis=1)
            fits = _mean(sums) >= self._model["limit"]
        sums = np.stack([np.bincount(owner, posterior[letters, k], len(texts)) for k in range(len(self.names))], axis=1)
        return sums / np.maximum(1, np.bincount(owner, minlength=len(texts)))[:, None], fits


_taggers: dict[str, Tagger] = {}


def _predicted(batches: Iterator[pa.RecordBatch], shared, own: str) -> Iterator[pa.RecordBatch]:
    if own not in _taggers:
        _taggers.clear()
        _taggers[own] = Tagger(shared.value)
    tagger = _taggers[own]
    for batch in steps(batches, "text", TAG_STEP):
        shares, fits = tagger.measured(batch["text"].to_pylist())
        best = shares.argmax(axis=1)
        known = shares.sum(axis=1) > 0
        names = [tagger.names[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist(), strict=True)]
        score = np.where(known, np.minimum(shares.max(axis=1), 1.0), 0.0)
        added = [pa.array(names), pa.array(score), pa.array(fits)][: len(_ADDED) + ("trigrams" in shared.value)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *(*_ADDED, "_lang_fits")[: len(added)]])


_ADDED = ("_lang_pred", "_lang_score")


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with ``_lang_pred`` and ``_lang_score`` (0 to 1), from ``text`` alone, whole texts.

    A null text and one without a letter are ``und`` with score 0, and so is every text without a
    model. Equal texts get equal results; ties go to the first language by name. Repeated rows and
    null ids stay. An empty table gives no rows. Other columns stay as they are. No shuffle. A calibrated
    model also gives ``_lang_fits``: whether the text is in any of the languages.
    """
    if model is None:
        return docs.withColumns({"_lang_pred": F.lit(UNKNOWN), "_lang_score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WEIGHT_BITS and MOST_LABELS
    schema = T.StructType([*docs.schema.fields, T.StructField("_lang_pred", T.StringType()), T.StructField("_lang_score", T.DoubleType())])
    if "trigrams" in model:
        schema = T.StructType([*schema.fields, T.StructField("_lang_fits", T.BooleanType())])
    return docs.mapInArrow(partial(_predicted, shared=shared, own=uuid.uuid4().hex), schema)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    from lanelux.llm.langtrain import fit_all  # it trains with the functions above

    docs = table(spark, sf_dir, "documents")
    learned = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).select("doc_id", "text", "lang")
    rows = predict(docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")), fit_all(learned))
    return rows.select("doc_id", held_out().alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"))

"""Spelling variants: words one edit apart, found in a full-text index of the vocabulary.

One edit leaves a word's first or its second half as it is. So each word is searched twice: its first
half is matched exactly and extended to the right over the second half with one edit, and its second
half is matched exactly and extended to the left over the first. Both begin at a delimiter, so no search
turns round: the first runs in an index of the words read forwards, the second in one of the words read
backwards, which together are the two sides of a bidirectional index.

Each side is cut into shards: ranges of the sorted words, so the words with a given half lie in one or a few
neighbouring shards. A word goes to the shards that its half lies in; a shard that many words ask is repeated
in parts that share them out. Within a shard, a search is an interval of suffix ranks, and searches of many
words go on together.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.llm.common import sized, steps, table
from lanelux.llm.runs import runs, text_bytes
from lanelux.session import settle

LEAST_LENGTH, LEAST_COUNT, TIMES, MARKED = 7, 2, 10, 31
#: Words of a shard, and words whose searches go on together.
SHARD_WORDS, STEP_WORDS = 32_768, 8_192
#: Shards grow beyond this many, so the list of their bounds has a fixed size; bounds are cut to this length.
MOST_SHARDS, BOUND_CHARS = 16_384, 64

_LETTER = np.array([c < 128 and chr(c).isalpha() for c in range(256)])
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF; 0x80 to 0xBF follow


def _counts(batches: Iterator[pa.RecordBatch], least: int, marked: int) -> Iterator[pa.RecordBatch]:
    """Words of the texts with their counts in a step of texts; some occurrences lose a code point by their hash."""
    for batch in steps(batches, "text"):
        data, bounds = text_bytes(batch["text"])
        lead = data == _LEAD
        behind = np.zeros(len(data), bool)
        behind[1:] = lead[:-1]
        found = runs(data, bounds, _LETTER[data] | lead | behind)
        ends = np.append(0, np.cumsum(found.bytes != _LEAD))[found.starts]  # code points before each run
        long = found.only(np.diff(ends) >= least)
        words = long.array().dictionary_encode()
        different, index = words.dictionary.to_pylist(), words.indices.to_numpy()
        heads = [zlib.crc32(b":" if i is None else b"%d:" % i) for i in batch["doc_id"].to_pylist()]
        crc = zlib.crc32
        own = zip(index.tolist(), long.row.tolist(), strict=True)
        hashes = np.fromiter((crc(different[w], heads[row]) for w, row in own), np.int64, len(index))
        hit = hashes % marked == 0
        plain = np.bincount(index[~hit], minlength=len(different))
        total = Counter()
        for w, h in zip(index[hit].tolist(), hashes[hit].tolist(), strict=True):
            word = different[w].decode()
            at = h % len(word)
            total[word[:at] + word[at + 1 :]] += 1
        names = [w.decode() for w in different]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*names, *total], pa.string()),
                pa.array(np.concatenate([plain, np.fromiter(total.values(), np.int64, len(total))]), pa.int64()),
            ],
            ["word", "n"],
        )


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, marked: int = MARKED) -> DataFrame:
    """word and n of all words of the documents with at least so many code points and occurrences."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(partial(_counts, least=least_length, marked=marked), "word string, n long")
    total = found.groupBy("word").agg(F.sum("n").alias("n"))
    return total.where((F.col("n") >= least_count) & (F.char_length("word") >= least_length))


class Index:
    """Suffix ranks of sorted, different words (bytes, one a code point), each between delimiters.

    The text is all words read from their ends, so a step of the backward search extends a match
    to the right in the words as given. An interval of ranks is (low, high).
    """

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        text = np.frombuffer(b"".join(w[::-1] + b"\0" for w in words), np.uint8)
        self.letters, codes = np.unique(text, return_inverse=True)  # the delimiter is code 0
        self.size, self.sigma = len(text), len(self.letters)
        self._code = np.full(256, self.sigma, np.int64)
        self._code[self.letters] = np.arange(self.sigma)
        suffixes = self._suffixes(codes.astype(np.int64))
        self.before = codes[suffixes - 1]
        order = np.argsort(self.before, kind="stable")
        kind = np.int32 if (self.sigma + 1) * (self.size + 1) < 2**31 else np.int64
        self._keys = (self.before[order] * (self.size + 1) + order).astype(kind)
        #: For the rank of each delimiter, the number of the word behind it.
        numbers = np.empty(self.size, np.int64)
        delimiters = np.flatnonzero(codes == 0)
        numbers[delimiters] = np.roll(np.arange(self.n), -1)
        self.word = numbers[suffixes[: self.n]]

    @staticmethod
    def _suffixes(codes: np.ndarray) -> np.ndarray:
        """Places of the text, read round its end, in their order; known length doubles each round."""
        size, base = len(codes), int(codes.max()) + 1
        length, rank = 1, codes
        while base ** (2 * length) < 1 << 40 and length < size:  # several letters are one number at first
            rank = rank * base**length + np.roll(rank, -length)
            length *= 2
        order = np.argsort(rank, kind="stable")
        while True:
            sorted_rank = rank[order]
            new = np.empty(size, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], sorted_rank[1:] != sorted_rank[:-1]]))
            if new.max() == size - 1 or length >= size:
                return order
            rank = new * size + np.roll(new, -length)
            length *= 2
            order = np.argsort(rank, kind="stable")

    def codes(self, letters: np.ndarray) -> np.ndarray:
        """Codes of letters; one that no word has is no code of the index."""
        return self._code[letters]

    def extend(self, low: np.ndarray, high: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with one more letter to the right; empty where there is none."""
        base = (code * (self.size + 1)).astype(self._keys.dtype)
        kind = self._keys.dtype
        return np.searchsorted(self._keys, base + low.astype(kind)), np.searchsorted(self._keys, base + high.astype(kind))

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each interval (its number) the letters that extend it, but the delimiter."""
        there = np.zeros((len(low), self.sigma), bool)
        sizes = high - low
        small = np.flatnonzero(sizes <= 2 * self.sigma)
        own = sizes[small]
        places = np.arange(int(own.sum())) + np.repeat(low[small] - (np.cumsum(own) - own), own)
        there[np.repeat(small, own), self.before[places]] = True
        there[sizes > 2 * self.sigma] = True
        there[:, 0] = False
        return np.nonzero(there)


def near(index: Index, queries: list[bytes], member: np.ndarray, halves: np.ndarray, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query's number and the index's word that is one edit behind the query's half away, each pair once.

    ``halves`` has the length of the part that is matched exactly. ``member`` tells which queries are words
    of the index. Of the words read backwards, those that also share the other half are left out, as the
    search forwards finds them. Of equal letters in a row, the last is the one deleted or inserted.
    """
    sizes = np.fromiter(map(len, queries), np.int64, len(queries))
    begins = np.cumsum(sizes) - sizes
    text = index.codes(np.frombuffer(b"".join(queries) + b"\0", np.uint8))
    letters = np.frombuffer(b"".join(queries) + b"\0", np.uint8)
    places = np.arange(len(letters))
    change = np.concatenate([[True], letters[1:] != letters[:-1]])
    heads = np.zeros(len(letters), bool)
    heads[begins[sizes > 0]] = True
    row = places - np.maximum.accumulate(np.where(change | heads, places, 0)) + 1  # equal letters up to here
    least = np.where(member, 2, 1)  # a member's interval holds itself
    at = np.arange(len(queries))
    low, high = np.zeros(len(at), np.int64), np.full(len(at), index.n, np.int64)
    states: list[tuple[np.ndarray, ...]] = []  # query, letters of it that are done, low, high
    step = 0
    while len(at):
        open_ = step >= halves[at]
        if open_.any():
            q, lo, hi = at[open_], low[open_], high[open_]
            inside, here = step < sizes[q], begins[q] + step
            letter = np.where(inside, letters[here], 0)
            code = np.where(inside, text[here], -1)
            new = np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
            group, c = index.children(lo[new], hi[new])
            clo, chi = index.extend(lo[new][group], hi[new][group], c)
            some = clo < chi
            group, c, clo, chi = group[some], c[some], clo[some], chi[some]
            number = np.cumsum(new) - 1
            counts = np.bincount(group, minlength=int(number[-1]) + 1)
            firsts = np.cumsum(counts) - counts
            own = counts[number]
            who = np.repeat(np.arange(len(q)), own)
            child = np.arange(len(who)) + np.repeat(firsts[number] - (np.cumsum(own) - own), own)
            other = c[child] != code[who]
            who, child = who[other], child[other]
            replaced = inside[who]
            states.append((q[who[replaced]], np.full(int(replaced.sum()), step + 1), clo[child[replaced]], chi[child[replaced]]))
            if backwards:  # inserted where the other half stays as it is
                before = begins[q[who]] + step - 1
                same = (c[child] == text[before]) & (row[before] >= step - halves[q[who]])
                put = (step > halves[q[who]]) & ~same
                who, child = who[put], child[put]
            states.append((q[who], np.full(len(who), step), clo[child], chi[child]))
            last = inside & (letter != np.where(step + 1 < sizes[q], letters[np.minimum(here + 1, len(letters) - 1)], 0))
            if backwards:
                last &= row[here] < step + 2 - halves[q]
            states.append((q[last], np.full(int(last.sum()), step + 1), lo[last], hi[last]))
        more = (step < sizes[at]) & (text[begins[at] + np.minimum(step, sizes[at])] < index.sigma)
        at, low, high = at[more], low[more], high[more]
        low, high = index.extend(low, high, text[begins[at] + step])
        kept = high - low >= least[at]
        at, low, high = at[kept], low[kept], high[kept]
        step += 1
    q, done, low, high = (np.concatenate([s[k] for s in states]) if states else np.zeros(0, np.int64) for k in range(4))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(q):
        ended = done == sizes[q]
        code = np.where(ended, 0, text[begins[q] + np.minimum(done, sizes[q] - 1)])
        known = code < index.sigma
        q, done, ended, low, high, code = q[known], done[known], ended[known], low[known], high[known], code[known]
        low, high = index.extend(low, high, code)
        there = low < high
        found.append((q[there & ended], index.word[low[there & ended]]))
        on = there & ~ended
        q, done, low, high = q[on], done[on] + 1, low[on], high[on]
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(2))


def _latin(words: list[str]) -> list[bytes]:
    return [w.encode("latin-1") for w in words]


def _search(batches: Iterator[pa.RecordBatch], sides: list[bool]) -> Iterator[pa.RecordBatch]:
    """For each word asked in a part of a shard: how many of the shard's words are near, and the best of them.

    Rows come by shard and part, its members first; other words that ask there stream past the index.
    """
    place, members, guests, index = None, [], [], None
    backwards, counts, order, words = False, np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def asked(keys: list[str], member: bool) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(keys), STEP_WORDS):
            part = keys[start : start + STEP_WORDS]
            sizes = np.fromiter(map(len, part), np.int64, len(part))
            halves = sizes - sizes // 2 if backwards else sizes // 2
            q, y = near(index, _latin(part), np.full(len(part), member), halves, backwards)
            best = np.lexsort((order[y], -counts[y], q))
            q, y = q[best], y[best]
            asking, first, n_near = np.unique(q, return_index=True, return_counts=True)
            own, chosen = [part[i] for i in asking.tolist()], y[first]
            columns = [
                pa.array([k[::-1] for k in own] if backwards else own, pa.string()),
                pa.array(n_near, pa.int64()),
                pa.array(counts[chosen], pa.int64()),
                pa.array([words[i] for i in chosen.tolist()], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n_near", "near_n", "near"])

    def settled() -> Iterator[pa.RecordBatch]:
        nonlocal index, counts, order, words
        if members and index is None:
            keys = [key for key, _, _ in members]
            index = Index(_latin(keys))
            counts = np.array([n for _, n, _ in members], np.int64)
            words = [k[::-1] for k in keys] if backwards else keys
            order = np.empty(len(words), np.int64)
            order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
            yield from asked([key for key, _, asks in members if asks], True)
        if guests:
            yield from asked(guests, False)
            guests.clear()

    for batch in batches:
        columns = (batch[name].to_pylist() for name in ("shard", "part", "key", "n", "member", "asks"))
        for shard, part, key, n, member, asks in zip(*columns, strict=True):
            if (shard, part) != place:
                yield from settled()
                place, index, backwards = (shard, part), None, sides[shard]
                members.clear()
            if member:
                members.append((key, n, asks))
            else:
                guests.append(key)
                if len(guests) >= STEP_WORDS:
                    yield from settled()
    yield from settled()


class Routes:
    """Which shards a word asks: those that the words with its exact half lie in."""

    def __init__(self, bounds: list[tuple[bool, int, str, str]]):
        bounds = sorted(bounds, key=lambda b: (b[0], b[2]))
        self.sides = [b[0] for b in bounds]
        self._number = {(side, shard): i for i, (side, shard, _, _) in enumerate(bounds)}
        self._first = {side: bisect_left(self.sides, side) for side in (False, True)}
        own = {side: [b for b in bounds if b[0] is side] for side in (False, True)}
        self._lows = {side: [b[2] for b in own[side]] for side in own}
        self._highs = {side: [b[3] + "\uffff" * (len(b[3]) == BOUND_CHARS) for b in own[side]] for side in own}

    def of(self, backwards: bool, shard: int, key: str) -> tuple[int, range]:
        """The word's own shard and all shards that it asks."""
        half = key[: len(key) - len(key) // 2 if backwards else len(key) // 2]
        first = self._first[backwards]
        start = bisect_left(self._highs[backwards], half)
        return self._number[backwards, shard], range(first + start, first + bisect_right(self._lows[backwards], half + "\uffff"))


def _asked(batches: Iterator[pa.RecordBatch], routes: Routes) -> Iterator[pa.RecordBatch]:
    """How many words of a task ask each shard."""
    total = Counter()
    for batch in batches:
        for own in zip(*(batch[name].to_pylist() for name in ("backwards", "shard", "key")), strict=True):
            total.update(routes.of(*own)[1])
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["shard", "n"])


_ROUTED = pa.schema(
    [
        ("shard", pa.int32()),
        ("part", pa.int32()),
        ("key", pa.string()),
        ("n", pa.int64()),
        ("member", pa.bool_()),
        ("asks", pa.bool_()),
    ]
)


def _routed(batches: Iterator[pa.RecordBatch], routes: Routes, parts: list[int]) -> Iterator[pa.RecordBatch]:
    """Each word as a member of all parts of its shard, and as one that asks a part of each shard with its half."""
    for batch in batches:
        rows = []
        for side, shard, key, n in zip(*(batch[name].to_pylist() for name in ("backwards", "shard", "key", "n")), strict=True):
            home, places = routes.of(side, shard, key)
            dealt = zlib.crc32(key.encode())
            rows += [(home, part, key, n, True, part == dealt % parts[home]) for part in range(parts[home])]
            rows += [(place, dealt % parts[place], key, n, False, True) for place in places if place != home]
        columns = zip(*rows, strict=True) if rows else [()] * len(_ROUTED)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROUTED, strict=True)], schema=_ROUTED)


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """For each of ``words`` (word, n; different words of Latin-1 letters) that has near ones: word, n_near, near_n, near.

    ``near`` is the near word with the largest n, of equal ones the smallest; two words are near if one
    inserted, deleted or replaced code point makes one the other.
    """
    spark = words.sparkSession
    sides = words.select(F.lit(False).alias("backwards"), F.col("word").alias("key"), "n").union(
        words.select(F.lit(True), F.reverse("word"), "n")
    )
    shards = max(1, min(MOST_SHARDS, -(-2 * words.count() // shard_words)))
    ranged = sides.repartitionByRange(shards, "backwards", "key").sortWithinPartitions("backwards", "key")
    ranged = settle(ranged.withColumn("shard", F.spark_partition_id()), "shards")
    low, high = (f(F.substring("key", 1, BOUND_CHARS)) for f in (F.min, F.max))
    bounds = ranged.groupBy("backwards", "shard").agg(low, high).collect()  # at most MOST_SHARDS + 1 rows
    routes = Routes([tuple(b) for b in bounds])
    asked = [0] * len(bounds)
    for shard, n in ranged.mapInArrow(partial(_asked, routes=routes), "shard int, n long").groupBy("shard").agg(F.sum("n")).collect():
        asked[shard] = n
    parts = [max(1, -(-n // (4 * shard_words))) for n in asked]
    schema = "shard int, part int, key string, n long, member boolean, asks boolean"
    routed = ranged.mapInArrow(partial(_routed, routes=routes, parts=parts), schema)
    dealt = routed.repartition(sized(spark, 4 * sum(parts)), "shard", "part")
    ordered = dealt.sortWithinPartitions("shard", "part", F.desc("member"), "key")
    found = ordered.mapInArrow(partial(_search, sides=routes.sides), "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    total = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return total.select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.near").alias("near"))


def _roots(links: DataFrame) -> DataFrame:
    """word and root, from links word and form; each round doubles the way that is done."""
    now = settle(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(onward, "root", "left")
        now = settle(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("_moved")), "roots")
        if now.where("_moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, times: int = TIMES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The words of ``docs`` (doc_id, text) grouped by spelling: word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word, if that is ``times`` as frequent or more; counts then grow
    along forms, so the way from a word to its root has an end. Null and empty texts have no words; a null
    doc_id is read as the empty text; repeated rows count again; words of any length take part; an empty
    table gives no rows. Other columns are not read.
    """
    words = settle(vocabulary(docs), "vocabulary")
    joined = words.join(near_words(words, shard_words), "word", "left")
    formed = F.col("near_n") >= times * F.col("n")
    rows = settle(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("near")).alias("form"),
            F.when(formed, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(rows.where("form is not null"))
    whole = rows.join(roots, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their near words, forms and roots."""
    return variants(table(spark, sf_dir, "documents"))

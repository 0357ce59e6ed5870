"""Passages that repeat across documents, by sparse suffix arrays.

Suffixes are kept only where a window of words chooses its smallest k-gram hash, so equal
passages keep suffixes at equal places, and every passage of ``LONG`` words has one in its
first ``WINDOW`` words. Kept suffixes whose first ``HEAD`` words occur in two texts are sorted
together with the words around them; neighbours are compared and matches are extended to the
right and left. Where neighbours can't settle the left end (three or more different contexts),
all windows of ``LONG`` words over the place are looked up by hash.

A suffix carries the words that can matter: ``REACH`` to the left and ``LONG`` to the right.
Longer matches are covered by the suffixes that follow. Equal texts are one text from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanelux.llm.common import steps, table
from lanelux.session import settle

#: A passage has at least this many words.
LONG = 50
#: Places that a window chooses from, words of a k-gram, and words that a suffix must share.
WINDOW, GRAM = 21, 8
HEAD = LONG - WINDOW + 1
REACH = WINDOW - 1
_TAIL = LONG - HEAD
_KEEP = 200_000

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Words:
    """Hashes of a text's words (A-Z and a-z differ; ASCII white space separates)."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().split()
        known = self._known
        if len(known) > _KEEP:
            known.clear()
        out = [known.get(w) for w in words]
        if None in out:
            for k, w in enumerate(words):
                if out[k] is None:
                    out[k] = known[w] = xxhash.xxh64_intdigest(w)
        return np.array(out, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, the same wherever it stands."""
    n = len(hashes)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * _powers(_BASE, n)[:n])])
    return _mixed((sums[size:] - sums[:-size]) * _powers(_BACK, n)[: n - size + 1])


def _sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``size`` neighbours, by doubling."""
    now, width = values, 1
    while 2 * width <= size:
        now = best(now[:-width], now[width:])
        width *= 2
    more = size - width
    return best(now[: len(now) - more], now[more:]) if more else now


def places(hashes: np.ndarray) -> np.ndarray:
    """Where suffixes are kept: places that are smallest in a window of ``WINDOW`` k-grams and have ``HEAD`` words."""
    if len(hashes) < LONG:
        return np.zeros(0, np.int64)
    grams = _runs(hashes, GRAM)
    least = _sliding(grams, WINDOW, np.minimum)
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least, np.zeros(WINDOW - 1, np.uint64)])
    kept = _sliding(padded, WINDOW, np.maximum) == grams
    return np.flatnonzero(kept[: len(hashes) - HEAD + 1])


_words = Words()


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept suffixes of each text with the hash of their heads; at place -1, the text's number of words."""
    for batch in steps(batches, "text"):
        keys, at, heads = [], [], []
        for key, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
            hashes = _words(text)
            own = places(hashes)
            if len(own):
                keys.append(np.full(len(own) + 1, key))
                at += [[-1], own]
                heads += [[len(hashes)], _runs(hashes, HEAD)[own].view(np.int64)]
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate(at), pa.int32()), pa.array(np.concatenate(heads))],
                ["key", "at", "head"],
            )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each place of a text, hashes of the words to its left (nearest first) and behind its head."""
    names = ["key", "at", "head", "left", "tail"]
    for batch in steps(batches, "text"):
        rows: list[tuple] = []
        for key, text, own in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), batch["places"].to_pylist(), strict=True):
            hashes = _words(text)
            heads = _runs(hashes, HEAD).view(np.int64)
            small = _mixed(hashes).astype(np.uint32)
            for x in own:
                left, tail = small[max(0, x - REACH) : x][::-1], small[x + HEAD : x + LONG]
                rows.append((key, x, int(heads[x]), left.tobytes(), tail.tobytes()))
        if rows:
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            columns = zip(zip(*rows, strict=True), types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)


def _block(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row in equal width, and how many there are."""
    raw = column.to_pylist()
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    out = np.zeros((len(raw), width), np.uint32)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(raw), np.uint32)
    return out, sizes


def _common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words rows of ``a`` and ``b`` share from the start, ``most`` at most."""
    same = np.cumprod(a == b, axis=1).sum(axis=1)
    return np.minimum(same, most)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted contexts to matches: lo and hi words around the place, a partner, and whether they are all there is.

    Rows of one head (a class) may go on in the next batch or partition; what lies at such an edge, or
    has a neighbour of the same text only, is left open (lo and hi null).
    """
    held: pa.RecordBatch | None = None
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        now = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        heads = np.asarray(now["head"])
        # the last class may go on; of a large one, only its last row is held back
        others = np.flatnonzero(heads != heads[-1])
        begin = int(others[-1]) + 1 if len(others) else 0
        if len(heads) - begin > 4096:
            begin = len(heads) - 1
        if begin:
            yield _matched(now.slice(0, begin), heads[begin] if begin < len(heads) else None, first)
            first = False
        held = now.slice(begin)
        if len(held) == 1 and begin and heads[begin - 1] == heads[begin]:
            first = True  # its class was cut, so it is at an edge
    if held is not None and len(held):
        yield _matched(held, np.asarray(held["head"])[-1], first)


def _matched(rows: pa.RecordBatch, next_head, at_start: bool) -> pa.RecordBatch:
    heads, n = np.asarray(rows["head"]), rows.num_rows
    low, high = np.asarray(rows["low"]), np.asarray(rows["high"])
    left, n_left = _block(rows["left"], REACH)
    tail, n_tail = _block(rows["tail"], _TAIL)
    lo, hi, partner = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    own = low != high
    lo[own], hi[own], partner[own] = n_left[own], HEAD + n_tail[own], low[own]
    a, b = np.arange(n - 1), np.arange(1, n)
    joined = heads[a] == heads[b]
    other = joined & ((low[a] != low[b]) | own[a] | own[b])
    right = np.where(joined, HEAD + _common(tail[a], tail[b], np.minimum(n_tail[a], n_tail[b])), 0)
    back = np.where(joined, _common(left[a], left[b], np.minimum(n_left[a], n_left[b])), 0)
    for here, there in ((a, b), (b, a)):
        better = other & ((right > hi[here]) | ((right == hi[here]) & (back > lo[here]))) & ~own[here]
        lo[here[better]], hi[here[better]] = back[better], right[better]
        partner[here[better]] = np.where(low[there] != low[here], low[there], high[there])[better]
    # sizes of classes; one at an edge may be larger
    starts = np.concatenate([[True], ~joined])
    number = np.cumsum(starts) - 1
    size = np.bincount(number)[number]
    edge = np.zeros(n, bool)
    edge[0], edge[-1] = at_start, next_head is not None and heads[-1] == next_head
    edge |= np.isin(number, number[edge])
    same_text = np.zeros(n, bool)
    near = joined & ~other
    same_text[a[near]] = same_text[b[near]] = True
    full = own | (lo == n_left) | (size <= 2)
    open_ = ~own & (edge | same_text | ~full)
    match = (lo + hi >= LONG) & (hi > 0)
    return pa.RecordBatch.from_arrays(
        [
            rows["context"],
            rows["head"],
            pa.array(np.where(match, lo, 0), pa.int32()),
            pa.array(np.where(match, hi, 0), pa.int32()),
            pa.array(partner),
            pa.array(open_),
        ],
        ["context", "head", "lo", "hi", "partner", "open"],
    )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of ``LONG`` words that hold a place in their first ``WINDOW`` words."""
    for batch in batches:
        out: list[tuple] = []
        columns = (batch[c].to_pylist() for c in ("context", "head", "left", "tail", "low", "high"))
        for context, head, left, tail, low, high in zip(*columns, strict=True):
            for j in range(max(0, _TAIL - len(tail) // 4), len(left) // 4 + 1):
                raw = head.to_bytes(8, "little", signed=True) + left[: 4 * j] + tail[: 4 * (_TAIL - j)]
                out.append((context, j, xxhash.xxh64_intdigest(raw, j) - (1 << 63), low, high))
        if out:
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["context", "j", "window", "low", "high"])


def _spans(texts: DataFrame, heads: DataFrame, classes: DataFrame) -> DataFrame:
    """key, start, end and partner (a key) of matches in distinct texts; matches may overlap."""
    heads = heads.where("at >= 0")
    twice = heads.groupBy("head").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("head")
    twice = settle(twice, "heads-of-two")
    # a join of two stored tables, and stored itself: Spark can deal a very common head to many tasks
    used = settle(heads.join(twice, "head").select("key", "at"), "repeated-heads").groupBy("key").agg(F.sort_array(F.collect_set("at")).alias("places"))  # bounded by a text
    used = settle(used.join(classes.select("key", "doc_id"), "key"), "suffix-places")
    some = texts.join(used.hint("shuffle_hash"), ["key", "doc_id"]).select("key", "text", "places")
    around = some.mapInArrow(_contexts, "key long, at int, head long, left binary, tail binary")
    around = around.withColumn("context", F.xxhash64("head", "left", F.lit("|"), "tail"))
    around = settle(around, "suffix-contexts")
    members = around.select("context", "key", "at")
    distinct = around.groupBy("context", "head", "left", "tail").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    distinct = settle(distinct, "distinct-contexts")
    order = ["head", "tail", "left"]
    matched = distinct.repartitionByRange(*order).sortWithinPartitions(*order).select("context", *order, "low", "high")
    schema = "context long, head long, lo int, hi int, partner long, open boolean"
    matched = settle(matched.mapInArrow(_neighbours, schema), "neighbours")
    near = matched.where("hi > 0").select("context", "lo", "hi", "partner")
    left_open = matched.where("open").select("head").distinct()
    windows = distinct.join(left_open, "head", "left_semi").mapInArrow(
        _windows, "context long, j int, window long, low long, high long"
    )
    windows = settle(windows, "windows")
    both = windows.groupBy("window").agg(F.min("low").alias("a"), F.max("high").alias("b")).where("a <> b")
    found = windows.join(both, "window")
    lo = F.col("j")
    found = found.select(
        "context", lo.alias("lo"), (F.lit(LONG) - lo).alias("hi"), F.col("a").alias("partner"), F.col("b").alias("other")
    )
    near = near.withColumn("other", F.col("partner")).unionByName(found)
    # matches of a context all hold its place, so together they are one span
    near = near.groupBy("context").agg(
        F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.min("partner").alias("partner"), F.max("other").alias("other")
    )
    # a context of several texts may be its own partner
    wide = distinct.select("context", "low", "high").where("low <> high")
    near = settle(near.join(wide, "context", "left"), "matches")
    spans = members.join(near, "context")
    partner = F.when(F.col("partner") != F.col("key"), F.col("partner"))
    partner = F.coalesce(partner, F.when(F.col("other") != F.col("key"), F.col("other")))
    partner = F.coalesce(partner, F.when(F.col("low") != F.col("key"), F.col("low")), F.col("high"))
    return spans.select(
        "key", (F.col("at") - F.col("lo")).alias("start"), (F.col("at") + F.col("hi")).alias("end"), partner.alias("partner")
    )


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a text as one, with one of their partners."""
    order = Window.partitionBy("key").orderBy("start", "end")  # spans of one text
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", (before.isNull() | (F.col("start") > before)).cast("int"))
    marked = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("key", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("partner").alias("partner")
    )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Passages of 50 words or more that occur in two rows of ``docs`` (doc_id, text) or more.

    Returns doc_id, start_word, end_word (exclusive), n_words and other_doc_id, a document that has
    (part of) the passage too. Per text, passages that overlap or touch are one row. Words are what
    ASCII white space separates, letter case counts. Rows with equal ids and texts are one document;
    equal texts under different ids are repeated as a whole. Passages that repeat only inside a text
    are not meant. Null, empty and short texts have none. A null id is an id. An empty table gives no
    rows. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text is not null").withColumn("key", F.xxhash64("text"))
    named = settle(rows.select("doc_id", "key").distinct(), "text-keys")
    id_ = F.coalesce("doc_id", F.lit(-(1 << 62)))
    classes = named.groupBy("key").agg(F.min(id_).alias("doc_id"), F.max(id_).alias("last"))
    classes = settle(classes, "text-classes")
    texts = rows.select("key", id_.alias("doc_id"), "text").where(F.length("text") >= 2 * LONG - 1)
    heads = settle(texts.mapInArrow(_heads, "key long, at int, head long"), "suffix-heads")
    spans = _merged(_spans(texts, heads, classes)).select("key", "start", "end", "partner")
    sizes = heads.where("at < 0").select("key", F.col("head").cast("int").alias("end")).distinct()
    whole = sizes.join(classes.where("doc_id <> last").select("key"), "key")
    whole = whole.select("key", F.lit(0).alias("start"), "end", F.col("key").alias("partner"))
    copied = whole.select("key").withColumn("copied", F.lit(True))
    spans = spans.join(copied, "key", "left_anti").unionByName(whole)
    first = classes.select(F.col("key").alias("partner"), F.col("doc_id").alias("first_id"), "last")
    spans = spans.join(first, "partner")
    own = named.select("key", id_.alias("_id")).join(spans, "key")
    other = F.when(F.col("first_id") != F.col("_id"), F.col("first_id")).otherwise(F.col("last"))
    null_id = lambda c: F.when(c != -(1 << 62), c)
    return own.select(
        null_id(F.col("_id")).alias("doc_id"),
        F.col("start").cast("long").alias("start_word"),
        F.col("end").cast("long").alias("end_word"),
        (F.col("end") - F.col("start")).cast("long").alias("n_words"),
        null_id(other).alias("other_doc_id"),
    )


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that other documents have too."""
    return repeated_passages(table(spark, sf_dir, "documents"))

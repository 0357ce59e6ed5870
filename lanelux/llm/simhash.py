"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A fingerprint is cut into blocks. Two fingerprints that differ in at most ``distance``
bits have at least ``blocks - distance`` equal blocks, so each fingerprint is entered
under every choice of that many blocks, and only fingerprints with a common entry are
compared. Equal fingerprints are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.llm.common import steps, table
from lanelux.llm.components import roots
from lanelux.session import settle

BITS = 64
SHINGLE = 4
DISTANCE = 4
#: Blocks per fingerprint: two of six are equal, so an entry has about 21 bits.
BLOCKS = 6
SEED = 42
#: Shingles that are hashed at once, and fingerprints that a task compares at once.
_AT_ONCE = 200_000
_TILE = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole text as an unsigned integer; zero without a word.

    A-Z are lower-cased; words are what ASCII white space separates; a text with fewer words than a
    shingle is one shingle. A bit is set if more than half the shingles' XXH64 have it.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    wide = min(shingle, len(words))
    starts, ends = starts[: len(words) - wide + 1], ends[wide - 1 :]
    counts, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _AT_ONCE):
        places = zip(starts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in places], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text"):
        prints = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["place"], pa.array(prints)], ["doc_id", "place", "print"]
        )


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, ``place`` (a hash of the text) and ``print``, the fingerprint as a signed 64-bit integer, of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("place", F.xxhash64("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id long, place long, print long")


def _entries(column: str, blocks: int, distance: int):
    """An array of all entries of a fingerprint: the choice's number and the chosen bits."""
    width, more = divmod(BITS, blocks)
    masks, at = [], 0
    for k in range(blocks):
        bits = width + (k < more)
        masks.append(((1 << bits) - 1) << at)
        at += bits
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    chosen = [sum(c) for c in combinations(masks, blocks - distance)]
    return F.array(
        *(
            F.struct(F.lit(k).alias("choice"), F.col(column).bitwiseAND(F.lit(signed(m)).cast("long")).alias("bits"))
            for k, m in enumerate(chosen)
        )
    )


def _linked(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """From each row's fingerprints, links that connect those within ``distance`` bits, as few as a forest needs.

    A row has the fingerprints of one part of an entry (``own``) and those of another part (``other``;
    null if there is only one part). Rows of two fingerprints are compared together.
    """
    for batch in batches:
        own, other = batch["own"], batch["other"]
        sizes = np.asarray(pc.list_value_length(own))
        lone = np.asarray(pc.is_null(other)) & (sizes == 2)
        out_u, out_v = [], []
        if lone.any():
            pairs = np.asarray(own.filter(pa.array(lone)).flatten()).reshape(-1, 2)
            near = np.bitwise_count((pairs[:, 0] ^ pairs[:, 1]).view(np.uint64)) <= distance
            out_u.append(pairs[near, 0])
            out_v.append(pairs[near, 1])
        for row in np.flatnonzero(~lone).tolist():
            a = np.asarray(own[row].values)
            b = np.asarray(other[row].values) if other[row].is_valid else None
            u, v = forest(a, b, distance)
            out_u.append(u)
            out_v.append(v)
        if out_u:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], ["u", "v"])


def forest(a: np.ndarray, b: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``distance`` bits inside ``a``, or between ``a`` and ``b``, without those that close a ring.

    Walks from fingerprint to fingerprint; one that was met is compared with no more starts.
    """
    left = [np.unique(a)] * 2 if b is None else [np.unique(a), np.unique(b)]
    one = b is None
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(left[0]):
        waiting = [(left[0][0], 0)]
        left[0] = left[0][1:]
        while waiting:
            now, side = waiting.pop()
            other = 0 if one else 1 - side
            near = np.bitwise_count((left[other] ^ now).view(np.uint64)) <= distance
            if near.any():
                met = left[other][near]
                left[other] = left[other][~near]
                waiting += [(x, other) for x in met]
                u.append(np.full(len(met), now))
                v.append(met)
    return np.concatenate(u), np.concatenate(v)


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = _TILE) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (``print``) within ``distance`` bits.

    An entry with more than ``tile`` fingerprints is cut into parts by a hash, and each pair of parts
    is a task's row of its own, so no row grows with the entry.
    """
    keyed = prints.select("print", F.explode(_entries("print", blocks, distance)).alias("entry"))
    keyed = keyed.select(F.col("entry.choice").alias("choice"), F.col("entry.bits").alias("bits"), "print")
    counts = keyed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keyed.join(counts, ["choice", "bits"])
    parts = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("print"), parts).cast("int")
    shared = shared.select("choice", "bits", "print", parts.alias("parts"), own.alias("part"))
    cells = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.least(p, "part").alias("i"), F.greatest(p, "part").alias("j")),
    )
    dealt = shared.select("choice", "bits", "print", "part", F.explode(cells).alias("cell"))
    low, high = F.col("part") == F.col("cell.i"), F.col("part") == F.col("cell.j")
    grouped = dealt.groupBy("choice", "bits", "cell").agg(
        F.collect_list(F.when(low, F.col("print"))).alias("own"),
        F.when(F.col("cell.i") < F.col("cell.j"), F.collect_list(F.when(high, F.col("print")))).alias("other"),
    )
    return grouped.select("own", "other").mapInArrow(partial(_linked, distance=distance), "u long, v long").distinct()


def components(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Per distinct ``print`` of ``prints`` (doc_id, print): component_id, and ``root``, a print that names the component."""
    distinct = settle(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    joined = roots(links(distinct.select("print"), distance, blocks))
    named = distinct.join(joined.withColumnRenamed("u", "print").withColumnRenamed("v", "root"), "print", "left")
    named = named.withColumn("root", F.coalesce("root", "print"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("print", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links reach. Null and empty texts have fingerprint zero
    and link like others. A null doc_id is never the smallest; a component of null ids alone has a null
    id. Repeated rows stay. An empty table gives no rows. Other columns are not read.
    """
    prints = settle(fingerprints(docs, shingle), "fingerprints")
    return prints.join(components(prints, distance, blocks), "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def kept(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """One row of ``docs`` (doc_id, text and others) per component, that of its smallest doc_id.

    Rows that share that id are told apart by a hash of their text, of which the smallest stays; rows
    that are equal in both stay one row. A component of null ids alone keeps one row too.
    """
    place = F.xxhash64(F.col("text").cast("string"))
    prints = settle(fingerprints(docs, shingle), "fingerprints")
    named = prints.join(components(prints, distance, blocks), "print")
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place")).alias("own"))
    first = settle(first.select(F.col("own.doc_id").alias("_id"), F.col("own.place").alias("_place")).distinct(), "kept")
    named = docs.withColumn("_place_", place)
    same = F.col("_id").eqNullSafe(named["doc_id"].cast("long")) & (F.col("_place") == F.col("_place_"))
    rows = named.join(first.hint("shuffle_hash"), same, "left_semi")
    return rows.dropDuplicates(["doc_id", "_place_"]).drop("_place_")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose fingerprints differ in at most four bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))

"""Packing token ids into sequences of fixed length.

Documents are dealt to groups by a hash. In each group, full-length pieces are
sequences of their own; what is left of each document is packed by first-fit
decreasing, with a tournament tree over the room in the bins. Poorly filled bins
are then cut up to fill the gaps in the others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.llm.common import parallelism, steps, table
from lanelux.llm.tokens import BYTE_BPE, TOKEN_STEP, Vocabulary, encoder

LENGTH = 1024
END_ID = 0
#: Groups that a task packs on average, where there are more than the cluster has tasks.
GROUPS_PER_TASK = 16

_FIELDS = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
]


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; each item goes to the first bin with room, largest items first.

    The tree's leaves are the bins' rooms, each inner node holds the larger of its
    two children, so the first bin with room is found from the root down.
    """
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size, node = sizes[item], 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(item)
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins


def padding(fill: int, length: int = LENGTH) -> int:
    """Positions that a sequence is padded by; none where its length is a power of two."""
    return 0 if fill & (fill - 1) == 0 else length - fill


def fill_gaps(bins: list[list[tuple[int, int, int]]], length: int, least: int) -> list[list[tuple[int, int, int]]]:
    """Cut the emptiest bins' pieces (item, start, length) to fill gaps of ``least`` or more in the others.

    What is then left in a bin that others were filled from is cut to sequences whose lengths are
    powers of two, which need no padding.
    """
    order = sorted(range(len(bins)), key=lambda b: -sum(p[2] for p in bins[b]))
    out, at, last = [], 0, len(order) - 1
    while at <= last:
        own = bins[order[at]]
        fill = sum(p[2] for p in own)  # others may have been filled from it
        while at < last and padding(fill, length) >= least:
            item, start, size = bins[order[last]].pop()
            take = min(size, length - fill)
            own.append((item, start, take))
            fill += take
            if take < size:
                bins[order[last]].append((item, start + take, size - take))
            if not bins[order[last]]:
                last -= 1
        if at == last and padding(fill, length) >= least:
            while own:
                want, part = 1 << (sum(p[2] for p in own).bit_length() - 1), []
                while want:
                    item, start, size = own.pop()
                    take = min(size, want)
                    part.append((item, start, take))
                    want -= take
                    if take < size:
                        own.append((item, start + take, size - take))
                out.append(part)
        else:
            out.append(own)
        at += 1
    return out


def _pack(batches: Iterator[pa.RecordBatch], length, end_id, vocabulary, path, group_docs, least, with_ids):
    encode, end = encoder(vocabulary, path).encode, end_id.to_bytes(4, "little")
    names = [n for n, _ in _FIELDS] + ["ids"] * with_ids
    types = [t for _, t in _FIELDS] + [pa.binary()] * with_ids
    rows: list[list] = [[] for _ in names]

    def put(doc_id, start, ids, doc_tokens, sequence, offset):
        own = (doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, sequence, offset, ids)
        for column, value in zip(rows, own, strict=False):
            column.append(value)

    def flushed():
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names)
        for column in rows:
            column.clear()
        return out

    group, sequence, rest = None, 0, []

    def settled():
        """Pack what is left of the group's documents so far."""
        nonlocal sequence
        bins = [[(i, 0, len(rest[i][2]) // 4) for i in b] for b in first_fit_decreasing([len(r[2]) // 4 for r in rest], length)]
        for own in fill_gaps(bins, length, least):
            offset = 0
            for item, start, size in own:
                doc_id, before, ids, doc_tokens = rest[item]
                put(doc_id, before + start, ids[4 * start : 4 * (start + size)], doc_tokens, (group << 32) + sequence, offset)
                offset += size
            sequence += 1
        rest.clear()

    for batch in steps(batches, "text", TOKEN_STEP):
        columns = batch["doc_id"].to_pylist(), batch["_group"].to_pylist(), encode(batch["text"])
        for doc_id, own_group, ids in zip(*columns, strict=True):
            if own_group != group:
                settled()
                group, sequence = own_group, 0
            elif len(rest) >= 2 * group_docs:
                settled()
            ids += end
            n = len(ids) // 4
            for start in range(0, n - n % length, length):
                put(doc_id, start, ids[4 * start : 4 * (start + length)], n, (group << 32) + sequence, 0)
                sequence += 1
            if n % length:
                rest.append((doc_id, n - n % length, ids[4 * (n - n % length) :], n))
        if len(rows[0]) >= 20_000:
            yield flushed()
    settled()
    if rows[0]:
        yield flushed()


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    end_id: int = END_ID,
    vocabulary: Vocabulary = BYTE_BPE,
    tokenizer_path: str | None = None,
    group_docs: int = 2048,
    least_piece: int = 4,
    seed: int = 7,
    with_ids: bool = False,
) -> DataFrame:
    """Pack the ids of ``docs`` (doc_id, text) into sequences of at most ``length`` ids.

    A document is its ids and ``end_id``; a null or empty text is the end id alone. Returns one row
    per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for,
    the ids. Documents are dealt to groups of about ``group_docs`` by a hash of id, text and place, so neither
    one id or source nor repeated rows gather in a group; a group is packed in parts of at most
    twice that many documents, so memory stays bounded. Every row is packed, null ids too. An empty
    table gives no rows. Other columns are not read. Gaps under ``least_piece`` stay.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    groups = max(1, -(-rows.count() // group_docs))
    place = F.monotonically_increasing_id()
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text", place), F.lit(groups)))
    parts = max(parallelism(docs.sparkSession), -(-groups // GROUPS_PER_TASK))
    ordered = dealt.repartition(parts, "_group").sortWithinPartitions("_group")
    schema = ", ".join(f"{n} long" for n, _ in _FIELDS) + (", ids binary" if with_ids else "")
    run = partial(
        _pack,
        length=length,
        end_id=end_id,
        vocabulary=vocabulary,
        path=tokenizer_path,
        group_docs=group_docs,
        least=least_piece,
        with_ids=with_ids,
    )
    return ordered.mapInArrow(run, schema)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    return pack(table(spark, sf_dir, "documents"))

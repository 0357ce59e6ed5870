"""Token-ID output: documents as seekable token files, and reading them back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanelux.llm import frames
from lanelux.llm.common import sized, steps, table
from lanelux.llm.tokens import TOKEN_STEP, WORD_BPE, Vocabulary, encoder
from lanelux.session import scratch_path, settle

END_ID = 2

_FILES = "part int, file int, path string, n_docs long, n_tokens long"
_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """The shared file system of ``folder`` as Python workers see it (file, s3, gs, hdfs, ...)."""
    return fs.FileSystem.from_uri(folder)


def _write(batches: Iterator[pa.RecordBatch], folder: str, end_id: int, vocabulary, path, file_bytes: int):
    """One file after another; the name is new for each attempt, so a repeated task harms no file."""
    system, root = _place(folder)
    system.create_dir(root, recursive=True)
    encode, part, n = encoder(vocabulary, path).encode, TaskContext.get().partitionId(), 0
    end, writer, name = end_id.to_bytes(4, "little"), None, ""

    def closed():
        writer.close()
        own = ([part], [n], [name], [writer.documents], [writer.tokens])
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(own, types, strict=True)], ["part", "file", "path", "n_docs", "n_tokens"]
        )

    for batch in steps(batches, "text", TOKEN_STEP):
        for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode(batch["text"]), strict=True):
            if writer is None:
                name = f"{part:06d}-{n:04d}-{uuid.uuid4().hex}.zst"
                writer = frames.Writer(system.open_output_stream(f"{root}/{name}", compression=None))
            writer.add(doc_id, ids + end)
            if writer.bytes >= file_bytes or writer.documents >= 1_000_000:
                yield closed()
                writer, n = None, n + 1
    if writer is not None:
        yield closed()


def write_token_files(
    docs: DataFrame,
    folder: str,
    end_id: int = END_ID,
    vocabulary: Vocabulary = WORD_BPE,
    tokenizer_path: str | None = None,
    file_bytes: int = 64 << 20,
) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) to files in ``folder``; returns the stored list of files.

    Files and the documents in them are in ascending ``doc_id`` order (null first; rows with the
    same id by a hash of the text). A null or empty text gives the end id alone. Repeated rows are
    kept. An empty table gives no file. Other columns are not read. The list has one row per file:
    part and file (their order), path (in ``folder``), n_docs, n_tokens; files that it does not
    name are left from tasks that were repeated.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange("doc_id", "_tie")
    write = partial(
        _write, folder=folder, end_id=end_id, vocabulary=vocabulary, path=tokenizer_path, file_bytes=file_bytes
    )
    files = ordered.sortWithinPartitions("doc_id", "_tie").select("doc_id", "text").mapInArrow(write, _FILES)
    return settle(files, "token-files")


def _read(batches: Iterator[pa.RecordBatch], folder: str):
    system, root = _place(folder)
    for batch in batches:
        for name, before in zip(batch["path"].to_pylist(), batch["tokens_before"].to_pylist(), strict=True):
            with system.open_input_file(f"{root}/{name}") as file:
                reader = frames.Reader(file)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_ids, pa.int64()),
                        pa.array(reader.starts[:-1] + before, pa.int64()),
                        pa.array(reader.counts, pa.int64()),
                        pa.array(reader.checksums(), pa.int64()),
                    ],
                    schema=_ROWS,
                )


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """Per document of the listed files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = files.sparkSession
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("tokens_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))
    dealt = placed.select("path", "tokens_before").repartition(sized(spark, files.count()), "path")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return dealt.mapInArrow(partial(_read, folder=folder), schema)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    folder = scratch_path(spark, "tokens")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), folder), folder)

"""Incremental load of survey files with Structured Streaming.

The stream is one of listings: each run lists the folder tree, adds the files it has not listed before to a
stored listing, and the stream reads that. So files without a byte are seen as well. Which file has a name
first is kept in the stream's state, by name and year. The stream takes many batches at a time and only stores
what it decides of each; the files of many batches are then read by one load.
"""

from __future__ import annotations

import datetime
import fnmatch
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lanelux.operators.ledger import check_names
from lanelux.operators.order import numbered
from lanelux.operators.survey import accepted, import_rows, rejected
from lanelux.session import settle
from lanelux.sources.catalog import list_tree, tree_files
from lanelux.sources.survey_files import WHOLE_FILE_BYTES, scan_files

# Fixed value: the outcome of a file whose name another file had first.
NAME_TAKEN = "name taken"

_LISTED = "path string, name string, report_year int, candidate boolean, part int"
_DECIDED = "path string, taken boolean, part int"
_SHUFFLES = "spark.sql.shuffle.partitions"
#: Files that one load names to Spark's readers; a single batch may have more.
FILES_PER_LOAD = 4000
#: Files of whole batches that the stream decides on at a time; a single batch may have more.
FILES_PER_STEP = 4000
#: Numbers that a step of the stream has for its batches. Stored tables hold numbers made with it, so it stays.
_NUMBERS = 10_000
#: Tasks that share the state, one row per name. Each batch runs and stores all of them, so their number
#: is that of a batch's few rows and not that of the tables' shuffles; a checkpoint keeps the number it began with.
STATE_TASKS = 4
#: Listed files that one task writes.
LISTED_PER_TASK = 10_000


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def add_listing(
    spark: SparkSession,
    root: str,
    listing: str,
    report_year: int,
    pattern: str = "*.xls",
    files_per_batch: int = 1000,
    name: Callable[[Column], Column] = file_name,
) -> int:
    """Add the files below ``root`` that ``listing`` lacks to it; returns how many.

    Of new files with one name, the first path is the candidate for it. A batch has ``files_per_batch`` files, the
    last one what is left. A stored file holds whole batches, up to ``FILES_PER_STEP`` rows, and ``part`` tells them
    apart; the stream takes one stored file at a time.
    """
    named = F.col("name").rlike(r"\A" + fnmatch.translate(pattern))
    files = tree_files(list_tree(spark, root)).where(named).select("path", name(F.col("path")).alias("name"))
    try:
        known = spark.read.schema(_LISTED).parquet(listing).select("path")
        files = files.join(known, "path", "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    new = numbered(files, ["path"])
    first = new.groupBy("name").agg(F.min("path").alias("_first"))
    batches = min(max(FILES_PER_STEP // files_per_batch, 1), _NUMBERS)  # of a stored file
    at, step_rows = F.col("place") - 1, files_per_batch * batches
    rows = new.join(first, "name").select(
        "path",
        "name",
        F.lit(report_year).alias("report_year"),
        (F.col("path") == F.col("_first")).alias("candidate"),
        F.floor(at % step_rows / files_per_batch).cast("int").alias("part"),
        "place",
    )
    n = new.count()
    if n:
        # Each step is full but the last, so files of that many rows end where steps end.
        tasks = -(-n // max(step_rows, LISTED_PER_TASK))
        steps = rows.repartition(tasks, F.floor(at / step_rows)).sortWithinPartitions("place").drop("place")
        steps.write.mode("append").option("maxRecordsPerFile", step_rows).parquet(listing)
    return n


def _decide(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The first candidate of a name and year takes it, for good; the path that has it keeps it."""
    rows = pd.concat(parts).sort_values("path")
    if not state.exists and rows["candidate"].any():
        state.update((rows.loc[rows["candidate"], "path"].iloc[0],))
    holder = state.get[0] if state.exists else None
    yield pd.DataFrame({"path": rows["path"], "taken": rows["path"] == holder, "part": rows["part"].astype("Int32")})


def first_of_name(files: DataFrame) -> DataFrame:
    """Path and part of ``files`` (as listed; a stream) with ``taken``: whether the file is the first of its name and year."""
    grouped = files.groupBy("name", "report_year")
    return grouped.applyInPandasWithState(_decide, _DECIDED, "holder string", "append", GroupStateTimeout.NoTimeout)


@contextmanager
def _shuffled_by(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Queries started inside shuffle to at most so many tasks."""
    before = spark.conf.get(_SHUFFLES)
    spark.conf.set(_SHUFFLES, min(tasks, int(before)))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES, before)


def _plain(path: Column) -> Column:
    """A path in one spelling; Spark's readers have two for local files."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What is stored at ``path``, without a row if nothing is yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _decisions(spark: SparkSession, table: str, numbers: list[int] | None = None) -> DataFrame:
    """What is decided of each file, with the number of its batch; of the batches named, or of all.

    The folder ``batch=<n>`` has the decisions of step n of the stream. Steps of earlier versions were one batch,
    listed without a part; their number is that of the batch.
    """
    steps = _stored(spark, f"{table}_decided", f"{_DECIDED}, batch bigint").withColumnRenamed("batch", "step")
    number = F.coalesce(F.col("step") * _NUMBERS + F.col("part"), F.col("step"))
    decided = steps.withColumn("batch", number)
    if numbers is not None:
        # Folders of other steps are not read.
        decided = decided.where(F.col("step").isin(sorted({*numbers, *(n // _NUMBERS for n in numbers)})))
        decided = decided.where(F.col("batch").isin(numbers))
    return decided.select("path", "taken", "batch")


def _pending(spark: SparkSession, table: str, files_per_load: int) -> list[list[int]]:
    """Numbers of the batches that are decided and not loaded, in groups of at most so many files or one batch."""
    decided = _decisions(spark, table)
    left = decided.groupBy("batch").count().join(_stored(spark, f"{table}_loaded", "batch bigint"), "batch", "left_anti")
    groups, held = [], 0
    for number, n in sorted(tuple(r) for r in left.collect()):
        if not groups or held + n > files_per_load:
            groups.append([])
            held = 0
        groups[-1].append(number)
        held += n
    return groups


def _load(
    spark: SparkSession,
    table: str,
    numbers: list[int],
    read_at: datetime.datetime,
    pattern: str,
    whole_file_bytes: int,
    conform_only: bool,
) -> None:
    """Read the files of decided batches and replace these batches' partitions of the three tables."""

    def store(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    decided = _decisions(spark, table, numbers)
    named = [(r["path"], r["taken"]) for r in decided.select("path", "taken").collect()]
    paths = [path for path, taken in named if taken]
    # Where every file is refused, one of them gives the schema.
    headers, rows = scan_files(spark, paths or [named[0][0]], pattern=pattern, whole_file_bytes=whole_file_bytes)
    if not paths:
        headers, rows = headers.limit(0), rows.limit(0)
    refused = decided.where("not taken").select(F.col("path").alias("bestands_url"), F.lit(NAME_TAKEN).alias("outcome"))
    headers = headers.unionByName(refused, allowMissingColumns=True)
    owners = F.broadcast(decided.select(_plain(F.col("path")).alias("_path"), "batch"))  # at most the files of a load

    def owned(df: DataFrame) -> DataFrame:
        return df.join(owners, _plain(F.col("bestands_url")) == F.col("_path")).drop("_path")

    parts = F.split("bestands_url", "/")
    files = headers.withColumns(
        {
            "drive_file_name": F.element_at(parts, -1),
            "drive_folder_name": F.element_at(parts, -2),
            "measure_series_name": F.col("meting_serie_naam"),
        }
    )
    logged = settle(owned(check_names(files).drop("measure_series_name", "columns")), "stream-headers")
    store(logged.repartition("batch"), f"{table}_files")  # a batch has one row per file
    if conform_only:
        rows = rows.join(logged.where("name_conform").select("bestands_url"), "bestands_url", "left_semi")
    imported = settle(owned(import_rows(rows, read_at)), "stream-batch")
    # Ranged, so that a task has few batches and a batch few files, however large it is.
    for some, path in ((rejected(imported), f"{table}_rejected"), (accepted(imported, "batch"), table)):
        store(some.repartitionByRange("batch", "bestands_url", "line_no"), path)
    done = spark.createDataFrame([(n,) for n in numbers], "batch bigint")
    done.coalesce(1).write.mode("append").parquet(f"{table}_loaded")


def start_ingest(
    spark: SparkSession,
    root: str,
    table: str,
    checkpoint: str,
    read_at: datetime.datetime,
    pattern: str = "*.xls",
    files_per_batch: int = 1000,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    conform_only: bool = False,
    report_year: int | None = None,
    name: Callable[[Column], Column] = file_name,
) -> StreamingQuery:
    """Load the files that came since the last run, then stop.

    Three tables are written: ``table`` has the sound lines, ``<table>_rejected``
    the others with their faults, ``<table>_files`` one row per file with its
    outcome and whether file and folder name agree with the series name;
    ``<table>_listing`` holds the paths seen. A file
    whose ``name`` (of its path) another file of the same ``report_year`` (of ``read_at``, if not given) had
    before is not read; its outcome is ``NAME_TAKEN``. A file without a byte has an outcome and
    a name like any other. With
    ``conform_only``, lines of files whose names do not agree are left out, as
    the yearly run does. The
    checkpoint remembers the listing read and the names. The stream goes in steps of whole batches, up to
    ``FILES_PER_STEP`` files; a step stores which of its files are taken in
    ``<table>_decided``. When the stream is through, the files of all batches that ``<table>_loaded`` lacks are
    read, ``FILES_PER_LOAD`` at a time, also those of a run that failed before. A step owns its folder of decisions
    and a batch the partition with its number in each table, so a step that is decided or a batch that is loaded
    again after a failure replaces itself. The call returns when all is loaded.
    """
    listing = f"{table}_listing"
    add_listing(spark, root, listing, report_year or read_at.year, pattern, files_per_batch, name)

    def decide(step: DataFrame, number: int) -> None:
        # One small file for the rows of one file of the listing.
        step.repartition(1).write.mode("overwrite").parquet(f"{table}_decided/batch={number}")

    stream = spark.readStream.schema(_LISTED).option("maxFilesPerTrigger", 1).parquet(listing)
    writer = first_of_name(stream).writeStream.foreachBatch(decide).option("checkpointLocation", checkpoint)
    with _shuffled_by(spark, STATE_TASKS):  # a started query has its own copy of the settings
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    for numbers in _pending(spark, table, FILES_PER_LOAD):
        _load(spark, table, numbers, read_at, pattern, whole_file_bytes, conform_only)
    return query

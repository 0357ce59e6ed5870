"""Writers of the stored tables and exports."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import partial
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.operators.survey import normalized_line
from lanelux.session import file_system, remove
from lanelux.sources import catalog


#: A pointer's name: year, number, what it does to the year's rows, and the folder it names.
_POINTER = re.compile(r"report_year=(-?\d+)\.(\d{12})\.(set|add)\.([0-9a-f]{32})")


@dataclass(frozen=True)
class Pointer:
    """One step in the life of a year: ``set`` replaces its rows by those of a folder, ``add`` adds them."""

    year: int
    number: int
    what: str
    version: str

    @property
    def name(self) -> str:
        return f"report_year={self.year}.{self.number:012d}.{self.what}.{self.version}"

    def folder(self, path: str) -> str:
        return f"{path}/versions/report_year={self.year}/version={self.version}"


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, place = file_system(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def pointers(spark: SparkSession, path: str, report_year: int | None = None) -> list[Pointer]:
    """All steps of a year, or of all years, in order."""
    found = [m for m in map(_POINTER.fullmatch, _names(spark, f"{path}/current")) if m]
    steps = [Pointer(int(m[1]), int(m[2]), m[3], m[4]) for m in found]
    return sorted(
        (p for p in steps if report_year is None or p.year == report_year), key=lambda p: (p.year, p.number, p.version)
    )


def in_force(steps: list[Pointer]) -> list[Pointer]:
    """Of the steps of one year, the last that replaced its rows and those that added to it."""
    last = max((i for i, p in enumerate(steps) if p.what == "set"), default=0)
    return steps[last:]


def _point(spark: SparkSession, path: str, pointer: Pointer) -> None:
    """Write a pointer: an empty file that says all by its name, so it is there as a whole or not at all."""
    system, place = file_system(spark, f"{path}/current/{pointer.name}")
    system.create(place, False).close()


def _step(df: DataFrame, path: str, report_year: int, what: str) -> list[Pointer]:
    """Write the rows to a folder of their own, then the pointer to it; returns the year's steps before."""
    spark = df.sparkSession
    steps = pointers(spark, path, report_year)
    new = Pointer(report_year, steps[-1].number + 1 if steps else 1, what, uuid.uuid4().hex)
    df.write.parquet(new.folder(path))
    _point(spark, path, new)
    return steps


def _clear(spark: SparkSession, path: str, report_year: int, kept: list[Pointer]) -> None:
    """Remove the folders of a year that none of ``kept`` names, then their pointers."""
    year = f"{path}/versions/report_year={report_year}"
    named = {f"version={p.version}" for p in kept}
    for name in _names(spark, year):
        if name not in named:
            remove(spark, f"{year}/{name}")
    for p in pointers(spark, path, report_year):
        if f"version={p.version}" not in named:
            remove(spark, f"{path}/current/{p.name}")


def refresh(df: DataFrame, path: str, report_year: int) -> None:
    """Replace the rows of one report year and leave other years alone.

    The new rows are written to a folder of their own; the last step is an empty pointer file with that folder in
    its name. Nothing is renamed, so this holds on stores where a rename is a copy: readers see the old rows or
    the new ones, whenever a driver or executor is lost. ``df`` may read the rows it replaces. The rows before are
    kept until the next refresh, for readers that began with them. An empty result empties the year. One writer
    at a time for a year of a table.
    """
    spark = df.sparkSession
    before = in_force(_step(df, path, report_year, "set"))
    now = in_force(pointers(spark, path, report_year))
    _clear(spark, path, report_year, [*before, *now])


def append_year(df: DataFrame, path: str, report_year: int) -> None:
    """Add rows to one report year, all or, if the job fails, none; readers see them from the pointer on."""
    _step(df, path, report_year, "add")


def read_year(spark: SparkSession, path: str, report_year: int) -> DataFrame | None:
    """The rows of one report year, without that column; None if it was never written."""
    steps = in_force(pointers(spark, path, report_year))
    return spark.read.parquet(*[p.folder(path) for p in steps]) if steps else None


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all years with ``report_year``; a filter on it reads those years alone. None if there are none."""
    steps = pointers(spark, path)
    folders = [p.folder(path) for y in sorted({p.year for p in steps}) for p in in_force([q for q in steps if q.year == y])]
    if not folders:
        return None
    return spark.read.option("basePath", f"{path}/versions").parquet(*folders).drop("version")


def create_if_absent(df: DataFrame, path: str) -> None:
    """Write the table once; an existing one stays as it is."""
    df.write.mode("ignore").parquet(path)


def create_empty(df: DataFrame, path: str) -> None:
    """A table with the columns of ``df`` and no rows."""
    df.limit(0).write.mode("ignore").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add all rows or, if the job fails, none."""
    df.write.mode("append").parquet(path)


#: Characters that a folder name of a partition has as their code, as Spark's writer has them.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")

#: The folder of rows without a file, where Spark's writer puts them.
_NO_FILE = "__HIVE_DEFAULT_PARTITION__"


def _folder_name(url: str | None) -> str:
    """The folder of a file's copy, which Spark's readers take for a partition of ``bestands_url``."""
    name = _NO_FILE if url is None else _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", url)
    return f"bestands_url={name}"


#: Below the copies: the table of their parts. Spark's readers leave out folders with such a name.
_PARTS = "_copies/parts"
_PART = pa.schema([("bestands_url", pa.string()), ("name", pa.string()), ("bytes", pa.int64())])
_PART_DDL = "bestands_url string, name string, bytes long"
#: Parts that one task reads, and their bytes; a single part may have more.
PARTS_PER_TASK = 4000
BYTES_PER_TASK = 64 << 20
#: Bytes of a part, and lines, that a reading task holds.
_CHUNK = 1 << 20
_LINES = 10_000


def _copied(batches: Iterator[pa.RecordBatch], root: str, run: str) -> Iterator[pa.RecordBatch]:
    """Write sorted (bestands_url, value) as one part per file, and tell of it; a part gets its name when it is whole.

    A task that is tried again writes the same parts.
    """
    system, top = catalog._system(root)
    task = TaskContext.get()
    name = f"part-{task.partitionId():05d}-{run}.c000.txt"
    made, out, now, folder = [], None, None, ""

    def end() -> None:
        made.append({"bestands_url": now, "name": name, "bytes": out.tell()})
        out.close()
        system.move(f"{folder}/.{task.taskAttemptId()}", f"{folder}/{name}")

    for batch in batches:
        values, at = batch["value"].to_pylist(), 0
        for url, same in groupby(batch["bestands_url"].to_pylist()):
            n = sum(1 for _ in same)
            if out is None or url != now:
                if out is not None:
                    end()
                now, folder = url, f"{top}/{_folder_name(url)}"
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder}/.{task.taskAttemptId()}")
            out.write(b"\n".join([v or b"" for v in values[at : at + n]]) + b"\n")
            at += n
        yield pa.RecordBatch.from_pylist(made, schema=_PART)
        made.clear()
    if out is not None:
        end()
    yield pa.RecordBatch.from_pylist(made, schema=_PART)


def _lines_of(stream: pa.NativeFile) -> Iterator[list[bytes]]:
    """The lines of a text some at a time, as Spark's readers split them; a byte-order mark is left out."""
    rest, begun = b"", False
    while chunk := stream.read(max(_CHUNK, len(rest))):
        rest += chunk
        if not begun:
            if len(rest) < 3:
                continue
            rest, begun = rest.removeprefix(b"\xef\xbb\xbf"), True
        # A carriage return at the end may go with a line feed to come.
        whole = max(rest.rfind(b"\n"), rest.rfind(b"\r", 0, -1)) + 1
        yield rest[:whole].splitlines()
        rest = rest[whole:]
    yield rest.splitlines()


def _read_parts(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """The lines (bestands_url, value as bytes) of the parts named."""
    system, top = catalog._system(root)
    urls, values, held = [], [], 0

    def some() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(values, pa.binary())], ["bestands_url", "value"])

    for batch in batches:
        for url, name in zip(batch["bestands_url"].to_pylist(), batch["name"].to_pylist()):
            with system.open_input_stream(f"{top}/{_folder_name(url)}/{name}") as stream:
                for lines in _lines_of(stream):
                    urls += [url] * len(lines)
                    values += lines
                    held += sum(map(len, lines))
                    if len(values) >= _LINES or held >= _CHUNK:
                        yield some()
                        urls, values, held = [], [], 0
    yield some()


def write_normalized(
    lines: DataFrame,
    path: str,
    delimiter: str = "\t",
    repair: bool = False,
    encoding: str = "ISO-8859-1",
    parts: int | None = None,
) -> None:
    """Cleaned semicolon text, one folder per survey file.

    ``lines`` has ``bestands_url``, ``line_no`` and ``value``. Rows are ranged
    by file and line, so a large file becomes several parts whose names sort
    in line order; ``normalized_lines`` reads them as one file again. The text
    is written in ``encoding``, as survey files are; of ISO-8859-1, characters
    that it lacks become question marks.

    There are as many copies as survey files, so the tasks write them through Arrow's file systems: Spark's
    writer starts a process for each local file and moves each folder on the driver. All are written beside
    ``path`` and put in its place at once, when every task is done, with a table of the parts for ``read_normalized``.
    """
    spark = lines.sparkSession
    order = ["bestands_url", "line_no"]
    clean = normalized_line(lines, delimiter, repair)
    value = F.col("value").cast("binary")
    if encoding == "ISO-8859-1":
        value = F.encode(F.regexp_replace("value", r"[^\x{0}-\x{ff}]", "?"), encoding)
    # What shares a folder is one file.
    url = F.when(~F.col("bestands_url").isin("", _NO_FILE), F.col("bestands_url"))
    clean = clean.withColumns({"value": value, "bestands_url": url})
    dealt = clean.repartitionByRange(parts, *order) if parts else clean.repartitionByRange(*order)
    sorted_ = dealt.sortWithinPartitions(*order).select("bestands_url", "value")
    run = uuid.uuid4().hex
    system, place = file_system(spark, path)
    whole = system.makeQualified(place)
    staged = file_system(spark, f"{whole.getParent().toString()}/_{whole.getName()}-{run}")[1]
    try:
        system.mkdirs(staged)
        made = sorted_.mapInArrow(partial(_copied, root=staged.toString(), run=run), _PART_DDL)
        made.write.parquet(f"{staged.toString()}/{_PARTS}")
        system.create(file_system(spark, f"{staged.toString()}/_SUCCESS")[1], True).close()
        system.delete(whole, True)
        if not system.rename(staged, whole):
            raise OSError(f"{path} could not be put in place")
    finally:
        system.delete(staged, True)


def read_normalized(spark: SparkSession, path: str) -> DataFrame:
    """The lines (bestands_url, value) of the copies that ``write_normalized`` made, as Spark's text reader gives them.

    That reader lists all folders on the driver and names each part to a task from there. Here the tasks learn the
    parts from the table stored with them, and read them through Arrow's file systems.
    """
    system, place = file_system(spark, path)
    root = system.makeQualified(place).toString()
    parts = spark.read.schema(_PART_DDL).parquet(f"{root}/{_PARTS}")
    n, size = parts.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(-(-n // PARTS_PER_TASK), -(-size // BYTES_PER_TASK), min(n, spark.sparkContext.defaultParallelism), 1)
    dealt = parts.repartition(tasks, "bestands_url", "name")
    lines = dealt.mapInArrow(partial(_read_parts, root=root), "bestands_url string, value binary")
    return lines.withColumn("value", F.col("value").cast("string"))


def write_combined_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


_EXACT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def export_reports(reports: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """One folder of semicolon files per report; returns where each one went."""
    places = {}
    for name, report in reports.items():
        flat = report.select(
            *[
                F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "struct" else F.col(f.name)
                for f in report.schema
            ]
        )
        places[name] = f"{path}/{name}"
        # The writer's own format ends at milliseconds.
        exact = {"timestampFormat": f"{_EXACT}XXX", "timestampNTZFormat": _EXACT}
        flat.write.mode("overwrite").options(sep=";", header=True, **exact).csv(places[name])
    return places

"""A survey year from files to reports, each stage a stored table.

Tables of all years share one folder each; a rerun changes its own year only.
``sinks.read_table`` reads a whole table and prunes by ``report_year``.
"""

from __future__ import annotations

import datetime
import itertools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lanelux.operators import ledger, sinks
from lanelux.operators.joins import skew_safe_join
from lanelux.operators.points import measurement_lines, measurement_points
from lanelux.operators.segments import enrich
from lanelux.operators.survey import accepted, import_rows, rejected
from lanelux.plans.located import update_located
from lanelux.plans.reports import LOCATED, all_reports
from lanelux.functions.times import stamp
from lanelux.schemas import FILE_LOG, MEASUREMENT_RAW
from lanelux.session import scratch_scope, settle
from lanelux.sources.catalog import list_files
from lanelux.sources.segment_files import read_segments
from lanelux.sources.survey_files import scan_files

IMPORT = StructType(
    [*MEASUREMENT_RAW, StructField("line_no", LongType()), StructField("errors", ArrayType(StringType()))]
)


@dataclass(frozen=True)
class Store:
    """Where the tables of the survey are kept."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, table: str, df: DataFrame, year: int) -> DataFrame:
        sinks.refresh(df, self.path(table), year)
        return self.read(table, year)

    def append(self, table: str, df: DataFrame, year: int) -> DataFrame:
        sinks.append_year(df, self.path(table), year)
        return self.read(table, year)

    def read(self, table: str, year: int) -> DataFrame:
        rows = sinks.read_year(self.spark, self.path(table), year)
        if rows is None:
            raise ValueError(f"{self.path(table)} has no year {year}")
        return rows

    def read_or_empty(self, table: str, year: int, schema: StructType) -> DataFrame:
        rows = sinks.read_year(self.spark, self.path(table), year)
        return self.spark.createDataFrame([], schema) if rows is None else rows


def register_files(store: Store, survey_root: str, year: int, read_at: datetime.datetime, log: DataFrame) -> DataFrame:
    """Log rows for survey files one folder below ``survey_root`` that are new."""
    listing = list_files(store.spark, survey_root, ["xls"], depth=1).select(
        F.col("name").alias("drive_file_name"),
        F.col("path").alias("drive_file_id"),
        F.col("parent_name").alias("drive_folder_name"),
        F.col("parent_id").alias("drive_folder_id"),
        F.lit(year).alias("report_year"),
    )
    return ledger.new_files(listing, log, read_at)


def append_new_lines(store: Store, points: DataFrame, year: int) -> DataFrame:
    """Add the lines of points loaded after the newest stored line, or with it but not stored; all of them the first time."""
    none = measurement_lines(points.limit(0))
    known = store.read_or_empty("measurement_line", year, none.schema)
    newer = ledger.newer_rows(points, known, key=["bestands_url", "line_no"])
    return store.append("measurement_line", measurement_lines(newer), year)


#: Files that are parsed together; the names of so many are on the driver at once.
FILES_AT_ONCE = 10_000


def load_queue(store: Store, log: DataFrame, year: int, read_at: datetime.datetime) -> DataFrame:
    """Parse the files in the log's queue, each once; returns the log with the outcome of their checks.

    Stored are ``file_outcome`` (one row per file, with what keeps it from being read) and
    ``measurement_import`` (all lines of conform files, sound or not). A file that a run broken off
    had stored is not stored again.
    """
    spark = store.spark
    queue = ledger.work_queue(log, year).select("drive_file_id", "drive_file_name", "drive_folder_name", "oid")
    names = (r["drive_file_id"] for r in queue.select("drive_file_id").toLocalIterator())
    parsed = False
    while paths := list(itertools.islice(names, FILES_AT_ONCE)):
        headers, rows = scan_files(spark, paths)
        told = headers.select("bestands_url", F.col("meting_serie_naam").alias("measure_series_name"), "outcome")
        checks = ledger.check_names(queue.join(told, F.col("drive_file_id") == F.col("bestands_url")))
        checks = settle(checks.drop("oid").withColumn("datetime_utc_read", stamp(read_at)), "checks")
        conform = checks.where("name_conform").select("bestands_url")
        known = store.read_or_empty("measurement_import", year, IMPORT).select("bestands_url").distinct()
        conform = settle(conform.join(known, "bestands_url", "left_anti"), "conform-files")
        rows = skew_safe_join(rows, conform, ["bestands_url"], how="left_semi", spread_by=["line_no"])
        store.append("measurement_import", import_rows(rows, read_at), year)
        before = store.read_or_empty("file_outcome", year, checks.schema).select("bestands_url")
        store.append("file_outcome", checks.join(before, "bestands_url", "left_anti"), year)
        parsed = True
    if not parsed:
        return log
    # The stored outcomes are one table, however many times files were parsed.
    told = store.read("file_outcome", year)
    return ledger.apply_checks(log, told.join(queue.select("drive_file_id").distinct(), "drive_file_id", "left_semi"))


def run_year(
    spark: SparkSession,
    survey_root: str,
    segments_path: str,
    classes: DataFrame,
    classes_p: DataFrame,
    out: str,
    report_year: int,
    read_at: datetime.datetime,
    quoted_breaks: bool = True,
) -> dict[str, DataFrame]:
    """Run all stages for one year and return the stored tables by name.

    The file log, the imported lines, the file outcomes and the measurement lines
    grow: files that the log holds keep their state and are not read again, and
    lines of points loaded since the last run are added. Located points and their counts are brought up to date
    file by file (:func:`update_located`). All other tables of the
    year are built anew from these, and the reports are exported to ``export``.
    ``quoted_breaks`` as in :func:`read_segments`.
    """
    with scratch_scope(spark):
        return _run_year(
            Store(spark, out), survey_root, segments_path, classes, classes_p, report_year, read_at, quoted_breaks
        )


def _run_year(store, survey_root, segments_path, classes, classes_p, report_year, read_at, quoted_breaks):
    spark = store.spark
    known = store.read_or_empty("file_log", report_year, FILE_LOG)
    new = register_files(store, survey_root, report_year, read_at, known).withColumns(
        {
            # Shows files apart; the file id is the key.
            "oid": F.xxhash64("drive_file_id"),
            "measure_series_name": F.lit(None).cast("string"),
            "name_conform": F.lit(None).cast("boolean"),
        }
    )
    log = settle(known.unionByName(new.select(*FILE_LOG.names)), "file-log")
    log = store.write("file_log", load_queue(store, log, report_year, read_at), report_year)
    ingest = store.write("ingest_log", ledger.ingest_log(log, report_year), report_year)

    imported = store.read_or_empty("measurement_import", report_year, IMPORT)
    raw = accepted(imported)
    points = store.write("measurement_point", measurement_points(raw, report_year), report_year)
    lines = append_new_lines(store, points, report_year)
    segments = store.write("segment", enrich(read_segments(spark, segments_path, quoted_breaks)), report_year)
    wegcat, counts = update_located(store, points, segments, report_year)
    counts = store.write("reading_counts", counts, report_year)
    tables = {}
    for name, report in all_reports(wegcat, classes, classes_p, counts).items():
        tables[name] = wegcat if name == LOCATED else store.write(name, report, report_year)
    sinks.export_reports(tables, f"{store.path('export')}/{report_year}")
    return tables | {
        "file_log": log,
        "file_outcome": store.read_or_empty("file_outcome", report_year, StructType([])),
        "ingest_log": ingest,
        "measurement_raw": raw,
        "measurement_rejected": rejected(imported),
        "measurement_point": points,
        "measurement_line": lines,
    }

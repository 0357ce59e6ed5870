"""The two other ways through a survey year as whole runs: the combined table of 2024 and the load of 2022.

Both are built from the operators of the yearly run. What they store lies below one folder; the tables of the
load are versioned by year as in ``lanelux.plans.pipeline``.
"""

from __future__ import annotations

import datetime
import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lanelux.functions import text
from lanelux.functions.times import stamp
from lanelux.operators import ledger, sinks
from lanelux.operators.joins import skew_safe_join
from lanelux.operators.survey import FILE_OK, accepted, combined_2024, import_rows, rejected, taken_2024
from lanelux.plans import pipeline
from lanelux.plans.pipeline import IMPORT, Store
from lanelux.schemas import INGEST_LOG
from lanelux.session import file_system, scratch_scope, settle
from lanelux.sources.catalog import list_files
from lanelux.sources.survey_files import file_lines, scan_files, scan_survey


def run_2024(
    spark: SparkSession, survey_root: str, out: str, pattern: str = "*.xls", copies: bool = True, **options
) -> dict[str, DataFrame]:
    """All files of a folder that are taken, as one wide table of texts.

    Written are ``combined`` (semicolon text with header, rows whose RL is not ``0``), ``file_outcome`` (one row per
    file: ``ok``, what keeps it from being read, or ``map`` or ``reeks`` for a name that is not that of its folder or
    series) and, with ``copies``, ``normalized`` (a cleaned copy of each file taken, speed column renamed). Nothing is
    written of a file that is not taken. A run replaces what one before has written. Options as :func:`scan_survey`.
    """
    with scratch_scope(spark):
        headers, rows = scan_survey(spark, survey_root, pattern, **options)
        headers = settle(headers, "headers")
        name, folder = F.element_at(F.split("bestands_url", "/"), -1), F.element_at(F.split("bestands_url", "/"), -2)
        refused = text.rejection_2024(name, folder, F.col("meting_serie_naam"))
        outcome = F.when(F.col("outcome") != FILE_OK, F.col("outcome")).otherwise(F.coalesce(refused, F.lit(FILE_OK)))
        told = headers.select("bestands_url", "meting_serie_naam", outcome.alias("outcome"))
        told.write.mode("overwrite").parquet(f"{out}/file_outcome")
        sound = headers.where(F.col("outcome") == FILE_OK)
        wide = combined_2024(rows, sound)
        sinks.write_combined_csv(wide, f"{out}/combined")
        if copies:
            files = taken_2024(sound).select("bestands_url")
            lines = file_lines(spark, survey_root, pattern, encoding=options.get("encoding", "ISO-8859-1"))
            lines = skew_safe_join(lines, files, ["bestands_url"], how="left_semi", spread_by=["line_no"])
            sinks.write_normalized(lines, f"{out}/normalized", options.get("delimiter", "\t"), repair=True)
        texts = StructType([StructField(n, StringType()) for n in wide.columns])
    return {
        # The columns are known, so a table without a row is read as well.
        "combined": spark.read.schema(texts).option("sep", ";").option("header", True).csv(f"{out}/combined"),
        "file_outcome": spark.read.parquet(f"{out}/file_outcome"),
    }


_LOG = StructType([f for f in INGEST_LOG if f.name != "oid"])
_OUTCOME = StructType([StructField(n, StringType()) for n in ("bestands_url", "meting_serie_naam", "outcome")])


def _purge(store: Store, year: int) -> None:
    """Take the measurements of files with a wrong name out, then these files' log rows, so they are read again."""
    log = store.read_or_empty("legacy_log", year, _LOG)
    if ledger.nonconform_files(log).isEmpty():
        return
    imported = store.read_or_empty("legacy_import", year, IMPORT)
    store.write("legacy_import", ledger.purge_nonconform_measurements(imported, log), year)
    store.write("legacy_log", ledger.purge_nonconform_log(log), year)


def _load(store: Store, paths: list[str], root: str, trigger: str, year: int, read_at: datetime.datetime, layout: str) -> None:
    """Store the lines of some files, then their log rows: a run broken off between reads them again, and stores none twice."""
    spark = store.spark
    headers, rows = scan_files(spark, paths, layout=layout)
    headers = settle(headers, "headers")
    sound = headers.where(F.col("outcome") == FILE_OK).select("bestands_url", "meting_serie_naam")
    known = store.read_or_empty("legacy_import", year, IMPORT).select("bestands_url").distinct()
    fresh = settle(sound.select("bestands_url").join(known, "bestands_url", "left_anti"), "fresh-files")
    rows = skew_safe_join(rows, fresh, ["bestands_url"], how="left_semi", spread_by=["line_no"])
    store.append("legacy_import", import_rows(rows, read_at, layout), year)
    told = headers.select("bestands_url", "meting_serie_naam", "outcome").withColumn("inleesdatum", stamp(read_at))
    store.append("legacy_outcome", told, year)
    store.append("legacy_log", ledger.legacy_log(sound, root, trigger, read_at, "/"), year)


def run_2022(
    spark: SparkSession,
    survey_root: str,
    out: str,
    trigger: str,
    report_year: int,
    read_at: datetime.datetime,
    layout: str = "positional",
) -> dict[str, DataFrame]:
    """Load the files below ``survey_root`` whose path no logged path holds, and check their names afterwards.

    In this way all sound files are loaded and a wrong name is only noted; the next run takes the measurements
    and log rows of such files out and reads the files again. Paths are root, folder, file; ``trigger`` is the part of the
    root after which the shown path begins. A file that can't be read has its outcome and no log row, so it
    is tried again. Returned are the stored tables ``legacy_log`` and ``legacy_backlog`` (listed files without
    logged ones, before the load), and of the import the sound lines (``measurement_raw``), the others
    (``measurement_rejected``) and those of files with right names (``measurement_conform``); the outcomes of this run's files,
    the paths loaded in order (``ingested``) and the number of files with wrong names (``nonconform``).
    """
    system, path = file_system(spark, survey_root)
    root = system.makeQualified(path).toString().rstrip("/")
    if trigger not in root:
        raise ValueError(f"{trigger} is no part of {root}")
    store, year = Store(spark, out), report_year
    with scratch_scope(spark):
        _purge(store, year)
        log = store.read_or_empty("legacy_log", year, _LOG)
        listing = settle(list_files(spark, survey_root, ["xls"]).select("path"), "listing")
        store.write("legacy_backlog", ledger.backlog_count(listing, log), year)
        new = settle(ledger.new_paths(listing, log), "new-files")
        names = (r["path"] for r in new.toLocalIterator())
        while paths := list(itertools.islice(names, pipeline.FILES_AT_ONCE)):
            _load(store, paths, root, trigger, year, read_at, layout)
    log = store.read_or_empty("legacy_log", year, _LOG).withColumn("oid", F.xxhash64("bestands_url"))
    imported = store.read_or_empty("legacy_import", year, IMPORT)
    outcomes = StructType([*_OUTCOME, INGEST_LOG["inleesdatum"]])
    told = store.read_or_empty("legacy_outcome", year, outcomes).where(F.col("inleesdatum") == stamp(read_at))
    raw = accepted(imported)
    conform = ledger.conform_files(log).distinct()
    return {
        "legacy_log": log,
        "legacy_backlog": store.read("legacy_backlog", year),
        "file_outcome": told,
        "measurement_raw": raw,
        "measurement_rejected": rejected(imported),
        "measurement_conform": skew_safe_join(raw, conform, ["bestands_url"], how="left_semi", spread_by=["line_no"]),
        "ingested": ledger.ingested_files(log),
        "nonconform": ledger.nonconform_count(log),
    }

"""The file log: which survey files are known, checked and loaded."""

from __future__ import annotations

import datetime
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanelux.functions import text
from lanelux.functions.times import in_year, stamp
from lanelux.operators.joins import BROADCAST_ROWS, ROWS_PER_TASK, skew_safe_join
from lanelux.schemas import CONFORM, NOT_CONFORM, REGISTERED, VALIDATED
from lanelux.session import settle

_NAME = ["drive_file_name", "report_year"]


def new_files(listing: DataFrame, log: DataFrame, read_at: datetime.datetime) -> DataFrame:
    """Log rows for the listed files that the log does not hold for their year.

    Of several listed files with one name the first path is taken. A logged
    row without file id counts as absent and lets every listed file of that
    name through, once per such row. Both sides are reduced to one row per
    name and year before they meet, so many copies of a name stay cheap.
    """
    path = F.concat_ws("/", "drive_folder_name", "drive_file_name")
    logged = log.groupBy(*_NAME).agg(F.count_if(F.col("drive_file_id").isNull()).alias("_blank"))
    rest = F.struct(path.alias("path"), "drive_file_id", "drive_folder_name", "drive_folder_id")
    first = listing.groupBy(*_NAME).agg(F.min(rest).alias("_first"))
    absent = first.join(logged, _NAME, "left_anti").select(*_NAME, "_first.*")

    again = skew_safe_join(
        listing.withColumn("path", path),
        logged.where(F.col("_blank") > 0),
        _NAME,
        spread_by=["drive_file_id"],
    ).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_blank").cast("int"))))

    columns = ["drive_file_name", "drive_file_id", "drive_folder_name", "drive_folder_id", "report_year"]
    return (
        absent.select(*columns)
        .unionByName(again.select(*columns))
        .withColumns(
            {
                "datetime_utc_read": stamp(read_at),
                "completed_step": F.lit(REGISTERED),
            }
        )
    )


def _windows(text_: Column, size: Column) -> Column:
    """Hashes of all different pieces of ``size`` characters in a text that is no shorter."""
    places = F.sequence(F.lit(1), F.length(text_) - size + 1)
    return F.array_distinct(F.transform(places, lambda i: F.xxhash64(size, F.substring(text_, i, size))))


def path_candidates(listed: DataFrame, texts: DataFrame, path: str = "path") -> DataFrame:
    """Pairs of a listed path and a text (_id, _text) that may hold it: all that do are among them.

    A path's windows are its pieces of as many characters as the largest power of two that fits its length.
    Each path is looked up by the one of its windows that the fewest texts hold, so paths that share
    a long beginning or end meet the few texts that hold what tells them apart; a path with a window that no
    text holds meets none. ``listed`` holds no empty path.
    """
    size = F.expr(f"shiftleft(1, length(bin(length(`{path}`))) - 1)")
    sized = listed.select(path, size.alias("_size"))
    own = sized.select(path, "_size", F.explode(_windows(F.col(path), F.col("_size"))).alias("_key"))
    own = settle(own, "listed-windows")
    sizes = own.select("_size").distinct().agg(F.collect_set("_size")).scalar()
    fitting = F.filter(F.col("_sizes"), lambda n: n <= F.length("_text"))
    keys = F.flatten(F.transform(fitting, lambda n: _windows(F.col("_text"), n)))
    at = texts.withColumn("_sizes", sizes).select("_id", F.explode(F.array_distinct(keys)).alias("_key"))
    held = skew_safe_join(at, own.select("_key").distinct(), ["_key"], how="left_semi", spread_by=["_id"])
    held = settle(held, "path-windows")
    often = held.groupBy("_key").agg(F.count("*").alias("_often"))
    counted = skew_safe_join(own, often, ["_key"], how="left", spread_by=[path])
    rarest = counted.groupBy(path).agg(F.min(F.struct(F.coalesce("_often", F.lit(0)).alias("n"), "_key")).alias("_rarest"))
    chosen = rarest.where("_rarest.n > 0").select(path, F.col("_rarest._key").alias("_key"))
    return held.join(chosen, "_key").select(path, "_id")


def new_paths(listing: DataFrame, log: DataFrame, path: str = "path", logged: str = "bestands_url") -> DataFrame:
    """Listed paths that occur nowhere inside a logged path.

    Only texts that :func:`path_candidates` finds are searched, so work grows with the lengths of the paths,
    not with pairs. An empty path occurs in every logged path.
    """
    listed = listing.select(path).where(F.col(path).isNotNull()).distinct()
    texts = log.select(F.col(logged).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    texts = settle(texts.select(F.xxhash64("_text").alias("_id"), "_text"), "logged-paths")
    pairs = path_candidates(listed.where(F.col(path) != ""), texts, path)
    seen = pairs.join(texts, "_id").where(F.col("_text").contains(F.col(path))).select(path).distinct()
    some = texts.limit(1).agg(F.count("*")).scalar() > 0
    seen = seen.unionByName(listed.where((F.col(path) == "") & some))
    return skew_safe_join(listing, settle(seen, "seen-paths"), [path], how="left_anti")


def work_queue(log: DataFrame, report_year: int) -> DataFrame:
    """Registered files of a year that still have to be checked."""
    return log.where(
        (F.col("report_year") == report_year)
        & F.col("name_conform").isNull()
        & (F.col("completed_step") == REGISTERED)
    )


def check_names(files: DataFrame) -> DataFrame:
    """Whether file and folder name agree with the series name of the file."""
    return files.withColumn(
        "name_conform",
        F.coalesce(
            text.name_conform(F.col("drive_file_name"), F.col("drive_folder_name"), F.col("measure_series_name")),
            F.lit(False),
        ),
    )


def apply_checks(log: DataFrame, checks: DataFrame, key: str = "drive_file_id") -> DataFrame:
    """The log with the outcome of ``checks`` (series name, name_conform) under the same ``key``."""
    done = checks.select(
        F.col(key).alias("_key"),
        F.col("measure_series_name").alias("_series"),
        F.col("name_conform").alias("_conform"),
    )
    checked = F.col("_key").isNotNull()
    return (
        log.join(done, F.col(key) == F.col("_key"), "left")
        .withColumns(
            {
                "measure_series_name": F.when(checked, F.col("_series")).otherwise(F.col("measure_series_name")),
                "name_conform": F.when(checked, F.col("_conform")).otherwise(F.col("name_conform")),
                "completed_step": F.when(checked, F.lit(VALIDATED)).otherwise(F.col("completed_step")),
            }
        )
        .drop("_key", "_series", "_conform")
    )


def ingest_log(log: DataFrame, report_year: int) -> DataFrame:
    """The checked files of a year with paths and status text."""
    rows = log.where((F.col("completed_step") == VALIDATED) & (F.col("report_year") == report_year))
    slash = F.lit("\\")
    return rows.select(
        "oid",
        F.concat(F.lit("temp/"), "drive_file_name").alias("bestands_url"),
        F.concat(slash, "drive_folder_name", slash, "drive_file_name").alias("map_bestand"),
        F.concat("drive_folder_name", slash, "measure_series_name").alias("bestandsnaam"),
        "measure_series_name",
        F.when(F.coalesce("name_conform", F.lit(False)), CONFORM).otherwise(NOT_CONFORM).alias("ctr_header_bestandsnaam"),
        F.col("datetime_utc_read").alias("inleesdatum"),
    )


def legacy_log(files: DataFrame, root: str, trigger: str, read_at: datetime.datetime, sep: str = "\\") -> DataFrame:
    """Log rows of loaded files (bestands_url, meting_serie_naam) with the status of both name checks.

    Paths look like root, folder, file. ``trigger`` is the part of ``root``
    after which the shown path begins.
    """
    below = F.col("bestands_url").substr(F.lit(len(root) + len(sep) + 1), F.length("bestands_url"))
    stem = text.file_stem(below)
    folder, name = F.substring_index(stem, sep, 1), F.get(F.split(stem, re.escape(sep)), F.lit(1))
    series = F.col("meting_serie_naam")
    return files.select(
        "bestands_url",
        F.concat(F.lit(root.split(trigger)[1] + sep), below).alias("map_bestand"),
        stem.alias("bestandsnaam"),
        text.drop_line_breaks(series).alias("measure_series_name"),
        text.conformity_status(name, folder, series).alias("ctr_header_bestandsnaam"),
        stamp(read_at).alias("inleesdatum"),
    )


def conform_files(ingest: DataFrame) -> DataFrame:
    return ingest.where(~F.col("ctr_header_bestandsnaam").contains("NIET")).select("bestands_url")


def nonconform_files(ingest: DataFrame) -> DataFrame:
    return ingest.where(F.col("ctr_header_bestandsnaam").contains("NIET")).select("bestands_url")


def nonconform_count(ingest: DataFrame) -> DataFrame:
    return ingest.agg(F.count(F.when(F.col("ctr_header_bestandsnaam").contains("NIET"), F.col("oid"))).alias("n"))


def ingested_files(ingest: DataFrame) -> DataFrame:
    return ingest.select("bestands_url").orderBy("bestands_url")


def purge_nonconform_log(ingest: DataFrame) -> DataFrame:
    """What a delete of the non-conform rows leaves; rows without status stay."""
    status = F.col("ctr_header_bestandsnaam")
    return ingest.where(status.isNull() | ~status.contains("NIET"))


def purge_nonconform_measurements(
    raw: DataFrame,
    ingest: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Measurements without those of non-conform files."""
    return skew_safe_join(
        raw,
        nonconform_files(ingest).distinct(),
        ["bestands_url"],
        how="left_anti",
        spread_by=["oid"],
        broadcast_rows=broadcast_rows,
        rows_per_task=rows_per_task,
    )


def measurements_with_status(
    raw: DataFrame,
    ingest: DataFrame,
    status: str = CONFORM,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Measurements once per log row of their file that has ``status``."""
    files = (
        ingest.where(F.col("ctr_header_bestandsnaam") == status)
        .groupBy("bestands_url")
        .agg(F.count("*").cast("int").alias("_times"))
    )
    matched = skew_safe_join(
        raw,
        files,
        ["bestands_url"],
        spread_by=["oid"],
        broadcast_rows=broadcast_rows,
        rows_per_task=rows_per_task,
    )
    return matched.withColumn("_times", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def backlog_count(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Listed files minus logged files, in one pass over both."""
    signed = listing.select(F.lit(1).alias("n")).unionByName(log.select(F.lit(-1).alias("n")))
    return signed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def newer_rows(source: DataFrame, target: DataFrame, ts: str = "inleesdatum", key: list[str] | None = None) -> DataFrame:
    """Source rows after the newest time stamp of the target; all if it has none.

    The watermark is a scalar subquery, so it also reaches the scan filter. With ``key``, rows at the
    watermark itself are taken as well if the target has no row of that key there, so rows that get the same
    stamp later are not lost; only rows at the watermark meet.
    """
    mark = target.agg(F.max(ts)).scalar()
    later = source.where((F.col(ts) > mark) | mark.isNull())
    if key is None:
        return later
    known = target.where(F.col(ts) == mark).select(*[F.col(k).alias(f"_known_{k}") for k in key])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in key])
    return later.unionByName(source.where(F.col(ts) == mark).join(known, same, "left_anti"))


def survey_year_files(log: DataFrame, year: int) -> DataFrame:
    return log.where(in_year(F.col("datetime_utc_read"), year))

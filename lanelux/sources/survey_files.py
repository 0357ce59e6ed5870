"""Readers of survey files in a folder tree."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.operators.survey import file_headers, line_headers, number_lines, parse_files, parse_lines
from lanelux.session import settle

ENCODING = "ISO-8859-1"
# Files up to this size are parsed as one row; larger ones line by line.
WHOLE_FILE_BYTES = 16 * 1024 * 1024


def whole_files(found: DataFrame, encoding: str = ENCODING) -> DataFrame:
    return found.select(F.col("path").alias("bestands_url"), F.decode("content", encoding).alias("content"))


def file_lines(
    spark: SparkSession,
    root: str | list[str],
    pattern: str = "*.xls",
    larger_than: int = -1,
    encoding: str = ENCODING,
    per_folder: bool = False,
) -> DataFrame:
    """Numbered lines of all files above a size; one file may span many splits.

    With ``per_folder`` the files of a folder are read as one.

    The lines are stored once: how a file is split depends on the executors at
    hand, so two scans need not agree on the place of a line.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(root)
        .where(F.col("_metadata.file_size") > larger_than)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            F.decode(F.col("value").cast("binary"), encoding).alias("value"),
        )
    )
    return number_lines(settle(lines, "file-lines"), per_folder=per_folder)


def normalized_lines(spark: SparkSession, root: str, encoding: str = ENCODING) -> DataFrame:
    """Numbered lines of the copies that ``write_normalized`` made, under the paths of the originals."""
    lines = file_lines(spark, root, "part-*", encoding=encoding, per_folder=True)
    name = F.regexp_extract("bestands_url", r"bestands_url=([^/]*)$", 1)
    return lines.withColumn("bestands_url", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))


def parse_found(
    found: DataFrame,
    root: str | list[str] | None = None,
    layout: str = "keyed",
    delimiter: str = "\t",
    pattern: str = "*.xls",
    encoding: str = ENCODING,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Headers and body rows of listed files (binaryFile columns), by size in one of two ways.

    Headers have one row per file, whatever is in it; ``outcome`` says what
    keeps a file from being read. Both ways give the same rows. With the layout ``mixed`` each file has its
    own, named in ``layout``. Without ``root`` the names of the large
    files are gathered from ``found``, which must then be a bounded batch.
    """
    files = whole_files(found.where(F.col("length") <= whole_file_bytes), encoding)
    headers, rows = file_headers(files, layout, delimiter), parse_files(files, layout, delimiter)
    large = found.where(F.col("length") > whole_file_bytes).select("path")
    if root is None:
        root = [r["path"] for r in large.collect()]
    elif not large.limit(1).count():
        root = []
    if root:
        lines = file_lines(found.sparkSession, root, pattern, whole_file_bytes, encoding)
        tops = line_headers(lines, layout, delimiter)
        headers = headers.unionByName(tops.select(*headers.columns))
        rows = rows.unionByName(parse_lines(lines, layout, delimiter, tops))
    return headers, rows


def _empty_files(found: DataFrame, layout: str = "keyed") -> DataFrame | None:
    """Headers of listed files without a byte, which Spark's readers leave out; None if there are none.

    The listing is on the driver already, as part of the reader.
    """
    listed = found.inputFiles()
    if len(listed) == found.select("path").count():
        return None
    names = found.sparkSession.createDataFrame([(f,) for f in listed], "path string")
    plain = F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    empty = names.select(plain.alias("path")).join(found.select("path"), "path", "left_anti")
    return file_headers(empty.select(F.col("path").alias("bestands_url"), F.lit("").alias("content")), layout)


def scan_survey(
    spark: SparkSession, root: str, pattern: str = "*.xls", **options
) -> tuple[DataFrame, DataFrame]:
    """Headers and body rows of every survey file below ``root``; options as :func:`parse_found`."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    headers, rows = parse_found(found, root, pattern=pattern, **options)
    empty = _empty_files(found, options.get("layout", "keyed"))
    return headers if empty is None else headers.unionByName(empty), rows


def scan_files(spark: SparkSession, paths: list[str], pattern: str = "*.xls", **options) -> tuple[DataFrame, DataFrame]:
    """Headers and body rows of the files named, and of no others; options as :func:`parse_found`."""
    plain = [re.sub(r"([{}\[\]*?\\,])", r"\\\1", p) for p in paths]
    found = spark.read.format("binaryFile").load(plain)
    headers, rows = parse_found(found, plain, pattern=pattern, **options)
    empty = _empty_files(found, options.get("layout", "keyed"))
    return headers if empty is None else headers.unionByName(empty), rows


def read_survey(spark: SparkSession, root: str, **options) -> DataFrame:
    """Body rows of every survey file below ``root``; options as :func:`scan_survey`."""
    return scan_survey(spark, root, **options)[1]

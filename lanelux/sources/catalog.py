"""Listings of survey files and folders."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.session import file_system, settle


def list_files(
    spark: SparkSession,
    root: str,
    extensions: list[str] | None = None,
    depth: int = -1,
) -> DataFrame:
    """Files below ``root`` with their direct parent folder.

    ``depth`` 0 lists ``root`` only, n goes n folders down, -1 has no limit.
    An extension is the text after the last dot of the name and is compared
    exactly; without a dot it is the whole name. File contents are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if extensions and all(e.isalnum() for e in extensions):
        # Other files are left out of the listing itself.
        reader = reader.option("pathGlobFilter", "{" + ",".join(f"{p}{e}" for e in extensions for p in ("*.", "")) + "}")
    files = reader.load(root)
    parts = F.split("path", "/")
    base = len(_qualified(spark, root).split("/"))
    listed = files.select(
        "path",
        F.element_at(parts, -1).alias("name"),
        F.element_at(parts, -2).alias("parent_name"),
        F.regexp_replace("path", "/[^/]*$", "").alias("parent_id"),
        (F.size(F.split(_bare(F.col("path")), "/")) - base - 1).alias("level"),
        "length",
        "modificationTime",
    )
    if depth >= 0:
        listed = listed.where(F.col("level") <= depth)
    if extensions:
        listed = listed.where(F.element_at(F.split("name", r"\."), -1).isin(extensions))
    return listed


def _bare(path: Column) -> Column:
    """The path without scheme and host."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")


def _qualified(spark: SparkSession, root: str) -> str:
    """``root`` from the top of its file system, however it is written."""
    system, path = file_system(spark, root)
    return system.makeQualified(path).toUri().getPath().rstrip("/")


_ENTRY = pa.schema(
    [
        ("path", pa.string()),
        ("name", pa.string()),
        ("parent_name", pa.string()),
        ("parent_id", pa.string()),
        ("is_folder", pa.bool_()),
        ("length", pa.int64()),
        ("modificationTime", pa.timestamp("us", tz="UTC")),
    ]
)
_ENTRY_DDL = (
    "path string, name string, parent_name string, parent_id string, is_folder boolean, length long, "
    "modificationTime timestamp"
)
#: Folders that one task lists.
FOLDERS_PER_TASK = 64


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder as executors see it, and the folder's path there."""
    scheme, host, path = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)", folder, re.DOTALL).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), path or "/"
    system, base = fs.FileSystem.from_uri(f"{scheme}://{host or ''}")
    return system, f"{base.rstrip('/')}/{path.strip('/')}" if base.strip("/") else path or "/"


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies directly in each folder; a folder that is gone meanwhile holds nothing."""
    for batch in batches:
        for folder in batch["path"].to_pylist():
            system, place = _system(folder)
            infos = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
            # As Spark's readers do.
            infos = [i for i in infos if not i.base_name.startswith((".", "_"))]
            rows = [
                {
                    "path": f"{folder.rstrip('/')}/{i.base_name}",
                    "name": i.base_name,
                    "parent_name": folder.rstrip("/").rsplit("/", 1)[-1],
                    "parent_id": folder,
                    "is_folder": i.type == fs.FileType.Directory,
                    "length": i.size,
                    "modificationTime": i.mtime,
                }
                for i in infos
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY)


def list_tree(spark: SparkSession, root: str, depth: int = -1) -> DataFrame:
    """Files and folders below ``root``, also empty ones and those that hold folders only.

    One level after the other is listed by the executors: the folders of a level are rows, each task lists some
    of them and stores what it finds, so no listing is on the driver. Columns as :func:`list_files` and
    ``is_folder``; ``depth`` as there. Names that begin with a dot or an underscore are left out. The file
    system must be one that Arrow knows (file, hdfs, s3, gs, abfs). A missing root has nothing below it.
    """
    system, path = file_system(spark, root)
    top = system.makeQualified(path).toString()
    frontier = spark.createDataFrame([(top,)], "path string")
    levels, level, folders = [], 0, 1
    while folders and (depth < 0 or level <= depth):
        dealt = frontier.repartition(-(-folders // FOLDERS_PER_TASK), "path")
        listed = settle(dealt.mapInArrow(_children, _ENTRY_DDL), "listing").withColumn("level", F.lit(level))
        levels.append(listed)
        frontier = listed.where("is_folder").select("path")
        folders, level = frontier.count(), level + 1
    return reduce(DataFrame.unionByName, levels)


def tree_files(tree: DataFrame, extensions: list[str] | None = None) -> DataFrame:
    """The files of a :func:`list_tree`, as :func:`list_files` gives them; empty ones too."""
    files = tree.where("not is_folder").drop("is_folder")
    return files.where(F.element_at(F.split("name", r"\."), -1).isin(extensions)) if extensions else files


def tree_folders(tree: DataFrame) -> DataFrame:
    """All folders of a :func:`list_tree`, as :func:`list_folders` gives them."""
    return tree.where("is_folder").select(F.col("path").alias("folder_id"), F.col("name").alias("folder_name"))


def list_folders(files: DataFrame) -> DataFrame:
    """The folders of the files and all folders above them, below the root; the root itself if it holds a file.

    Reads the listing of files alone; folders without any file below them are found by :func:`list_tree`.
    """
    held = files.select("parent_id", "level").distinct()
    parts = F.split("parent_id", "/")
    above = held.select(parts.alias("_parts"), F.explode(F.sequence(F.lit(0), F.greatest(F.col("level") - 1, F.lit(0)))).alias("_up"))
    own = above.select(F.slice("_parts", F.lit(1), F.size("_parts") - F.col("_up")).alias("_parts"))
    return own.select(F.array_join("_parts", "/").alias("folder_id"), F.element_at("_parts", -1).alias("folder_name")).distinct()


def find_folders(folders: DataFrame, name: str, parent_id: str | None = None) -> DataFrame:
    """Ids of the folders called ``name``, possibly none."""
    found = folders.where(F.col("folder_name") == name)
    if parent_id is not None:
        found = found.where(F.regexp_replace("folder_id", "/[^/]*$", "") == parent_id)
    return found.select("folder_id")


def search_files(files: DataFrame, endings: list[str], substrings: list[str]) -> DataFrame:
    """Each path once for every pair of ending and substring it has."""
    pairs = F.array(*[F.struct(F.lit(e).alias("ending"), F.lit(s).alias("part")) for e in endings for s in substrings])
    path = F.col("path")
    hits = F.filter(pairs, lambda p: path.endswith(p.getField("ending")) & path.contains(p.getField("part")))
    return files.select("path", F.explode(hits).alias("_hit")).select("path", "_hit.ending", "_hit.part")

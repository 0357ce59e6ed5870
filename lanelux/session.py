"""Session defaults and the shared scratch area for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "lanelux") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    width = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="lanelux-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    root = spark.conf.get(SCRATCH_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SCRATCH_CONF} to a folder that all executors share")
    return _local_scratch()


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no earlier run has used."""
    path = f"{scratch_root(spark)}/lanelux/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is settled inside once it is left; results must not read from it."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of ``path`` and the path in its form."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    system, place = file_system(spark, path)
    system.delete(place, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch area and read it back.

    Cuts the lineage, so a table that several later stages use is computed
    once and survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

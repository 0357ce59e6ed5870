"""Located measurements and their counts, kept up to date file by file.

The counts of each file are parts that add up: a file that is loaded adds its part, one that is gone withdraws
it by the same numbers below zero. So a run with one new file locates and counts the points of that file alone, and
all share reports start from the sums. Parts hold for one state of the segments; other segments begin anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from lanelux.operators import sinks
from lanelux.operators.joins import skew_safe_join
from lanelux.operators.segments import on_segments
from lanelux.operators.shares import merged_counts, reading_counts
from lanelux.plans.reports import LOCATED
from lanelux.session import settle

COUNTS = "file_counts"
#: A row is a part of a file's counts, or (``loaded`` 1 or -1) tells that the file came or went. ``step`` is the
#: number of the located table's last change, ``segments`` the state of the segments.
_PARTS = StructType(
    [
        StructField("bestands_url", StringType()),
        StructField("jaar", IntegerType()),
        StructField("markering", StringType()),
        StructField("provincie", StringType()),
        StructField("weg", StringType()),
        StructField("rl", IntegerType()),
        StructField("n", LongType()),
        StructField("loaded", IntegerType()),
        StructField("segments", StringType()),
        StructField("step", LongType()),
    ]
)
#: Names of new files up to this many are pushed down to the scan of the points.
PUSHED_FILES = 1000


def _state(segments: DataFrame) -> str:
    """What tells one state of the segments from another, in whatever order they are read."""
    columns = sorted(segments.columns)
    n, total = segments.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


def _of_files(points: DataFrame, files: DataFrame) -> DataFrame:
    names = [r["bestands_url"] for r in files.limit(PUSHED_FILES + 1).collect()]
    if len(names) <= PUSHED_FILES:
        return points.where(F.col("bestands_url").isin(names))
    return skew_safe_join(points, files, ["bestands_url"], how="left_semi", spread_by=["oid"])


def update_located(store, points: DataFrame, segments: DataFrame, year: int) -> tuple[DataFrame, DataFrame]:
    """The located points of a year and their reading counts, brought up to date with ``points`` (bestands_url, ...).

    Files that ``points`` has and the counts have not are located and added; files that it has no more are
    withdrawn. Points of a file do not change. The located table is changed first; the parts name its last change,
    so a run that is broken off between both, like other segments, makes the next one build both anew.
    """
    spark, segmented = store.spark, _state(segments)
    parts = store.read_or_empty(COUNTS, year, _PARTS).where(F.col("segments") == segmented)
    loaded = settle(points.select("bestands_url").distinct(), "loaded-files")
    counted = parts.groupBy("bestands_url").agg(F.sum("loaded").alias("_n")).where("_n > 0").select("bestands_url")
    counted = settle(counted, "counted-files")

    def last_step() -> int | None:
        steps = sinks.pointers(spark, store.path(LOCATED), year)
        return steps[-1].number if steps else None

    def told(counts: DataFrame, files: DataFrame, sign: int) -> DataFrame:
        marks = files.select("bestands_url", F.lit(0).cast("long").alias("n"), F.lit(sign).alias("loaded"))
        rows = counts.withColumn("loaded", F.lit(0)).unionByName(marks, allowMissingColumns=True)
        return rows.withColumns({"segments": F.lit(segmented), "step": F.lit(last_step()).cast("long")}).select(*_PARTS.names)

    step = parts.agg(F.max("step")).first()[0]
    if step is None or step != last_step():
        located = store.write(LOCATED, on_segments(points, segments, keep=("bestands_url",)), year)
        store.write(COUNTS, told(reading_counts(located, ("bestands_url",)), loaded, 1), year)
    else:
        new = settle(loaded.join(counted, "bestands_url", "left_anti"), "new-files")
        gone = settle(counted.join(loaded, "bestands_url", "left_anti"), "gone-files")
        changes = []
        if not gone.isEmpty():
            withdrawn = settle(parts.where("loaded = 0").join(gone, "bestands_url", "left_semi"), "withdrawn")
            withdrawn = withdrawn.drop("loaded", "segments", "step").withColumn("n", -F.col("n"))
            left = skew_safe_join(store.read(LOCATED, year), gone, ["bestands_url"], how="left_anti", spread_by=["oid"])
            store.write(LOCATED, left, year)
            changes.append((withdrawn, gone, -1))
        if not new.isEmpty():
            fresh = settle(on_segments(_of_files(points, new), segments, keep=("bestands_url",)), "located")
            store.append(LOCATED, fresh, year)
            changes.append((reading_counts(fresh, ("bestands_url",)), new, 1))
        if changes:
            rows = [told(*change) for change in changes]
            store.append(COUNTS, rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]), year)
    now = store.read(COUNTS, year).where((F.col("segments") == segmented) & (F.col("loaded") == 0))
    return store.read(LOCATED, year).drop("bestands_url"), merged_counts(now)

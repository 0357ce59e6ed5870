"""Places of rows in an order, without gathering them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanelux.operators.joins import skew_safe_join
from lanelux.session import settle

#: ``monotonically_increasing_id`` has the number within the partition in its lower bits.
_WITHIN = (1 << 33) - 1


def numbered(rows: DataFrame, order: list[Column | str], name: str = "place") -> DataFrame:
    """``rows`` with their place from 1 in ``order``; equal rows get different places in no fixed order.

    Rows are ranged and sorted, and each knows its place within its range. Only the sizes of the
    ranges are summed, so no task and no window holds more than a range. The result is stored.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    own = {"_range": F.spark_partition_id(), "_within": F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN))}
    stored = settle(ranged.withColumns(own), "ranges")
    sizes = sorted(tuple(r) for r in stored.groupBy("_range").agg(F.count("*")).collect())  # one row per range
    before, starts = 0, []
    for number, size in sizes:
        starts.append((number, before))
        before += size
    bases = spark.createDataFrame(starts, "_range int, _before long")
    placed = skew_safe_join(stored, bases, ["_range"], spread_by=["_within"])
    return placed.withColumn(name, F.col("_before") + F.col("_within") + 1).drop("_range", "_within", "_before")

"""Joins of the large measurement side with smaller tables.

Every join first checks the size of the smaller side. Up to the bound it is
broadcast and the measurements are not shuffled. Beyond it both sides shuffle,
and keys that hold many measurements are spread over several tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from lanelux.session import settle

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 * 1024 * 1024
BROADCAST_BANDS = 1_000
ROWS_PER_TASK = 5_000_000
# Parts that a cell with many rows is cut in, with about as many rows each.
PARTS_OF_CELL = 64


def fits(df: DataFrame, rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and ``max_bytes`` of values.

    Counts in one distributed pass over ``df``; nothing but the two sums moves.
    """
    plain = [f.name for f in df.schema if isinstance(f.dataType, (NumericType, DatetimeType, BooleanType))]
    sized = [F.octet_length(F.col(f"`{c}`").cast("string")) for c in df.columns if c not in plain]
    width = reduce(Column.__add__, [F.coalesce(w, F.lit(0)) for w in sized], F.lit(16 * len(plain)))
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()
    return n <= rows and size <= max_bytes


def _many_rows(fact: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    counts = fact.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return settle(counts.where(F.col("_rows") > rows_per_task), "hot-keys")


def _listed(hot: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    names = [F.col(k).alias(f"_hot_{k}") for k in keys]
    return hot.select(*names, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_shares"))


def hot_keys(fact: DataFrame, keys: list[str], rows_per_task: int, broadcast_rows: int) -> DataFrame | None:
    """Keys with more than ``rows_per_task`` rows and the shares to split them in.

    There are at most ``count(fact) / rows_per_task`` of them. None if they are
    too many to broadcast.
    """
    hot = _many_rows(fact, keys, rows_per_task)
    return _listed(hot, keys, rows_per_task) if fits(hot, broadcast_rows) else None


def key_shares(fact: DataFrame, keys: list[str], rows_per_task: int, broadcast_rows: int) -> tuple[DataFrame, int]:
    """A list of the hottest keys with their shares, which fits a broadcast, and the shares of every other key.

    The others have one share if all hot keys can be listed, else the least power of two that leaves no more
    than ``rows_per_task`` rows in a share of theirs. Rows are counted once.
    """
    hot, others = _many_rows(fact, keys, rows_per_task), 1
    while not fits(hot, max(0, broadcast_rows)):
        others *= 2
        hot = hot.where(F.col("_rows") > others * rows_per_task)
    return _listed(hot, keys, rows_per_task), others


def skew_safe_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "inner",
    condition: Column | None = None,
    spread_by: list[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
    small: bool | None = None,
) -> DataFrame:
    """Join on equal ``keys`` plus ``condition``; ``how`` keeps or filters ``fact`` rows.

    ``spread_by`` names columns that tell rows of one key apart, such as a row
    id. Beyond the broadcast bound, rows of a hot key are dealt out over
    shares by a hash of these columns and the matching ``dim`` rows are
    repeated once per share, so no task receives a whole hot key. The result
    is the same on every path. Columns other than ``keys`` must differ between
    the two sides. ``small`` says whether ``dim`` is within the bound, if that was checked before.
    """
    dim = dim.withColumnsRenamed({k: f"_dim_{k}" for k in keys})
    matches = [F.col(k) == F.col(f"_dim_{k}") for k in keys]
    if condition is not None:
        matches.append(condition)
    drop = [f"_dim_{k}" for k in keys]

    if fits(dim, broadcast_rows) if small is None else small:
        return fact.join(F.broadcast(dim), reduce(Column.__and__, matches), how).drop(*drop)

    spread = F.xxhash64(*(spread_by or fact.columns))
    hot, others = key_shares(fact, keys, rows_per_task, broadcast_rows)
    shares = F.coalesce("_shares", F.lit(others))
    same_fact = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    same_dim = reduce(Column.__and__, [F.col(f"_dim_{k}").eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    names = [f"_hot_{k}" for k in keys]
    dealt = (
        fact.join(F.broadcast(hot), same_fact, "left")
        .withColumn("_share", F.pmod(spread, shares.cast("bigint")).cast("int"))
        .drop("_shares", *names)
    )
    repeated = (
        dim.join(F.broadcast(hot), same_dim, "left")
        .withColumn("_dim_share", F.explode(F.sequence(F.lit(0), shares - 1)))
        .drop("_shares", *names)
    )
    matches.append(F.col("_share") == F.col("_dim_share"))
    return dealt.join(repeated, reduce(Column.__and__, matches), how).drop("_share", "_dim_share", *drop)


def dense_cells(placed: DataFrame, keys: list[str], point: str, rows_per_cell: int) -> DataFrame:
    """Cells (keys, _cell) of ``placed`` with more than ``rows_per_cell`` rows, and the bounds ``_cuts`` of their parts.

    The bounds are quantiles of the points in the cell, from mergeable sketches, so parts hold about
    equally many rows wherever in the cell these lie. Points that are equal share a part.
    """
    cell = [*keys, "_cell"]
    counts = placed.groupBy(*cell).agg(F.count("*").alias("_rows"))
    dense = settle(counts.where(F.col("_rows") > rows_per_cell).select(*cell), "dense-cells")
    held = skew_safe_join(placed.select(*cell, point), dense, cell, how="left_semi", spread_by=[point])
    shares = [k / PARTS_OF_CELL for k in range(1, PARTS_OF_CELL)]
    cuts = F.percentile_approx(F.col(point).cast("double"), shares, 10_000)
    return settle(held.groupBy(*cell).agg(F.array_distinct(cuts).alias("_cuts")), "cell-parts")


def part_of(value: Column) -> Column:
    """The part of a cell with bounds ``_cuts`` that a value lies in; 0 in a cell that is not cut."""
    above = F.filter("_cuts", lambda cut: cut <= value.cast("double"))
    return F.when(F.col("_cuts").isNotNull(), F.size(above)).otherwise(F.lit(0))


def interval_join(
    fact: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    point: str,
    low: str,
    high: str,
    cell: float,
    domain: tuple[float | Column, float | Column],
    spread_by: list[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows whose ``point`` lies in ``[low, high]`` under equal ``keys``, both ends included.

    The line is cut in cells of width ``cell``. A row falls in one cell and an
    interval is repeated for each cell it touches, so the range test runs on
    the rows of one cell only, and a long road is split over many tasks. Cell
    numbers grow with the value, so no match is lost; ``domain`` only bounds
    the number of cells of an open-ended interval, what lies outside it shares
    the first or last cell. The exact values are compared afterwards. Where the intervals are too many
    to broadcast, a cell with more than ``rows_per_task`` rows is cut further, in parts of about
    equally many rows, so a row meets few intervals also where most rows lie on a short piece of a road.
    """

    def cell_of(name: str) -> Column:
        value = F.col(name).cast("double")
        least, most = (b.cast("double") if isinstance(b, Column) else F.lit(float(b)) for b in domain)
        kept = F.least(F.greatest(value, least), most)
        return F.floor(kept / F.lit(float(cell)))

    spans = intervals.where(F.col(low) <= F.col(high)).withColumn(
        "_cell", F.explode(F.sequence(cell_of(low), cell_of(high)))
    )
    placed = fact.where(F.col(point).isNotNull()).withColumn("_cell", cell_of(point))
    small = fits(spans, broadcast_rows)
    cell_keys = [*keys, "_cell"]
    if not small:
        cuts = dense_cells(placed, keys, point, rows_per_task)
        placed, spans = (skew_safe_join(side, cuts, cell_keys, how="left", spread_by=spread) for side, spread in ((placed, spread_by), (spans, None)))
        placed = placed.withColumn("_part", part_of(F.col(point))).drop("_cuts")
        parts = F.sequence(part_of(F.col(low)), part_of(F.col(high)))
        spans = spans.withColumn("_part", F.explode(parts)).drop("_cuts")
        cell_keys.append("_part")
    return skew_safe_join(
        placed,
        spans,
        cell_keys,
        condition=F.col(point).between(F.col(low), F.col(high)),
        spread_by=spread_by,
        broadcast_rows=broadcast_rows,
        rows_per_task=rows_per_task,
        small=small,
    ).drop("_cell", "_part")


def band_join(
    fact: DataFrame,
    bands: DataFrame,
    point: str,
    low: str,
    high: str,
    spread_by: list[str] | None = None,
    broadcast_bands: int = BROADCAST_BANDS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows matched to every band ``[low, high]`` that holds ``point``.

    Overlapping bands repeat a row, a gap drops it. A handful of bands is
    tested row by row; a large table goes through :func:`interval_join` over
    the range of values that occur.
    """
    if fits(bands, broadcast_bands):
        return fact.join(F.broadcast(bands), F.col(point).between(F.col(low), F.col(high)))
    least, most = fact.agg(F.min(point), F.max(point)).first()
    if least is None:
        least = most = 0
    return interval_join(
        fact,
        bands,
        [],
        point,
        low,
        high,
        cell=max(1.0, (float(most) - float(least)) / 1024),
        domain=(float(least), float(most)),
        spread_by=spread_by,
        rows_per_task=rows_per_task,
    )

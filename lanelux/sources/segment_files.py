"""Reader of the road segment export.

Quoted texts may hold line breaks, so whether a line begins a record depends on all lines before it. A line
is a function of that: it says whether a quoted text is open behind it, given whether one is open before.
Such functions are put together within each split of a file, then over the splits, so a file is read by as
many tasks as it has splits. Records of one line, nearly all, are parsed where they are; only lines of longer
records are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from lanelux.operators.joins import skew_safe_join
from lanelux.schemas import SEGMENT
from lanelux.session import settle

_CSV = {"sep": "\t", "quote": '"', "escape": "\\"}


def _open_behind(line: Column) -> Column:
    """Whether a quoted text is open behind ``line``, if none is before. Escaped signs are gone by now.

    Complete fields are taken off the front; an opening quote without its end is left.
    """
    return F.regexp_replace(line, r'\G(?:"[^"]*+"[^\t]*+|[^"\t][^\t]*+|)\t', "").rlike(r'\A"[^"]*+\z')


def _quote_states(line: Column) -> list[Column]:
    """Whether a quoted text is open behind ``line``, as 0 or 1, given that none is or that one is before."""
    bare = F.regexp_replace(line, r'\\["\\]', "x")
    closed = F.regexp_extract(bare, r'\A[^"]*+"[^\t]*+\t([\s\S]*)\z', 1)
    some = line.contains('"')
    inside = F.when(bare.contains('"'), _open_behind(closed)).otherwise(F.lit(True))
    outside = F.when(some, _open_behind(bare)).otherwise(F.lit(False))
    return [outside.cast("int"), F.when(some, inside).otherwise(F.lit(True)).cast("int")]


def _composed(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` with functions ``_f0`` and ``_f1`` put together in order: ``_b0`` and ``_b1`` up to each row, ``_a0``
    and ``_a1`` with it.

    A function that gives the same for both makes all before it forgotten; else only the swaps count.
    """
    span = Window.partitionBy(*keys).orderBy(*order)
    upto, before = (span.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    swaps = F.sum((F.col("_f0") > F.col("_f1")).cast("int"))
    rows = rows.withColumns({"_s": swaps.over(upto), "_p": F.coalesce(swaps.over(before), F.lit(0))})
    fixed = F.when(F.col("_f0") == F.col("_f1"), F.struct("_f0", "_s"))
    rows = rows.withColumns({"_c": F.last(fixed, True).over(upto), "_d": F.last(fixed, True).over(before)})

    def states(last: str, n: str) -> list[Column]:
        known = (F.col(f"{last}._f0") + F.col(n) - F.col(f"{last}._s")) % 2
        return [F.coalesce(known, (start + F.col(n)) % 2).cast("int") for start in (0, 1)]

    (b0, b1), (a0, a1) = states("_d", "_p"), states("_c", "_s")
    return rows.withColumns({"_b0": b0, "_b1": b1, "_a0": a0, "_a1": a1}).drop("_s", "_p", "_c", "_d", "_f0", "_f1")


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all files below ``path`` but the first of each file, as texts (``value``).

    A line ends at a line feed; a carriage return before it belongs to the break. Within a record, breaks
    are line feeds. Empty lines outside records are none. A quoted text that has no end goes to the end of
    its file, without the file's last break.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.regexp_replace("value", r"\r\z", "").alias("value"),
    )
    f0, f1 = _quote_states(F.col("value"))
    place = Window.partitionBy("file", "block").orderBy("seq")
    earlier = F.count_if(F.col("value") != "").over(place.rowsBetween(Window.unboundedPreceding, -1))
    head = (F.col("block") == 0) & (F.col("value") != "") & (F.coalesce(earlier, F.lit(0)) == 0)
    stated = _composed(lines.withColumns({"_f0": f0, "_f1": f1, "head": head}), ["file", "block"], ["seq"])
    # Splits need not be the same in another scan, so the lines are stored with what was found.
    stated = settle(stated, "segment-lines")

    blocks = stated.groupBy("file", "block").agg(F.max_by(F.struct("_a0", "_a1"), "seq").alias("_f"))
    blocks = _composed(blocks.select("file", "block", "_f._a0", "_f._a1").toDF("file", "block", "_f0", "_f1"), ["file"], ["block"])
    # No quoted text is open before a file begins.
    starts = settle(blocks.select("file", "block", F.col("_b0").alias("_open")), "segment-splits")
    placed = skew_safe_join(stated, starts, ["file", "block"], spread_by=["seq"])
    opened = F.col("_open") == 1
    lines = placed.select(
        "file", "block", "seq", "value", "head",
        F.when(opened, F.col("_b1")).otherwise(F.col("_b0")).alias("before"),
        F.when(opened, F.col("_a1")).otherwise(F.col("_a0")).alias("behind"),
    )
    single = lines.where("before = 0 and behind = 0 and not head and value <> ''").select("value")

    broken = settle(lines.where("before = 1 or behind = 1"), "segment-breaks")
    begins = F.when(F.col("before") == 0, F.struct("block", "seq"))
    last = broken.groupBy("file", "block").agg(F.max(begins).alias("_last"))
    carry = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "block", F.last("_last", True).over(carry).alias("_carried"))
    own = F.last(begins, True).over(place.rowsBetween(Window.unboundedPreceding, 0))
    owned = skew_safe_join(broken.withColumn("_own", own), carried, ["file", "block"], spread_by=["seq"])
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    records = owned.groupBy("file", F.coalesce("_own", "_carried").alias("_record")).agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"), F.max("head").alias("head")
    )
    return single.unionByName(records.where("not head").select("value"))


def read_segments(spark: SparkSession, path: str, quoted_breaks: bool = True) -> DataFrame:
    """Tab-separated segments; columns by position, the exported id is dropped.

    Every field is read as text and cast afterwards, so an empty number is
    NULL and a bad one does not stop the load; an empty text stays empty.
    A large export is read by many tasks. ``quoted_breaks`` allows line breaks inside quoted texts;
    where there are none, False saves a shuffle.
    """
    schema = ", ".join(f"`{n}` string" for n in SEGMENT.names)
    if quoted_breaks:
        rows = quoted_records(spark, path).select(F.from_csv("value", schema, _CSV).alias("_row")).select("_row.*")
    else:
        reader = spark.read.options(**_CSV).option("header", True).option("enforceSchema", True)
        rows = reader.option("encoding", "UTF-8").schema(schema).csv(path)
    return rows.select(*[_typed(f) for f in SEGMENT if f.name != "objectid"])


def _typed(field: StructField) -> Column:
    raw = F.col(field.name)
    if field.dataType.typeName() != "string":
        return F.trim(raw).try_cast(field.dataType).alias(field.name)
    # The reader knows one escape, the backslash. It leaves a quoted text with
    # doubled quotes as it stands, outer quotes included.
    doubled = raw.rlike(r'(?s)^".*"".*"$')
    inner = F.regexp_replace(raw.substr(F.lit(2), F.length(raw) - 2), r'(?s)\\(.)|"(")', "$1$2")
    return F.coalesce(F.when(doubled, inner).otherwise(raw), F.lit("")).alias(field.name)

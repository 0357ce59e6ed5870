"""Road segments under own management and their match with measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanelux.functions import text
from lanelux.operators.joins import BROADCAST_ROWS, ROWS_PER_TASK, interval_join
from lanelux.schemas import PROVINCES

# A cell of the road line, in kilometres, and the values a numeric(10,4) holds.
CELL_KM = 10.0
KMP_DOMAIN = (-1_000_000.0, 1_000_000.0)

# Column order of the stored table.
WEGCAT_COLUMNS = [
    "toestel", "ident8", "kmp", "tijdstip_meting", "meting_serie_naam", "markering",
    "locatieomschrijving", "rl", "rlmin", "rlmax", "rlstddev", "rlprocpass", "snelheid", "marker",
    "latitude_start", "longitude_start", "latitude_eind", "longitude_eind", "district", "provincie",
    "wegcategorie", "oid", "geoml72",
]


def province(area: Column) -> Column:
    digit = text.third_from_end(area)
    name = F.lit(None).cast("string")
    for code, province_name in PROVINCES.items():
        name = F.when(digit == code, province_name).otherwise(name)
    return name


def enrich(segments: DataFrame) -> DataFrame:
    """District and province of own segments; NULL for all others."""
    own = F.col("eigenbeheer") == "true"
    return segments.withColumns(
        {
            "district": F.when(own, text.right(F.col("gebied"), 6)),
            "provincie": F.when(own, province(F.col("gebied"))),
        }
    )


def _as_positions(bound: Column) -> Column:
    """A segment bound with the four decimals of a position.

    A position has four decimals, so rounding a begin up and an end down
    changes no match. The narrow type is compared as a plain number, the
    stored one with 38 digits is not.
    """
    least, most = (F.lit(str(int(v))).cast("decimal(38,4)") for v in KMP_DOMAIN)
    return F.least(F.greatest(bound.cast("decimal(38,4)"), least), most).cast("decimal(18,4)")


def on_segments(
    points: DataFrame,
    segments: DataFrame,
    ordered: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Measurements with the district, province and category of their segment.

    A point on a shared boundary belongs to both segments; a point outside all
    segments is left out. ``ordered`` sorts by road and position, with the row
    id as last key so that equal positions can still be split over tasks. ``keep`` names further columns
    of the points that stay.
    """
    # An open-ended segment is repeated for the cells that measurements lie in, and no others.
    found = points.agg(F.struct(F.min("kmp").alias("low"), F.max("kmp").alias("high"))).scalar()
    low, high = _as_positions(F.ceil("beginpositie", F.lit(4))), _as_positions(F.floor("eindpositie", F.lit(4)))
    located = interval_join(
        points.withColumn("meting_serie_naam", F.replace("meting_serie_naam", F.lit("\n"), F.lit(""))),
        segments.select("ident8", low.alias("_low"), high.alias("_high"), "district", "provincie", "wegcategorie"),
        ["ident8"],
        "kmp",
        "_low",
        "_high",
        cell=CELL_KM,
        domain=(found.getField("low"), found.getField("high")),
        spread_by=["oid"],
        broadcast_rows=broadcast_rows,
        rows_per_task=rows_per_task,
    )
    named = [c for c in WEGCAT_COLUMNS if c in points.columns or c in ("district", "provincie", "wegcategorie")]
    located = located.select(*named, *keep)
    return located.orderBy("ident8", "kmp", "oid") if ordered else located

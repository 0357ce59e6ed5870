"""Measurement points and lines derived from the imported measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanelux.functions import geo, text
from lanelux.functions.times import in_year
from lanelux.schemas import LAMBERT72_SRID

# Column order of the stored tables.
POINT_COLUMNS = [
    "oid", "bestands_url", "toestel", "meting_serie_naam", "ident8", "markering", "tijdstip_meting",
    "locatieomschrijving", "operator_naam", "kmp", "rl", "rlmax", "rlmin", "rlprocpass", "rlstddev",
    "vochtigheid", "snelheid", "marker", "latitude_start", "longitude_start", "latitude_eind",
    "longitude_eind", "geoml72", "x_coord", "y_coord", "start_coord", "eind_coord", "inleesdatum",
]
LINE_COLUMNS = [
    "oid", "bestands_url", "toestel", "meting_serie_naam", "marker", "markering", "tijdstip_meting",
    "locatieomschrijving", "operator_naam", "ident8", "kmp", "rl", "rlmax", "rlmin", "rlprocpass",
    "rlstddev", "vochtigheid", "kaart_offset", "snelheid", "inleesdatum", "geom_line", "lengte",
]


def measurement_points(raw: DataFrame, report_year: int) -> DataFrame:
    """Measurements of the survey year with their start point in Lambert 72.

    ``line_no`` is kept where it is known: file and line are the exact key.
    """
    rows = raw.where(in_year(F.col("tijdstip_meting"), report_year))
    rows = geo.with_lambert72(rows, "longitude_start", "latitude_start", "_mx", "_my")
    return rows.withColumns(
        {
            "ident8": text.left(F.col("meting_serie_naam"), 8),
            "geoml72": geo.point(F.col("_mx"), F.col("_my")),
            "x_coord": geo.whole_metre(F.col("_mx")),
            "y_coord": geo.whole_metre(F.col("_my")),
            "start_coord": text.coord_text(F.col("latitude_start"), F.col("longitude_start")),
            "eind_coord": text.coord_text(F.col("latitude_eind"), F.col("longitude_eind")),
        }
    ).select(*POINT_COLUMNS, *_line_number(raw))


def _line_number(rows: DataFrame) -> list[str]:
    return ["line_no"] if "line_no" in rows.columns else []


def _side(road: Column) -> Column:
    """1 or -1 by the direction digit that ends the road id."""
    digit = text.right(road, 1)
    return F.when(digit == "1", 1).when(digit == "2", -1)


def map_offset(marking: Column, road: Column) -> Column:
    """Drawing offset in metres by marking kind and direction; NULL for others."""
    kind = text.left(marking, 2)
    # Distance from the road axis.
    distance = F.when(kind == "M1", 2000).when(kind == "M2", 1000)
    return distance * _side(road)


def direction_offset(road: Column) -> Column:
    # Fixed value: distance from the road axis.
    return _side(road) * 1000


def with_line(points: DataFrame) -> DataFrame:
    """Add ``geom_line`` (end point first) and its planar length.

    The start point is already projected in ``geoml72``; only the end point is
    computed here.
    """
    rows = geo.with_lambert72(points, "longitude_eind", "latitude_eind", "_ex", "_ey")
    rows = rows.withColumn("geom_line", geo.line(geo.point(F.col("_ex"), F.col("_ey")), F.col("geoml72")))
    return rows.withColumn(
        "lengte",
        F.hypot(F.col("geoml72.x") - F.col("_ex"), F.col("geoml72.y") - F.col("_ey")),
    ).drop("_ex", "_ey")


def measurement_lines(points: DataFrame) -> DataFrame:
    """Lines of at most 100 m."""
    rows = with_line(points).where(F.col("lengte").between(0, 100))
    return rows.withColumn("kaart_offset", map_offset(F.col("markering"), F.col("ident8"))).select(
        *LINE_COLUMNS, *_line_number(points)
    )


def srid_check(rows: DataFrame, srid: str = "srid") -> DataFrame:
    """Number of rows and of rows outside the planar grid system."""
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col(srid).eqNullSafe(F.lit(LAMBERT72_SRID))).alias("n_violations"),
    )

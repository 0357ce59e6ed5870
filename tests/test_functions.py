import datetime
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lanelux.functions import geo, text, times
from lanelux.operators.points import direction_offset, map_offset
from lanelux.operators.segments import enrich


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("value, digit", [("Regio D11142", "1"), ("ab", "a"), ("", ""), (None, None)])
def test_third_from_end(spark, value, digit):
    assert one(spark, text.third_from_end(F.col("s")), s=value) == digit


@pytest.mark.parametrize(
    "lat, lon, shown",
    [
        (Decimal("50.700000000"), Decimal("2.600000000"), "50.700000000,2.600000000"),
        (None, Decimal("2.600000000"), ",2.600000000"),
        (None, None, ","),
    ],
)
def test_coord_text(spark, lat, lon, shown):
    df = spark.createDataFrame([(lat, lon)], "lat decimal(12,9), lon decimal(12,9)")
    assert df.select(text.coord_text(F.col("lat"), F.col("lon"))).first()[0] == shown


@pytest.mark.parametrize(
    "shown, value",
    [("12", 12), ("12,5", 13), ("-12,5", -13), ("12.4", 12), ("0,49999", 0), ("", None), ("x", None), (" 7 ", 7), ("99999999999", None)],
)
def test_to_int(spark, shown, value):
    assert one(spark, text.to_int(F.col("s")), s=shown) == value


@pytest.mark.parametrize(
    "shown, value", [("1,23456", Decimal("1.2346")), ("-1,00005", Decimal("-1.0001")), ("", None), ("1234567,0", None)]
)
def test_to_decimal(spark, shown, value):
    assert one(spark, text.to_decimal(F.col("s"), 10, 4), s=shown) == value


@pytest.mark.parametrize(
    "shown, value",
    [
        ("03/04/2023 05:06:07", datetime.datetime(2023, 4, 3, 5, 6, 7)),
        ("3/4/2023 5:6:7", datetime.datetime(2023, 4, 3, 5, 6, 7)),
        ("2023-04-03 05:06:07", datetime.datetime(2023, 4, 3, 5, 6, 7)),
        ("31/02/2023 05:06:07", None),
        ("2023/04/03 05:06:07", None),
        ("morgen", None),
        ("", None),
    ],
)
def test_measure_time(spark, shown, value):
    assert one(spark, times.measure_time(F.col("s")), s=shown) == value


def test_time_does_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Brussels")
        # This wall-clock time does not exist in that zone.
        got = one(spark, times.measure_time(F.col("s")), s="26/03/2023 02:30:00")
        assert got == datetime.datetime(2023, 3, 26, 2, 30)
        assert spark.range(1).select(times.stamp(datetime.datetime(2024, 1, 1, 12))).first()[0] == datetime.datetime(2024, 1, 1, 12)
        assert one(spark, times.iso_text(times.measure_time(F.col("s"))), s="26/03/2023 02:30:00") == "2023-03-26 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_measure_time_legacy(spark):
    want = datetime.datetime(2022, 1, 9, 8, 7, 6)
    for shown in ("09/01/2022 08:07:06", "9-1-2022 8:7:6"):
        assert one(spark, times.measure_time_legacy(F.col("s")), s=shown) == want


@pytest.mark.parametrize(
    "slots, names",
    [
        (["-"] * 6, ["-", "-"]),
        (["-", "a.jpgb.jpg", "-", "c.jpgd.jpg", "e.jpgf.jpg", "-"], ["b.jpg", "d.jpg"]),
        (["a.jpgb.jpg", "-", "-", "-", "-", "-"], ["b.jpg", "-"]),
        (["geen", "-", "-", "-", "-", "x.jpgy.jpg"], ["-", "y.jpg"]),
        (["a.jpg", "-", "-", "-", "-", "-"], [".jpg", "-"]),
    ],
)
def test_photo_names(spark, slots, names):
    df = spark.createDataFrame([(slots,)], "s array<string>")
    first, second = text.photo_names(F.col("s"))
    assert list(df.select(first, second).first()) == names


@pytest.mark.parametrize(
    "name, folder, series, ok",
    [
        ("N0010001 M1.xls", "N0010001", "N0010001 M1", True),
        ("N0010001 M2.xls", "N0010001", "N0010001 M1", False),
        ("N0010001 M1.xls", "N0010002", "N0010001 M1", False),
    ],
)
def test_name_conform(spark, name, folder, series, ok):
    expr = text.name_conform(F.col("n"), F.col("f"), F.col("s"))
    assert one(spark, expr, n=name, f=folder, s=series) is ok


def test_file_stem_of_short_names(spark):
    assert [one(spark, text.file_stem(F.col("n")), n=n) for n in ("a.xls", ".xls", "ab", "")] == ["a", "", "", ""]


def test_conformity_status(spark):
    expr = text.conformity_status(F.col("n"), F.col("f"), F.col("s"))
    assert one(spark, expr, n="A M1", f="A", s="A M1\r\n") == "bestandsnaam conform header / bestandsmap conform header"
    assert (
        one(spark, expr, n="B M1", f="B", s="A M1")
        == " bestandsnaam NIET conform header / bestandsmap NIET conform header!"
    )


@pytest.mark.parametrize(
    "marking, road, offset", [("M1", "N0010001", 2000), ("M2R", "N0010001", 1000), ("M1", "N0010002", -2000), ("M2", "N0010002", -1000), ("M3", "N0010001", None), ("M1", "N0010003", None)]
)
def test_map_offset(spark, marking, road, offset):
    assert one(spark, map_offset(F.col("m"), F.col("r")), m=marking, r=road) == offset


def test_direction_offset(spark):
    assert [one(spark, direction_offset(F.col("r")), r=r) for r in ("N1", "N2", "N3")] == [1000, -1000, None]


def test_enrich_only_own_segments(spark, rows):
    s = spark.createDataFrame(
        [("Regio D11142", "true"), ("Regio D11142", "false"), ("Regio D11942", "true"), ("Regio D11742", "True"), ("Regio D11742", "true")],
        "gebied string, eigenbeheer string",
    )
    got = [tuple(r) for r in enrich(s).select("district", "provincie").collect()]
    assert got == [
        ("D11142", "Antwerpen"),
        (None, None),
        ("D11942", None),
        (None, None),
        ("D11742", "Limburg"),
    ]


# --- geometry ---------------------------------------------------------------


def _radians(degrees, minutes, seconds):
    return math.radians(degrees + minutes / 60 + seconds / 3600)


def test_conic_reproduces_the_published_example(spark):
    """The published example of the Belgian cone: 50 40 46.461 N, 5 48 26.533 E."""
    # The example uses the older origin; its longitude offset is taken out first.
    shift = math.radians(geo.CENTRAL_MERIDIAN) - (_radians(4, 21, 24.983) + math.radians(29.2985 / 3600) / geo.cone().n)
    lat, lon = _radians(50, 40, 46.461), _radians(5, 48, 26.533) + shift
    df = spark.range(1).select(F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))
    got = geo.with_conic(df, "lat", "lon", "x", "y").first()
    assert abs(got["x"] - 251763.20) < 0.05
    assert abs(got["y"] - 153034.13) < 0.05


def _forward(lon, lat):
    """Independent check: the datum shift by explicit matrix inversion, latitude by iteration."""
    import numpy as np

    def cartesian(lon, lat, a, inv_f):
        f = 1 / inv_f
        e2 = f * (2 - f)
        nu = a / math.sqrt(1 - e2 * math.sin(lat) ** 2)
        return np.array([nu * math.cos(lat) * math.cos(lon), nu * math.cos(lat) * math.sin(lon), nu * (1 - e2) * math.sin(lat)])

    rx, ry, rz = (math.radians(s / 3600) for s in geo.ROTATION_SEC)
    turn = np.array([[1, -rz, ry], [rz, 1, -rx], [-ry, rx, 1]])
    scale = 1 + geo.SCALE_PPM * 1e-6
    xyz = np.linalg.solve(turn * scale, cartesian(math.radians(lon), math.radians(lat), geo.WGS84_A, geo.WGS84_INV_F) - np.array(geo.SHIFT_M))
    f = 1 / geo.INTL24_INV_F
    e2, e = f * (2 - f), math.sqrt(f * (2 - f))
    p, phi = math.hypot(xyz[0], xyz[1]), math.atan2(xyz[2], math.hypot(xyz[0], xyz[1]))
    for _ in range(30):
        nu = geo.INTL24_A / math.sqrt(1 - e2 * math.sin(phi) ** 2)
        phi = math.atan2(xyz[2] + e2 * nu * math.sin(phi), p)

    def t(v):
        return math.tan(math.pi / 4 - v / 2) / ((1 - e * math.sin(v)) / (1 + e * math.sin(v))) ** (e / 2)

    def m(v):
        return math.cos(v) / math.sqrt(1 - e2 * math.sin(v) ** 2)

    p1, p2 = _radians(51, 10, 0.00204), _radians(49, 50, 0.00204)
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    r = geo.INTL24_A * m(p1) / (n * t(p1) ** n) * t(phi) ** n
    theta = n * (math.atan2(xyz[1], xyz[0]) - _radians(4, 22, 2.952))
    return 150000.013 + r * math.sin(theta), 5400088.438 - r * math.cos(theta)


def test_lambert72_equals_an_independent_computation(spark):
    places = [(2.6, 50.7), (3.22, 51.2), (4.35, 50.85), (4.4, 51.22), (5.9, 51.1), (6.1, 50.5)]
    df = geo.with_lambert72(spark.createDataFrame(places, "lon double, lat double"), "lon", "lat", "x", "y")
    for row in df.collect():
        x, y = _forward(row["lon"], row["lat"])
        assert abs(row["x"] - x) < 0.005 and abs(row["y"] - y) < 0.005


def test_round_trip_over_the_whole_country(spark):
    """Back by other formulas, a millimetre at most is lost anywhere; a wrong sign of a rotation would be metres."""
    grid = spark.range(60 * 60).selectExpr("2.4 + (id % 60) * 0.07 AS lon", "49.4 + (id div 60) * 0.04 AS lat")
    there = geo.with_lambert72(grid, "lon", "lat", "x", "y")
    back = geo.with_wgs84(there, "x", "y", "lon2", "lat2")
    off = geo.ground_distance(F.col("lon2"), F.col("lat2"), F.col("lon"), F.col("lat"))
    most, n = back.agg(F.max(off), F.count(off)).first()
    assert n == 3600 and most < 0.001
    plane = geo.with_lambert72(back.select("x", "y", F.col("lon2").alias("l"), F.col("lat2").alias("b")), "l", "b", "x2", "y2")
    assert plane.agg(F.max(F.hypot(F.col("x2") - F.col("x"), F.col("y2") - F.col("y")))).first()[0] < 0.001


def test_published_point_of_the_cone_backwards(spark):
    """The example that comes with the definition of the projection, from the plane to the ellipsoid."""
    shift = math.radians(geo.CENTRAL_MERIDIAN) - (_radians(4, 21, 24.983) + math.radians(29.2985 / 3600) / geo.cone().n)
    df = spark.createDataFrame([(251763.20, 153034.13)], "x double, y double")
    row = geo.with_geodetic(df, "x", "y", "lat", "lon").first()
    assert row["lat"] == pytest.approx(_radians(50, 40, 46.461), abs=1e-8)  # 6 cm, as the way there
    assert row["lon"] - shift == pytest.approx(_radians(5, 48, 26.533), abs=1e-8)


def test_lambert72_keeps_null_and_plan_small(spark):
    df = geo.with_lambert72(spark.createDataFrame([(None, 50.0)], "lon double, lat double"), "lon", "lat", "x", "y")
    assert df.first()["x"] is None
    plan = df.where(F.col("x").between(0, 100))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000


def test_whole_metre_rounds_half_to_even(spark):
    assert [one(spark, geo.whole_metre(F.col("v")), v=v) for v in (0.5, 1.5, 2.5, -0.5, 2.4)] == [0, 2, 2, 0, 2]


def test_line_puts_the_end_first(spark):
    line = geo.line(geo.point(F.lit(3.0), F.lit(4.0)), geo.point(F.lit(0.0), F.lit(0.0)))
    df = spark.range(1).select(line.alias("g"))
    row = df.select("g.p0.x", "g.p1.x", geo.line_length(F.col("g"))).first()
    assert list(row) == [3.0, 0.0, 5.0]

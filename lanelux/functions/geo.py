"""WGS84 to Belgian Lambert 72 (EPSG 4326 to 31370) as native columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published parameters of the two ellipsoids, the datum shift
# (position vector, BD72 to WGS84) and the conic projection.
WGS84_A, WGS84_INV_F = 6378137.0, 298.257223563
INTL24_A, INTL24_INV_F = 6378388.0, 297.0
SHIFT_M = (-106.8686, 52.2978, -103.7239)
ROTATION_SEC = (0.3366, -0.457, 1.8422)
SCALE_PPM = -1.2747
PARALLEL_1 = 51.16666723333333
PARALLEL_2 = 49.8333339
CENTRAL_MERIDIAN = 4.367486666666666
FALSE_EASTING = 150000.013
FALSE_NORTHING = 5400088.438


def _e2(inv_f: float) -> float:
    f = 1.0 / inv_f
    return f * (2.0 - f)


@dataclass(frozen=True)
class Cone:
    """Constants that depend on the parameters only."""

    e: float
    n: float
    scale: float


def cone() -> Cone:
    e = math.sqrt(_e2(INTL24_INV_F))
    m, t = [], []
    for parallel in (PARALLEL_1, PARALLEL_2):
        phi = math.radians(parallel)
        s = e * math.sin(phi)
        m.append(math.cos(phi) / math.sqrt(1.0 - s * s))
        t.append(math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2))
    n = math.log(m[0] / m[1]) / math.log(t[0] / t[1])
    return Cone(e, n, INTL24_A * m[0] / (n * t[0] ** n))


def _add(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def with_conic(df: DataFrame, lat: str, lon: str, x: str, y: str) -> DataFrame:
    """Project geodetic BD72 radians in ``lat``/``lon`` to metres."""
    c = cone()
    es = F.lit(c.e) * F.sin(lat)
    df = _add(df, _es=es)
    t = F.tan(F.lit(math.pi / 4) - F.col(lat) / 2) / F.pow(
        (1 - F.col("_es")) / (1 + F.col("_es")), F.lit(c.e / 2)
    )
    df = _add(df, _r=F.lit(c.scale) * F.pow(t, F.lit(c.n)), _th=F.lit(c.n) * (F.col(lon) - math.radians(CENTRAL_MERIDIAN)))
    df = _add(
        df,
        **{
            x: F.lit(FALSE_EASTING) + F.col("_r") * F.sin("_th"),
            y: F.lit(FALSE_NORTHING) - F.col("_r") * F.cos("_th"),
        },
    )
    return df.drop("_es", "_r", "_th")


def with_lambert72(df: DataFrame, lon: str, lat: str, x: str, y: str) -> DataFrame:
    """Add planar metres ``x``/``y`` for the degrees in ``lon``/``lat``.

    Every step names its intermediate results, so the optimizer keeps them as
    separate projections and computes each of them once per row. The result
    passes through a one-element ``inline``: a later filter on ``x`` or ``y``
    stops there instead of being rewritten in terms of the degrees, which would
    repeat the whole formula for every reference.
    """
    given = df.columns
    e2w = _e2(WGS84_INV_F)
    df = _add(df, _phi=F.radians(F.col(lat).cast("double")), _lam=F.radians(F.col(lon).cast("double")))
    df = _add(df, _sp=F.sin("_phi"), _cp=F.cos("_phi"))
    df = _add(df, _nu=F.lit(WGS84_A) / F.sqrt(1 - F.lit(e2w) * F.col("_sp") * F.col("_sp")))
    df = _add(df, _q=F.col("_nu") * F.col("_cp"))

    m = 1.0 + SCALE_PPM * 1e-6
    df = _add(
        df,
        _u=(F.col("_q") * F.cos("_lam") - SHIFT_M[0]) / m,
        _v=(F.col("_q") * F.sin("_lam") - SHIFT_M[1]) / m,
        _w=(F.col("_nu") * (1 - e2w) * F.col("_sp") - SHIFT_M[2]) / m,
    )
    rx, ry, rz = (math.radians(s / 3600.0) for s in ROTATION_SEC)
    df = _add(
        df,
        _x=F.col("_u") + rz * F.col("_v") - ry * F.col("_w"),
        _y=F.col("_v") - rz * F.col("_u") + rx * F.col("_w"),
        _z=F.col("_w") + ry * F.col("_u") - rx * F.col("_v"),
    )

    # Geocentric to geodetic with Bowring's parametric latitude.
    a = INTL24_A
    e2 = _e2(INTL24_INV_F)
    b = a * math.sqrt(1 - e2)
    df = _add(df, _p=F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y")))
    df = _add(df, _beta=F.atan2(F.col("_z") * a, F.col("_p") * b), _blon=F.atan2(F.col("_y"), F.col("_x")))
    df = _add(df, _sb=F.sin("_beta"), _cb=F.cos("_beta"))
    df = _add(
        df,
        _blat=F.atan2(
            F.col("_z") + e2 / (1 - e2) * b * F.col("_sb") * F.col("_sb") * F.col("_sb"),
            F.col("_p") - e2 * a * F.col("_cb") * F.col("_cb") * F.col("_cb"),
        ),
    )
    df = with_conic(df, "_blat", "_blon", "_east", "_north")
    return df.select(*given, F.inline(F.array(F.struct(F.col("_east").alias(x), F.col("_north").alias(y)))))


#: Rounds of the iterated latitudes; each gains two digits or more.
_ROUNDS = 6


def with_geodetic(df: DataFrame, x: str, y: str, lat: str, lon: str) -> DataFrame:
    """Geodetic BD72 radians ``lat``/``lon`` of planar metres: :func:`with_conic` backwards, the latitude iterated."""
    c = cone()
    df = _add(df, _dx=F.col(x) - FALSE_EASTING, _dy=F.lit(FALSE_NORTHING) - F.col(y))
    df = _add(df, _t=F.pow(F.hypot("_dx", "_dy") / c.scale, F.lit(1 / c.n)))
    df = _add(df, **{lon: F.atan2("_dx", "_dy") / c.n + math.radians(CENTRAL_MERIDIAN)}, _l0=math.pi / 2 - 2 * F.atan("_t"))
    for k in range(_ROUNDS):
        es = F.lit(c.e) * F.sin(f"_l{k}")
        bent = F.col("_t") * F.pow((1 - es) / (1 + es), F.lit(c.e / 2))
        df = _add(df, **{f"_l{k + 1}": math.pi / 2 - 2 * F.atan(bent)})
    return df.withColumn(lat, F.col(f"_l{_ROUNDS}")).drop("_dx", "_dy", "_t", *[f"_l{k}" for k in range(_ROUNDS + 1)])


def _with_cartesian(df: DataFrame, lat: str, lon: str, height: Column, a: float, inv_f: float, names: list[str]) -> DataFrame:
    e2 = _e2(inv_f)
    nu = F.lit(a) / F.sqrt(1 - F.lit(e2) * F.sin(lat) * F.sin(lat))
    df = _add(df, _nu=nu, _h=height)
    out = F.col("_nu") + F.col("_h")
    xyz = [out * F.cos(lat) * F.cos(lon), out * F.cos(lat) * F.sin(lon), (F.col("_nu") * (1 - e2) + F.col("_h")) * F.sin(lat)]
    return _add(df, **dict(zip(names, xyz, strict=True))).drop("_nu", "_h")


def with_wgs84(df: DataFrame, x: str, y: str, lon: str, lat: str) -> DataFrame:
    """Add degrees ``lon``/``lat`` on the WGS84 ellipsoid for planar metres: :func:`with_lambert72` backwards.

    The datum shift is taken in the direction it is published for, BD72 to WGS84, and all latitudes are
    iterated, so this shares no formula with the way there. The height over the older ellipsoid is found
    with which the point lies on the newer one.
    """
    given = df.columns
    e2 = _e2(WGS84_INV_F)
    df = with_geodetic(df, x, y, "_blat", "_blon").withColumn("_h0", F.lit(0.0))
    rx, ry, rz = (math.radians(s / 3600.0) for s in ROTATION_SEC)
    m = 1.0 + SCALE_PPM * 1e-6
    for k in range(3):
        df = _with_cartesian(df, "_blat", "_blon", F.col(f"_h{k}"), INTL24_A, INTL24_INV_F, ["_u", "_v", "_w"])
        df = _add(
            df,
            _x=SHIFT_M[0] + m * (F.col("_u") - rz * F.col("_v") + ry * F.col("_w")),
            _y=SHIFT_M[1] + m * (rz * F.col("_u") + F.col("_v") - rx * F.col("_w")),
            _z=SHIFT_M[2] + m * (-ry * F.col("_u") + rx * F.col("_v") + F.col("_w")),
        )
        df = _add(df, _p=F.hypot("_x", "_y"))
        df = _add(df, _f0=F.atan2(F.col("_z"), F.col("_p") * (1 - e2)))
        for n in range(_ROUNDS):
            sine = F.sin(f"_f{n}")
            nu = F.lit(WGS84_A) / F.sqrt(1 - F.lit(e2) * sine * sine)
            df = _add(df, **{f"_f{n + 1}": F.atan2(F.col("_z") + F.lit(e2) * nu * sine, F.col("_p"))})
        df = _add(df, _lat=F.col(f"_f{_ROUNDS}"))
        nu = F.lit(WGS84_A) / F.sqrt(1 - F.lit(e2) * F.sin("_lat") * F.sin("_lat"))
        df = _add(df, **{f"_h{k + 1}": F.col(f"_h{k}") - (F.col("_p") / F.cos("_lat") - nu)})
    found = F.struct(F.degrees(F.atan2("_y", "_x")).alias(lon), F.degrees("_lat").alias(lat))
    return df.select(*given, F.inline(F.array(found)))


def ground_distance(lon: Column, lat: Column, other_lon: Column, other_lat: Column) -> Column:
    """Metres between two places in degrees that are close together."""
    metre = math.radians(1) * WGS84_A
    return F.hypot((lon - other_lon) * F.cos(F.radians(lat)) * metre, (lat - other_lat) * metre)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def whole_metre(value: Column) -> Column:
    """Nearest integer, ties to the even one."""
    return F.rint(value).cast("int")


def line(end: Column, start: Column) -> Column:
    """Two-point line; the end point comes first."""
    return F.struct(end.alias("p0"), start.alias("p1"))


def line_length(geom: Column) -> Column:
    p0, p1 = geom.getField("p0"), geom.getField("p1")
    return F.hypot(p1.getField("x") - p0.getField("x"), p1.getField("y") - p0.getField("y"))

"""Coordinate reference systems as closed-form column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 ellipsoid, UTM scale and false easting, sphere radius of web maps.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_EASTING = 500000.0
SPHERE_R = 6378137.0
MAX_MERCATOR_LAT = 85.0511287798

SUPPORTED = ("EPSG:4326", "EPSG:3857", "EPSG:3067")


def normalise_crs(crs: Column) -> Column:
    """``3067`` and ``EPSG:3067`` mean the same; empty means longitude/latitude."""
    raw = F.trim(F.coalesce(crs, F.lit("")))
    return (
        F.when(raw == "", F.lit("EPSG:4326")).when(raw.rlike(r"^\d+$"), F.concat(F.lit("EPSG:"), raw)).otherwise(raw)
    )


def known_crs(crs: Column) -> Column:
    return normalise_crs(crs).isin(*SUPPORTED)


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical Mercator metres; latitudes are held inside the square web-map extent."""
    held = F.greatest(F.least(lat, F.lit(MAX_MERCATOR_LAT)), F.lit(-MAX_MERCATOR_LAT))
    s = F.sin(F.radians(held))
    return F.radians(lon) * SPHERE_R, F.log((1 + s) / (1 - s)) * (SPHERE_R / 2)


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    lat = F.atan(F.exp(y / SPHERE_R)) * 2 - math.pi / 2
    return F.degrees(x / SPHERE_R), F.degrees(lat)


# Third flattening and rectifying radius of the ellipsoid; series after Karney (2011), to n^6.
_N = WGS84_F / (2 - WGS84_F)
_E = math.sqrt(WGS84_F * (2 - WGS84_F))
_RADIUS = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)


def _series(*rows: tuple[float, ...]) -> list[float]:
    """Evaluate each row as a polynomial in n whose first power is the row's position."""
    return [sum(c * _N ** (j + i) for i, c in enumerate(row)) for j, row in enumerate(rows, 1)]


# Published series coefficients, geographic to projected and back.
_ALPHA = _series(
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
_BETA = _series(
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)


def utm_central_meridian(zone: int) -> float:
    return zone * 6.0 - 183.0


def to_utm(lon: Column, lat: Column, zone: int = 35) -> tuple[Column, Column]:
    """Northern UTM metres on WGS84."""
    lam = F.radians(lon - utm_central_meridian(zone))
    s = F.sin(F.radians(lat))
    tau = F.sinh(F.atanh(s) - F.atanh(s * _E) * _E)
    xi = F.atan2(tau, F.cos(lam))
    eta = F.asinh(F.sin(lam) / F.sqrt(tau * tau + F.cos(lam) * F.cos(lam)))
    east, north = eta, xi
    for j, alpha in enumerate(_ALPHA, 1):
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * alpha
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * alpha
    return east * (UTM_K0 * _RADIUS) + UTM_EASTING, north * (UTM_K0 * _RADIUS)


def from_utm(x: Column, y: Column, zone: int = 35) -> tuple[Column, Column]:
    eta = (x - UTM_EASTING) / (UTM_K0 * _RADIUS)
    xi = y / (UTM_K0 * _RADIUS)
    east, north = eta, xi
    for j, beta in enumerate(_BETA, 1):
        east = east - F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * beta
        north = north - F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * beta
    # Conformal latitude first; the geodetic one is the fixed point of a fast contraction.
    conformal = F.asin(F.sin(north) / F.cosh(east))
    psi = F.atanh(F.sin(conformal))
    sin_lat = F.tanh(psi)
    for _ in range(6):
        sin_lat = F.tanh(psi + F.atanh(sin_lat * _E) * _E)
    lam = F.atan2(F.sinh(east), F.cos(north))
    return F.degrees(lam) + utm_central_meridian(zone), F.degrees(F.asin(sin_lat))


def _forward(crs: str, lon: Column, lat: Column) -> tuple[Column, Column]:
    return {"EPSG:3857": to_mercator, "EPSG:3067": to_utm}.get(crs, lambda a, b: (a, b))(lon, lat)


def _inverse(crs: str, x: Column, y: Column) -> tuple[Column, Column]:
    return {"EPSG:3857": from_mercator, "EPSG:3067": from_utm}.get(crs, lambda a, b: (a, b))(x, y)


def reproject(df: DataFrame, x: str, y: str, src: str, dst: str, out: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Add ``out`` columns with (x, y) of ``src`` expressed in ``dst``."""
    for crs in (src, dst):
        if crs not in SUPPORTED:
            raise ValueError(f"unknown coordinate reference system {crs}; supported: {', '.join(SUPPORTED)}")
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    if src != dst:
        px, py = _forward(dst, *_inverse(src, px, py))
    return df.withColumns({out[0]: px, out[1]: py})


def reproject_by_column(df: DataFrame, lon: str, lat: str, crs: str, out: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Project lon/lat to each row's own ``crs``; rows of an unknown one fail the job."""
    name = normalise_crs(F.col(crs))
    exprs = []
    for axis in (0, 1):
        expr = None
        for known in SUPPORTED:
            value = _forward(known, F.col(lon).cast("double"), F.col(lat).cast("double"))[axis]
            expr = F.when(name == known, value) if expr is None else expr.when(name == known, value)
        exprs.append(
            expr.otherwise(F.raise_error(F.concat(F.lit("unknown coordinate reference system "), name)).cast("double"))
        )
    return df.withColumns({out[0]: exprs[0], out[1]: exprs[1]})

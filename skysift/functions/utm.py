"""Transverse Mercator by the Krüger series, as column functions (WGS 84 UTM)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from skysift.functions.boxes import let

_A, _F = 6378137.0, 1 / 298.257223563
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_E = math.sqrt(_F * (2 - _F))
_K0, _EAST = 0.9996, 500000.0
_FORWARD = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_INVERSE = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)


def _meridian(epsg: Column) -> Column:
    zone = epsg % 100
    return F.radians((zone * 6 - 183).cast("double"))


def to_utm(lon: Column, lat: Column, epsg: Column) -> tuple[Column, Column]:
    """(easting, northing) in the zone of a 326xx or 327xx code."""
    phi, lam = F.radians(lat.cast("double")), F.radians(lon.cast("double")) - _meridian(epsg)
    t = F.sinh(F.atanh(F.sin(phi)) - _E * F.atanh(_E * F.sin(phi)))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_FORWARD, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    south = F.when(epsg >= 32700, 10_000_000.0).otherwise(0.0)
    return _EAST + _K0 * _RADIUS * x, south + _K0 * _RADIUS * y


def from_utm(east: Column, north: Column, epsg: Column) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees."""
    south = F.when(epsg >= 32700, 10_000_000.0).otherwise(0.0)
    xi0, eta0 = (north - south) / (_K0 * _RADIUS), (east - _EAST) / (_K0 * _RADIUS)
    xi, eta = xi0, eta0
    for j, b in enumerate(_INVERSE, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    # Conformal to geographic latitude by fixed-point steps; three reach the last bits.
    phi = chi
    for _ in range(4):
        phi = F.asin(F.tanh(F.atanh(F.sin(chi)) + _E * F.atanh(_E * F.sin(phi))))
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi)) + _meridian(epsg)), F.degrees(phi)


def reprojected(ring: Column, source: Column, target: Column) -> Column:
    """A ring of struct(x, y) from one EPSG code to another: 4326 and the WGS 84 UTM zones, by way of degrees."""
    source, target = known_crs(source), known_crs(target)

    def move(p: Column) -> Column:
        lon, lat = (F.when(source == 4326, d).otherwise(m) for d, m in zip((p["x"], p["y"]), from_utm(p["x"], p["y"], source), strict=True))
        return let(F.struct(lon.alias("x"), lat.alias("y")), place)

    def place(p: Column) -> Column:
        east, north = (F.when(target == 4326, d).otherwise(m) for d, m in zip((p["x"], p["y"]), to_utm(p["x"], p["y"], target), strict=True))
        return F.struct(east.alias("x"), north.alias("y"))

    return F.when(source == target, ring).otherwise(F.transform(ring, move))


def known_crs(epsg: Column) -> Column:
    """The code where it is supported, else an error: 4326, 32601-32660 and 32701-32760."""
    good = (epsg == 4326) | epsg.between(32601, 32660) | epsg.between(32701, 32760)
    return F.when(good, epsg).otherwise(F.raise_error(F.concat(F.lit("unsupported CRS EPSG:"), epsg.cast("string"))).cast("int"))

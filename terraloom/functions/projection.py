"""Map projections as column expressions and as numpy functions over the same formulas."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The sphere of web maps and its latitude limit; the ellipsoid, scale and false origin of UTM.
SPHERE_R, MOST_LATITUDE = 6378137.0, 85.05112878
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
UTM_K0, UTM_E0, UTM_N0_SOUTH = 0.9996, 500000.0, 10000000.0

_N = WGS84_F / (2 - WGS84_F)
_E = (WGS84_F * (2 - WGS84_F)) ** 0.5
#: Rectifying radius, and the Krueger series of both directions in powers of the third flattening.
_RADIUS = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
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

_COLUMN = SimpleNamespace(sin=F.sin, cos=F.cos, tan=F.tan, sinh=F.sinh, cosh=F.cosh, tanh=F.tanh, asinh=F.asinh, atanh=F.atanh, atan=F.atan, atan2=F.atan2, sqrt=F.sqrt, exp=F.exp, log=F.log)
_NUMPY = SimpleNamespace(sin=np.sin, cos=np.cos, tan=np.tan, sinh=np.sinh, cosh=np.cosh, tanh=np.tanh, asinh=np.arcsinh, atanh=np.arctanh, atan=np.arctan, atan2=np.arctan2, sqrt=np.sqrt, exp=np.exp, log=np.log)
_DEGREE = np.pi / 180


def _ops(x):
    return _COLUMN if isinstance(x, Column) else _NUMPY


def utm_zone(lon, lat):
    """EPSG code of the zone; no exceptions for single countries."""
    if isinstance(lon, Column):
        zone = F.floor((lon + 180) / 6) + 1
        return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("int")
    return int(np.floor((lon + 180) / 6) + 1) + (32600 if lat >= 0 else 32700)


def _central(epsg: int) -> tuple[float, float]:
    zone, south = epsg % 100, epsg // 100 == 327
    if epsg // 100 not in (326, 327) or not 1 <= zone <= 61:
        raise ValueError(f"not a UTM code: {epsg}")
    return (zone * 6 - 183) * _DEGREE, UTM_N0_SOUTH if south else 0.0


def utm_forward(lon, lat, epsg: int):
    """Easting and northing of degrees; columns or arrays."""
    o, (lon0, north0) = _ops(lon), _central(epsg)
    phi, lam = lat * _DEGREE, lon * _DEGREE - lon0
    tau = o.tan(phi)
    sigma = o.sinh(_E * o.atanh(_E * tau / o.sqrt(tau * tau + 1)))
    conformal = tau * o.sqrt(sigma * sigma + 1) - sigma * o.sqrt(tau * tau + 1)
    xi = o.atan2(conformal, o.cos(lam))
    eta = o.asinh(o.sin(lam) / o.sqrt(conformal * conformal + o.cos(lam) * o.cos(lam)))
    north, east = xi, eta
    for j, a in enumerate(_FORWARD, 1):
        north = north + a * o.sin(2 * j * xi) * o.cosh(2 * j * eta)
        east = east + a * o.cos(2 * j * xi) * o.sinh(2 * j * eta)
    return east * (UTM_K0 * _RADIUS) + UTM_E0, north * (UTM_K0 * _RADIUS) + north0


def utm_inverse(east, north, epsg: int):
    """Degrees of easting and northing; the conformal latitude is inverted by Newton steps."""
    o, (lon0, north0) = _ops(east), _central(epsg)
    xi, eta = (north - north0) / (UTM_K0 * _RADIUS), (east - UTM_E0) / (UTM_K0 * _RADIUS)
    a, b = xi, eta
    for j, c in enumerate(_INVERSE, 1):
        a = a - c * o.sin(2 * j * xi) * o.cosh(2 * j * eta)
        b = b - c * o.cos(2 * j * xi) * o.sinh(2 * j * eta)
    conformal = o.sin(a) / o.sqrt(o.sinh(b) * o.sinh(b) + o.cos(a) * o.cos(a))
    tau = conformal
    for _ in range(3):
        sigma = o.sinh(_E * o.atanh(_E * tau / o.sqrt(tau * tau + 1)))
        guess = tau * o.sqrt(sigma * sigma + 1) - sigma * o.sqrt(tau * tau + 1)
        step = (conformal - guess) / o.sqrt(guess * guess + 1) * (tau * tau * (1 - _E**2) + 1) / ((1 - _E**2) * o.sqrt(tau * tau + 1))
        tau = tau + step
    lon = (o.atan2(o.sinh(b), o.cos(a)) + lon0) / _DEGREE
    return lon, o.atan(tau) / _DEGREE


def mercator_forward(lon, lat):
    """Metres on the sphere; latitudes are clamped to the map's limit."""
    o = _ops(lon)
    lat = F.greatest(F.lit(-MOST_LATITUDE), F.least(F.lit(MOST_LATITUDE), lat)) if isinstance(lat, Column) else np.clip(lat, -MOST_LATITUDE, MOST_LATITUDE)
    return lon * (_DEGREE * SPHERE_R), o.log(o.tan(lat * (_DEGREE / 2) + np.pi / 4)) * SPHERE_R


def mercator_inverse(x, y):
    o = _ops(x)
    return x * (1 / (_DEGREE * SPHERE_R)), (o.atan(o.exp(y * (1 / SPHERE_R))) * 2 - np.pi / 2) * (1 / _DEGREE)

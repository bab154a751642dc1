"""Coordinates on WGS84 as column expressions: geodetic, Earth-centred (ECEF) and local (east, north, up)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)

Value = Column | float
Triple = tuple[Column, Column, Column]


def _c(v: Value) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def geodetic_to_ecef(lat: Value, lon: Value, height: Value) -> Triple:
    """Latitude and longitude in degrees and ellipsoidal height in metres to x, y, z in metres."""
    lat, lon, height = F.radians(_c(lat)), F.radians(_c(lon)), _c(height)
    n = F.lit(SEMI_MAJOR) / F.sqrt(F.lit(1.0) - F.lit(E2) * F.sin(lat) * F.sin(lat))
    return (n + height) * F.cos(lat) * F.cos(lon), (n + height) * F.cos(lat) * F.sin(lon), (n * F.lit(1.0 - E2) + height) * F.sin(lat)


def ecef_to_enu(xyz: tuple[Value, Value, Value], origin_xyz: tuple[Value, Value, Value], lat0: Value, lon0: Value) -> Triple:
    """A point relative to an origin, rotated to the origin's east, north and up."""
    dx, dy, dz = (_c(a) - _c(b) for a, b in zip(xyz, origin_xyz, strict=True))
    la, lo = F.radians(_c(lat0)), F.radians(_c(lon0))
    east = -F.sin(lo) * dx + F.cos(lo) * dy
    north = -F.sin(la) * F.cos(lo) * dx - F.sin(la) * F.sin(lo) * dy + F.cos(la) * dz
    up = F.cos(la) * F.cos(lo) * dx + F.cos(la) * F.sin(lo) * dy + F.sin(la) * dz
    return east, north, up


def enu_to_ecef(enu: tuple[Value, Value, Value], origin_xyz: tuple[Value, Value, Value], lat0: Value, lon0: Value) -> Triple:
    """The true inverse of ecef_to_enu: the transposed rotation, not one with negated angles."""
    e, n, u = map(_c, enu)
    la, lo = F.radians(_c(lat0)), F.radians(_c(lon0))
    dx = -F.sin(lo) * e - F.sin(la) * F.cos(lo) * n + F.cos(la) * F.cos(lo) * u
    dy = F.cos(lo) * e - F.sin(la) * F.sin(lo) * n + F.cos(la) * F.sin(lo) * u
    dz = F.cos(la) * n + F.sin(la) * u
    x0, y0, z0 = map(_c, origin_xyz)
    return dx + x0, dy + y0, dz + z0


def geodetic_to_enu(llh: tuple[Value, Value, Value], origin_llh: tuple[Value, Value, Value]) -> Triple:
    return ecef_to_enu(geodetic_to_ecef(*llh), geodetic_to_ecef(*origin_llh), origin_llh[0], origin_llh[1])


def add_offset(xyz: tuple[Value, Value, Value], forward: Value, right: Value, down: Value) -> Triple:
    """Antenna coordinates plus the antenna-to-transducer offset, axis by axis."""
    x, y, z = xyz
    return _c(x) + _c(forward), _c(y) + _c(right), _c(z) + _c(down)

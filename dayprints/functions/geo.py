"""Geometry columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayprints.functions.time import _col

# Earth radii used by the indicators, home radius.
EARTH_KM_HOME = 6373.0
EARTH_KM_EPS = 6371.0
HOME_KM = 0.5
MERCATOR_SHIFT_M = math.pi * 6378137


def home_distance_km(lat: Column | str, lon: Column | str) -> Column:
    """Great-circle km to the origin; coordinates are centred on the user's home."""
    lat, lon = F.radians(_col(lat)), F.radians(_col(lon))
    h = F.pow(F.sin(lat / 2), 2) + F.cos(lat) * F.pow(F.sin(lon / 2), 2)
    return F.lit(2 * EARTH_KM_HOME) * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def at_home(lat: Column | str, lon: Column | str) -> Column:
    return F.when(home_distance_km(lat, lon) <= HOME_KM, 1).otherwise(0)


def rotate_translate(x: Column | str, y: Column | str, degrees: float = 199.0,
                     dx: float = -3.77, dy: float = 40.332) -> tuple[Column, Column]:
    """Rotate by an angle, then shift."""
    x, y = _col(x), _col(y)
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return x * c - y * s + dx, x * s + y * c + dy


def to_mercator(lat: Column | str, lon: Column | str) -> tuple[Column, Column]:
    """Spherical Mercator metres of a WGS84 position."""
    north = F.log(F.tan((_col(lat) + 90) * (math.pi / 360))) * (MERCATOR_SHIFT_M / math.pi)
    return _col(lon) * (MERCATOR_SHIFT_M / 180), north


def from_mercator(x: Column | str, y: Column | str) -> tuple[Column, Column]:
    """Latitude and longitude of spherical Mercator metres."""
    lat = F.degrees(2 * F.atan(F.exp(_col(y) * (math.pi / MERCATOR_SHIFT_M))) - math.pi / 2)
    return lat, _col(x) * (180 / MERCATOR_SHIFT_M)


def km_to_eps(km: Column | str | float) -> Column:
    """Kilometres as an angle in radians on the sphere."""
    km = F.lit(km) if isinstance(km, (int, float)) else _col(km)
    return km / EARTH_KM_EPS


def decay(lam: float, steps: Column | str) -> Column:
    """Weight left after ``steps`` samples: 2^(-lam * steps)."""
    return F.pow(F.lit(2.0), _col(steps) * -lam)


def euclid(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)

"""Distances on the sphere, and on the ellipsoid as a correction of it."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius, WGS 84 equatorial radius and flattening.
EARTH_RADIUS_M = 6371008.7714
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Half of the central angle in radians, all inputs in radians."""
    dlat = F.sin((lat2 - lat1) / 2)
    dlon = F.sin((lon2 - lon1) / 2)
    h = dlat * dlat + F.cos(lat1) * F.cos(lat2) * dlon * dlon
    return F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between points in degrees."""
    angle = _half_chord(F.radians(lat1), F.radians(lon1), F.radians(lat2), F.radians(lon2))
    return F.lit(2 * EARTH_RADIUS_M) * angle


def ellipsoidal_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in metres on WGS 84 by Lambert's formula for long lines."""
    b1 = F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(lat1)))
    b2 = F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(lat2)))
    half = _half_chord(b1, F.radians(lon1), b2, F.radians(lon2))
    angle = half * 2
    p, q = (b1 + b2) / 2, (b2 - b1) / 2
    cos_half, sin_half = F.cos(half), F.sin(half)
    x = (angle - F.sin(angle)) * F.pow(F.sin(p) * F.cos(q) / cos_half, F.lit(2))
    y = (angle + F.sin(angle)) * F.pow(F.cos(p) * F.sin(q) / sin_half, F.lit(2))
    return F.when(half == 0, F.lit(0.0)).otherwise(
        F.lit(WGS84_A) * (angle - F.lit(WGS84_F / 2) * (x + y))
    )


def degrees_for(metres: float) -> float:
    """Degrees of latitude that span a distance."""
    return math.degrees(metres / EARTH_RADIUS_M)

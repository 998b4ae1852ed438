"""Distances on the sphere and a grid for near-neighbour joins."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_METERS = 6_371_000


def great_circle_meters(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Haversine distance in meters; null when any coordinate is null."""
    dlat = F.pow(F.sin((F.radians(lat_a) - F.radians(lat_b)) / 2), F.lit(2.0))
    dlon = F.pow(F.sin((F.radians(lon_a) - F.radians(lon_b)) / 2), F.lit(2.0))
    h = dlat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * dlon
    # rounding can lift antipodal points just above 1, where asin gives NaN
    return 2 * EARTH_RADIUS_METERS * F.nanvl(F.asin(F.sqrt(h)), F.lit(pi / 2))


def sphere_cell(lat: Column, lon: Column, size_meters: float) -> list[Column]:
    """Cell numbers of a point on a 3-d grid of ``size_meters`` cubes.

    A chord is never longer than its arc, so two points less than
    ``size_meters`` apart differ by at most one in each number. This holds at
    the poles and across the antimeridian too.
    """
    scaled = EARTH_RADIUS_METERS / size_meters
    phi, lam = F.radians(lat), F.radians(lon)
    return [
        F.floor(F.cos(phi) * F.cos(lam) * scaled),
        F.floor(F.cos(phi) * F.sin(lam) * scaled),
        F.floor(F.sin(phi) * scaled),
    ]

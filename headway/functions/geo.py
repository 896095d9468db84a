"""Distances on the globe as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The earth radius and walking speed the results depend on.
EARTH_RADIUS_M = 6_372_800.0
WALKING_SPEED_MPS = 1.4

METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180.0


def haversine_m(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = (
        half_lat * half_lat
        + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    )
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_M)

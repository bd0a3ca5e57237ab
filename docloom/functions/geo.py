"""Distance between points given in degrees."""

from __future__ import annotations

from math import cos, degrees, radians

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean radius of the earth in each unit.
EARTH_RADIUS = {"km": 6371.0, "miles": 3958.8}


def distance(lat: Column, lng: Column, to_lat: float, to_lng: float, unit: str = "km", calc: str = "arc") -> Column:
    """``arc`` is the great-circle (haversine) distance, ``plane`` treats the area as flat."""
    radius = F.lit(EARTH_RADIUS[unit])
    d_lat = F.radians(lat - F.lit(float(to_lat)))
    turn = lng - F.lit(float(to_lng))
    # The short way round the globe.
    turn = F.when(turn > 180, turn - 360).when(turn < -180, turn + 360).otherwise(turn)
    d_lng = F.radians(turn)
    if calc == "plane":
        x = d_lng * F.cos(F.radians((lat + F.lit(float(to_lat))) / 2))
        return radius * F.sqrt(x * x + d_lat * d_lat)
    if calc != "arc":
        raise ValueError(f"calc is 'arc' or 'plane', not {calc!r}")
    a = F.pow(F.sin(d_lat / 2), F.lit(2.0)) + F.cos(F.radians(lat)) * F.lit(cos(radians(to_lat))) * F.pow(
        F.sin(d_lng / 2), F.lit(2.0)
    )
    return radius * 2 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def within(
    lat: Column, lng: Column, to_lat: float, to_lng: float, radius: float, unit: str = "km", calc: str = "arc"
) -> Column:
    """Whether a point is within ``radius``. A plain latitude test comes first, which a scan can use."""
    reach = degrees(radius / EARTH_RADIUS[unit]) * 1.000001
    band = (lat >= F.lit(to_lat - reach)) & (lat <= F.lit(to_lat + reach))
    return band & (distance(lat, lng, to_lat, to_lng, unit, calc) <= F.lit(float(radius)))

"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_KM = 6371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; the root's argument is held in [0, 1] against rounding."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((p1 - p2) / 2)
    half_lon = F.sin((F.radians(lon1) - F.radians(lon2)) / 2)
    a = half_lat * half_lat + F.cos(p2) * F.cos(p1) * half_lon * half_lon
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))

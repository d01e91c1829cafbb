"""Distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METERS_PER_DEGREE = 111_320


def displacement_meters(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance at the middle latitude; NULL where any part is NULL."""
    middle = F.radians((lat1 + lat2) / 2)
    return F.sqrt(F.pow((lat2 - lat1) * METERS_PER_DEGREE, 2) + F.pow((lon2 - lon1) * METERS_PER_DEGREE * F.cos(middle), 2))

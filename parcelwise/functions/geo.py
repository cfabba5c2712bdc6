"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """NULL when any coordinate is missing."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lng = F.sin(F.radians(lng_b - lng_a) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lng * half_lng
    known = lat_a.isNotNull() & lng_a.isNotNull() & lat_b.isNotNull() & lng_b.isNotNull()
    # least() skips NULLs, hence the guard; 1.0 caps rounding noise for antipodes
    return F.when(known, 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(chord, F.lit(1.0)))))

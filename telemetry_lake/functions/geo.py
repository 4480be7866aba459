"""Grid cells, great-circle distance, bearing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_lake.functions.numeric import round_to

EARTH_RADIUS_KM = 6371.0
# fixed values: where a pair of numbers is taken as (lat, lon) around Cairo
LAT_SPAN = (28.0, 32.0)
LON_SPAN = (29.0, 34.0)
NUMBER_PATTERN = r"([-+]?\d*\.\d+|\d+)"


def grid(degrees: str) -> str:
    """Two-decimal grid line, about 1.1 km; SQL text in and out."""
    return round_to(degrees, 2)


def segment_key(lat: str, lon: str) -> str:
    """Grid cell name ``<lat>_<lon>``."""
    return f"concat(CAST({grid(lat)} AS STRING), '_', CAST({grid(lon)} AS STRING))"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def heading_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Plane bearing in [0, 360): 0 north, 90 east."""
    return F.pmod(F.degrees(F.atan2(lon2 - lon1, lat2 - lat1)), F.lit(360.0))


def parse_segment_coords(segment: Column) -> Column:
    """struct(lat, lon) read from a segment name; swapped pairs are put right, others are NULL."""
    numbers = F.regexp_extract_all(segment, F.lit(NUMBER_PATTERN), F.lit(1))
    first = F.get(numbers, F.lit(0)).try_cast("double")
    second = F.get(numbers, F.lit(1)).try_cast("double")
    straight = first.between(*LAT_SPAN) & second.between(*LON_SPAN)
    swapped = second.between(*LAT_SPAN) & first.between(*LON_SPAN)
    lat = F.when(straight, first).when(swapped, second)
    lon = F.when(straight, second).when(swapped, first)
    return F.struct(lat.alias("lat"), lon.alias("lon"))

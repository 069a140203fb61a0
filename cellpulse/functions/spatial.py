"""Grid arithmetic on degrees."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cell_index(value: Column, origin: Column, size: float) -> Column:
    return F.floor((value - origin) / F.lit(float(size))).cast("int")


def cell_center(index: Column, origin: Column, size: float) -> Column:
    return origin + (index + F.lit(0.5)) * F.lit(float(size))


def cell_name(lat_index: Column, lon_index: Column) -> Column:
    return F.concat_ws("_", lat_index.cast("string"), lon_index.cast("string"))


def degree_distance(lat: Column, lon: Column, center_lat: Column, center_lon: Column) -> Column:
    dlat, dlon = lat - center_lat, lon - center_lon
    return F.sqrt(dlat * dlat + dlon * dlon)

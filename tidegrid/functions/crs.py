"""Coordinate reference systems of tables: a stamp on the coordinate columns, and the way to degrees.

Grids are in degrees (WGS 84). Points in spherical Mercator metres are converted in closed form; other
systems need a projection library and are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEGREES = "EPSG:4326"
MERCATOR = "EPSG:3857"
RADIUS_M = 6378137.0


def crs_of(df: DataFrame, lon: str = "lon") -> str | None:
    return df.schema[lon].metadata.get("crs")


def stamped(df: DataFrame, crs: str = DEGREES, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The system noted on both columns; values stay."""
    for c in (lon, lat):
        df = df.withMetadata(c, {**df.schema[c].metadata, "crs": crs})
    return df


def ensure_crs(df: DataFrame, crs: str) -> DataFrame:
    """Stamped with a system if it has none or another one; never reprojected."""
    return df if crs_of(df) == crs else stamped(df, crs)


def to_degrees(df: DataFrame, crs: str | None = None, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Coordinates in degrees, from the system named or stamped; without either they are degrees."""
    crs = crs or crs_of(df, lon) or DEGREES
    if crs == MERCATOR:
        y = F.degrees(2 * F.atan(F.exp(F.col(lat) / RADIUS_M)) - F.lit(90.0) * F.radians(F.lit(1.0)))
        df = df.withColumn(lat, y).withColumn(lon, F.degrees(F.col(lon) / RADIUS_M))
    elif crs != DEGREES:
        raise ValueError(f"no way from {crs} to degrees")
    return stamped(df, DEGREES, lon, lat)

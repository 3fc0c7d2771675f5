"""Units, directions, distances and the moon, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
EARTH_M = 6_371_000.0
OMEGA = 7.2921159e-5
SEA_DENSITY = 1025.0


def kelvin_to_celsius(v: Column) -> Column:
    return v - 273.15


def pascal_to_hectopascal(v: Column) -> Column:
    return v * 0.01


def metre_to_millimetre(v: Column) -> Column:
    return v * 1000.0


def speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def kinetic_energy(u: Column, v: Column) -> Column:
    return (u * u + v * v) * 0.5


def components(direction: Column) -> tuple[Column, Column]:
    """cos and sin of a direction in degrees."""
    return F.cos(F.radians(direction)), F.sin(F.radians(direction))


def wrap_longitude(lon: Column) -> Column:
    """0 .. 360 to -180 .. 180."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def angular_distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Euclidean distance in degrees as an arc; meridians are not narrowed towards the poles."""
    return F.sqrt(F.pow(F.radians(lat1) - F.radians(lat2), 2) + F.pow(F.radians(lon1) - F.radians(lon2), 2)) * EARTH_KM


def unit_sphere(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    p, l = F.radians(lat), F.radians(lon)
    return F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)


def coriolis(lat: Column) -> Column:
    return 2 * OMEGA * F.sin(F.radians(lat))


def moon_illumination(time: Column) -> Column:
    """Lit share of the moon's disc in percent at 0h UTC, from the mean elongation (Meeus, Astronomical Algorithms, ch. 48)."""
    # days and Julian centuries since 2000-01-01 12h
    t = (F.datediff(F.to_date(time), F.lit("2000-01-01").cast("date")) - 0.5) / 36525.0
    d = F.radians(297.8501921 + 445267.1114034 * t)
    m = F.radians(357.5291092 + 35999.0502909 * t)
    a = F.radians(134.9633964 + 477198.8675055 * t)
    deg = math.pi / 180
    phase = (
        math.pi - d - 6.289 * deg * F.sin(a) + 2.100 * deg * F.sin(m) - 1.274 * deg * F.sin(2 * d - a)
        - 0.658 * deg * F.sin(2 * d) - 0.214 * deg * F.sin(2 * a) - 0.110 * deg * F.sin(d)
    )
    return (1 + F.cos(phase)) * 50.0


def missing_to_null(v: Column) -> Column:
    """NaN is a missing value in files; in tables it is null."""
    return F.when(~F.isnan(v), v)

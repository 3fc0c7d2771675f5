"""Eddies: trajectory observations to a daily grid of distances and attributes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.model import BBox, DateRange
from tidegrid.operators.fronts import _BLOCK, nearest_km
from tidegrid.operators.join import prefer_first

PREFIXES = {"anticyclonic": "ac", "cyclonic": "c"}
_ATTRIBUTES = ("track", "speedrad_km", "amp", "speed", "ndays")


def prepared(obs: DataFrame, bbox: BBox, dates: DateRange, margin: float = 10.0) -> DataFrame:
    """Observations on days, longitudes less 360, in the dates and the box with a margin."""
    out = obs.withColumn("time", F.to_date("time")).withColumnsRenamed({"longitude": "lon", "latitude": "lat"}).withColumn("lon", F.col("lon") - 360.0)
    return out.filter(bbox.padded(margin).predicate()).filter(dates.predicate())


def merged_sources(rep: DataFrame, nrt: DataFrame, kind: str = "kind") -> DataFrame:
    """Reprocessed observations, then near-real-time ones after the last day of their kind."""
    return prefer_first(rep, nrt, [kind])


def _xyz(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    p, l = np.radians(lat), np.radians(lon)
    return np.column_stack((np.cos(p) * np.cos(l), np.cos(p) * np.sin(l), np.sin(p)))


def nearest_index(lat: np.ndarray, lon: np.ndarray, to_lat: np.ndarray, to_lon: np.ndarray) -> np.ndarray:
    """Nearest of many points along the sphere, in blocks of bounded size."""
    a, b = _xyz(lat, lon), _xyz(to_lat, to_lon)
    step = max(1, _BLOCK // len(b))
    return np.concatenate([(a[i : i + step] @ b.T).argmax(axis=1) for i in range(0, len(a), step)])


def _grid_day(cells: pd.DataFrame, obs: pd.DataFrame) -> pd.DataFrame:
    if len(cells) == 0 or len(obs) == 0:
        return pd.DataFrame({c: pd.Series(dtype=object if c == "time" else float) for c in ("time", "lat", "lon", "dist", "normdist", *_ATTRIBUTES)})
    obs = obs.sort_values(["track", "observation_number"], kind="stable")
    lat, lon = cells["lat"].to_numpy(float), cells["lon"].to_numpy(float)
    at, on = obs["lat"].to_numpy(float), obs["lon"].to_numpy(float)
    km = nearest_km(lat, lon, at, on)  # the distance is flat,
    near = obs.iloc[nearest_index(lat, lon, at, on)].reset_index(drop=True)  # the attributes are those of the nearest on the sphere
    return pd.DataFrame(
        {
            "time": near["time"], "lat": lat, "lon": lon, "dist": km, "normdist": km / (near["effective_radius"] * 0.001), "track": near["track"].astype(float),
            "speedrad_km": near["speed_radius"] * 0.001, "amp": near["amplitude"], "speed": near["speed_average"], "ndays": near["observation_number"].astype(float),
        }
    )


def daily_grid(obs: DataFrame, grid: DataFrame, prefix: str) -> DataFrame:
    """For each day with eddies and each cell: distance to the nearest eddy, over its radius too, and its attributes.

    A day's cells are split over tasks by latitude; each task has that day's eddies, some hundreds.
    """
    per_task = 16
    days = obs.select("time").distinct()
    bands = F.pmod(F.xxhash64("lat"), F.lit(per_task)).alias("band")
    cells = days.crossJoin(grid.select("lat", "lon")).select(F.col("time").alias("day"), "lat", "lon", bands)
    spread = obs.withColumn("band", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(per_task - 1).cast("long"))))
    schema = "time date, lat double, lon double, dist double, normdist double, " + ", ".join(f"{a} double" for a in _ATTRIBUTES)
    out = cells.groupBy("day", "band").cogroup(spread.groupBy("time", "band")).applyInPandas(_grid_day, schema)
    return out.withColumnsRenamed({c: f"{prefix}_{c}" for c in ("dist", "normdist", *_ATTRIBUTES)})


def both_kinds(obs: DataFrame, grid: DataFrame, kind: str = "kind") -> DataFrame:
    """Grids of anticyclonic and cyclonic eddies side by side."""
    a, c = (daily_grid(obs.filter(F.col(kind) == k), grid, p) for k, p in PREFIXES.items())
    return a.join(c, ["time", "lat", "lon"], "full")

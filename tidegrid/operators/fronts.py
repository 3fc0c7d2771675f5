"""Fronts in images, and distances to them.

A day's field is one group: Belkin-O'Reilly filtering needs 5 x 5 neighbourhoods of 3 x 3 results,
so it runs on arrays. Each day is one task; days are independent.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLDS = {"sst": 0.4, "chl": 0.06}
_BLOCK = 1 << 22


def _windows(field: np.ndarray, size: int) -> np.ndarray:
    """Neighbourhoods of every inner cell, flattened to the last axis."""
    view = np.lib.stride_tricks.sliding_window_view(field, (size, size))
    return view.reshape(*view.shape[:2], size * size)


def extrema(field: np.ndarray, size: int) -> np.ndarray:
    """Cells that are the largest or smallest of their neighbourhood, alone or with others; none at the border."""
    out = np.zeros(field.shape, bool)
    r = size // 2
    if min(field.shape) < size:
        return out
    w = _windows(field, size)
    centre = field[r:-r, r:-r]
    out[r:-r, r:-r] = (centre == w.max(axis=-1)) | (centre == w.min(axis=-1))
    return out


def smoothed(field: np.ndarray) -> np.ndarray:
    """The median of the 3 x 3 neighbourhood at its extrema, unless they are also extrema of 5 x 5."""
    spikes = extrema(field, 3) & ~extrema(field, 5)
    if not spikes.any():
        return field
    out = field.copy()
    inner = spikes[1:-1, 1:-1]
    out[1:-1, 1:-1][inner] = np.median(_windows(field, 3)[inner], axis=-1)
    return out


def gradient(field: np.ndarray) -> np.ndarray:
    """Sobel magnitude (in units of the field a cell), the border mirrored."""
    p = np.pad(field, 1, mode="symmetric")
    rows = p[:-2] + 2 * p[1:-1] + p[2:]
    columns = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return np.hypot(rows[:, 2:] - rows[:, :-2], columns[2:] - columns[:-2])


def front_mask(field: np.ndarray, threshold: float) -> np.ndarray:
    """Cells of steep change. Missing values count as 0, so coasts are fronts too."""
    return gradient(smoothed(np.nan_to_num(field, nan=0.0))) >= threshold


def nearest_km(lat: np.ndarray, lon: np.ndarray, to_lat: np.ndarray, to_lon: np.ndarray) -> np.ndarray:
    """Distance in degrees, as an arc, to the nearest of many points; in blocks of bounded size."""
    if len(to_lat) == 0:
        return np.full(len(lat), np.nan)
    a = np.radians(np.column_stack((lat, lon)))
    b = np.radians(np.column_stack((to_lat, to_lon)))
    step = max(1, _BLOCK // len(b))
    best = [np.sqrt(((a[i : i + step, None] - b[None]) ** 2).sum(-1).min(axis=1)) for i in range(0, len(a), step)]
    return np.concatenate(best) * 6371.0


def nearest_on_grid(marked: np.ndarray, lats: np.ndarray, lons: np.ndarray) -> np.ndarray:
    """nearest_km from every cell of a grid to its marked cells, without pairs of cells.

    The nearest marked cell of each column is found by a scan along it; the rest is a search over the
    columns that have one, so the work is cells x columns, however many cells are marked.
    """
    some = np.flatnonzero(marked.any(axis=0))
    if len(some) == 0:
        return np.full(marked.shape, np.nan)
    la, lo, n = np.radians(lats), np.radians(lons), len(lats)
    at, held = np.arange(n)[:, None], marked[:, some]
    before = np.maximum.accumulate(np.where(held, at, -1), axis=0)
    after = np.minimum.accumulate(np.where(held, at, n)[::-1], axis=0)[::-1]
    down = np.where(before >= 0, la[:, None] - la[before], np.inf)
    up = np.where(after < n, la[np.minimum(after, n - 1)] - la[:, None], np.inf)
    along = np.minimum(down, up) ** 2
    out = np.empty(marked.shape)
    step = max(1, _BLOCK // len(some))
    for k in range(0, len(lons), step):
        across = (lo[k : k + step, None] - lo[None, some]) ** 2
        for i in range(n):
            out[i, k : k + step] = np.sqrt((across + along[i]).min(axis=1))
    return out * 6371.0


def _on_axes(pdf: pd.DataFrame, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lats, i = np.unique(pdf["lat"].to_numpy(), return_inverse=True)
    lons, j = np.unique(pdf["lon"].to_numpy(), return_inverse=True)
    field = np.full((len(lats), len(lons)), np.nan)
    field[i, j] = pdf[column].to_numpy(dtype=float)
    return field, lats, lons, i, j


def _day(pdf: pd.DataFrame, variable: str, threshold: float, distance: str) -> pd.DataFrame:
    field, lats, lons, i, j = _on_axes(pdf, variable)
    mask = front_mask(field, threshold)
    km = nearest_on_grid(mask, lats, lons)
    out = pdf[["time", "lat", "lon"]].copy()
    out["is_front"] = mask[i, j]
    out[distance] = pd.Series(np.where(pdf["sea"], km[i, j], np.nan), index=out.index)
    return out


def _marked_day(pdf: pd.DataFrame) -> pd.DataFrame:
    field, lats, lons, i, j = _on_axes(pdf, "marked")
    return pdf[["time", "lat", "lon"]].assign(km=nearest_on_grid(field == 1, lats, lons)[i, j])


def marked_distance(df: DataFrame, marked: Column) -> DataFrame:
    """time, lat, lon and km: from every cell to the nearest marked cell of its time; null where none is marked."""
    picked = df.select("time", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.coalesce(marked, F.lit(False)).cast("int").alias("marked"))
    out = picked.groupBy("time").applyInPandas(_marked_day, f"time {dict(df.dtypes)['time']}, lat double, lon double, km double")
    return out.withColumn("km", F.when(~F.isnan("km"), F.col("km")))


def front_distance(df: DataFrame, variable: str = "sst", threshold: float | None = None, sea: DataFrame | None = None) -> DataFrame:
    """time, lat, lon, is_front and `variable`_fdist: kilometres from every sea cell to the time's nearest front.

    sea: the (lat, lon) of cells in the sea; without it cells with a value are. Land has no distance.
    """
    if variable not in THRESHOLDS and threshold is None:
        raise ValueError(f"no threshold for {variable}; there are {', '.join(THRESHOLDS)}")
    limit = THRESHOLDS[variable] if threshold is None else threshold
    name = f"{variable}_fdist"
    kinds = dict(df.dtypes)
    schema = f"time {kinds['time']}, lat double, lon double, is_front boolean, {name} double"
    value = F.col(variable).cast("double")
    picked = df.select("time", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), value.alias(variable))
    if sea is None:
        picked = picked.withColumn("sea", F.col(variable).isNotNull() & ~F.isnan(variable))
    else:
        cells = sea.select(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.lit(True).alias("sea")).distinct()
        picked = picked.join(cells, ["lat", "lon"], "left").withColumn("sea", F.coalesce("sea", F.lit(False)))
    out = picked.groupBy("time").applyInPandas(lambda pdf: _day(pdf, variable, limit, name), schema)
    return out.withColumn(name, F.when(~F.isnan(name), F.col(name)))


def with_front_distance(df: DataFrame, variable: str, threshold: float | None = None, keys: Sequence[str] = ("time", "lat", "lon"), sea: DataFrame | None = None) -> DataFrame:
    found = front_distance(df, variable, threshold, sea).drop("is_front")
    return df.withColumn("lat", F.col("lat").cast("double")).withColumn("lon", F.col("lon").cast("double")).join(found, list(keys), "left")

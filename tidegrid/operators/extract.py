"""Extraction of cube values for points and polygons."""

from __future__ import annotations

import logging
import struct
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.physics import moon_illumination
from tidegrid.model import BBox, DateRange, require_columns
from tidegrid.operators.grid import nearest_node
from tidegrid.operators.join import merge_back, nearest_cell

log = logging.getLogger(__name__)


def within_extent(points: DataFrame, dates: DateRange, bbox: BBox | None) -> DataFrame:
    """Points of the cube's days and box, both closed."""
    inside = dates.predicate()
    return points.filter(inside & bbox.predicate() if bbox else inside)


def clamped(points: DataFrame, available: DateRange) -> DateRange | None:
    """The points' days that are available; logged if that is not all."""
    wanted = DateRange.of(points.withColumn("time", F.to_date("time")))
    both = wanted.intersection(available)
    if both != wanted:
        log.warning("of %s only %s is available", wanted.label(), both.label() if both else "nothing")
    return both


def extract_points(points: DataFrame, cube: DataFrame, variables: Sequence[str], key: str = "row_id", bbox: BBox | None = None) -> DataFrame:
    """All points with the variables of the nearest cell and step; those outside the cube's days or box have nulls."""
    require_columns(points, [key, "time", "lat", "lon"], "points")
    require_columns(cube, variables, "cube")
    some = within_extent(points, DateRange.of(cube.withColumn("time", F.to_date("time"))), bbox or BBox.of(cube))
    return merge_back(points, nearest_cell(some, cube, variables).select(key, *variables), key)


def extract_static(points: DataFrame, layer: DataFrame, variables: Sequence[str], key: str = "row_id") -> DataFrame:
    """Values of a layer without time, such as a sea floor."""
    out = points.withColumn("__lat", F.col("lat").cast("double")).withColumn("__lon", F.col("lon").cast("double"))
    for a in ("lat", "lon"):
        found = nearest_node(layer.select(F.col(a).cast("double").alias(a)), out.select(F.col(f"__{a}").alias(a)), a)
        out = out.join(found.select(F.col("x").alias(f"__{a}"), F.col("node").alias(f"__n_{a}")), f"__{a}", "left")
    grid = layer.select(F.col("lat").cast("double").alias("__n_lat"), F.col("lon").cast("double").alias("__n_lon"), *variables)
    return merge_back(points, out.join(grid, ["__n_lat", "__n_lon"], "left").select(key, *variables), key)


def extract_moon(points: DataFrame, name: str = "moon") -> DataFrame:
    return points.withColumn(name, moon_illumination(F.col("time")))


# -- polygons ------------------------------------------------------------------------------------

Ring = list[tuple[float, float]]


def wkb_polygons(data: bytes) -> list[list[Ring]]:
    """Rings of the polygons of a WKB Polygon or MultiPolygon."""

    def one(at: int) -> tuple[list[list[Ring]], int]:
        order = "<" if data[at] == 1 else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        if kind & 0x20000000:  # an SRID comes first
            at += 4
            kind &= 0x1FFFFFFF
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == 6:
            out = []
            for _ in range(n):
                part, at = one(at)
                out += part
            return out, at
        if kind != 3:
            raise ValueError(f"not a polygon: WKB type {kind}")
        rings = []
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", data, at)
            flat = struct.unpack_from(f"{order}{2 * m}d", data, at + 4)
            rings.append(list(zip(flat[::2], flat[1::2], strict=True)))
            at += 4 + 16 * m
        return [rings], at

    return one(0)[0]


def box_wkb(xmin: float, ymin: float, xmax: float, ymax: float) -> bytes:
    ring = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return struct.pack("<BII", 1, 3, 1) + struct.pack("<I", len(ring)) + b"".join(struct.pack("<2d", *p) for p in ring)


def _inside(x: float, y: float, rings: list[Ring]) -> bool:
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def _crosses(p: tuple[float, float], q: tuple[float, float], box: tuple[float, float, float, float]) -> bool:
    """Whether a segment meets a closed box (Liang-Barsky)."""
    t0, t1 = 0.0, 1.0
    dx, dy = q[0] - p[0], q[1] - p[1]
    for d, low, high, at in ((dx, box[0], box[2], p[0]), (dy, box[1], box[3], p[1])):
        if d == 0:
            if not low <= at <= high:
                return False
            continue
        a, b = sorted(((low - at) / d, (high - at) / d))
        t0, t1 = max(t0, a), min(t1, b)
        if t0 > t1:
            return False
    return True


def touches(rings: list[Ring], box: tuple[float, float, float, float]) -> bool:
    """Whether a polygon and a closed box have a point in common."""
    if any(_crosses(p, q, box) for ring in rings for p, q in zip(ring, ring[1:], strict=False)):
        return True
    return _inside(box[0], box[1], rings) or (box[0] <= rings[0][0][0] <= box[2] and box[1] <= rings[0][0][1] <= box[3])


def extract_polygons(shapes: DataFrame, cube: DataFrame, variables: Sequence[str], dx: float, dy: float | None = None, key: str = "row_id", std: bool = False, time: str | None = "time", origin: tuple[float, float] | None = None) -> DataFrame:
    """Each polygon (WKB column geometry) with the means of the cells of its day that it touches; std adds deviations.

    The boxes of polygons are cut to rows of cells: an equi-join on day and cell follows, so no task
    sees more than the cells a polygon's box covers. origin is the centre (lat, lon) of any cell;
    without it the least coordinates of the cube are.
    """
    dy = dx if dy is None else dy
    if origin is None:
        origin = cube.agg(F.min("lat").cast("double"), F.min("lon").cast("double")).first()
    y0, x0 = (v or 0.0 for v in origin)
    by = [time] if time else []

    def cells(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out: list[tuple] = []
            for k, data in zip(pdf[key], pdf["geometry"], strict=True):
                found = set()
                for rings in wkb_polygons(bytes(data)):
                    rings = [[(x - x0, y - y0) for x, y in ring] for ring in rings]  # cell (0, 0) is centred on (0, 0)
                    xs, ys = [p[0] for p in rings[0]], [p[1] for p in rings[0]]
                    for i in range(int((min(ys) - dy / 2) // dy), int((max(ys) + dy / 2) // dy) + 2):
                        for j in range(int((min(xs) - dx / 2) // dx), int((max(xs) + dx / 2) // dx) + 2):
                            if (i, j) not in found and touches(rings, ((j - 0.5) * dx, (i - 0.5) * dy, (j + 0.5) * dx, (i + 0.5) * dy)):
                                found.add((i, j))
                out += [(k, i, j) for i, j in sorted(found)]
            yield pd.DataFrame(out, columns=[key, "__i", "__j"])

    kinds = dict(shapes.dtypes)
    touched = shapes.filter("geometry IS NOT NULL").select(key, "geometry").mapInPandas(cells, f"{key} {kinds[key]}, __i long, __j long")
    grid = cube.select(*[F.to_date(t).alias("__day") for t in by], F.round((F.col("lat") - y0) / dy).cast("long").alias("__i"), F.round((F.col("lon") - x0) / dx).cast("long").alias("__j"), *variables)
    wanted = touched.join(shapes.select(key, *[F.to_date(t).alias("__day") for t in by]), key)
    met = wanted.join(grid, ["__i", "__j", *["__day"] * len(by)])
    stats = [F.avg(v).alias(v) for v in variables] + ([F.stddev_pop(v).alias(f"{v}_std") for v in variables] if std else [])
    return merge_back(shapes, met.groupBy(key).agg(*stats), key)


def extract_keys(points: DataFrame, cubes: dict[str, tuple[DataFrame, Sequence[str]]], folder: str, key: str = "row_id") -> tuple[DataFrame, list[str]]:
    """Columns of several cubes for all points; returns the table and the keys that failed.

    Each key's columns are staged as Parquet when done, so a second call after a failure goes on where
    the first stopped; the stage is dropped when all are done.
    """
    spark = points.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    failed = []
    for name, (cube, variables) in cubes.items():
        if fs.exists(hadoop.Path(f"{folder}/{name}/_SUCCESS")):
            continue
        try:
            extract_points(points, cube, variables, key).select(key, *variables).write.mode("overwrite").parquet(f"{folder}/{name}")
        except Exception:  # the others go on
            log.exception("%s failed", name)
            failed.append(name)
    out = points
    for name in cubes:
        if name not in failed:
            out = merge_back(out, spark.read.parquet(f"{folder}/{name}"), key)
    if not failed:
        out = out.checkpoint()
        fs.delete(hadoop.Path(folder), True)
    return out, failed

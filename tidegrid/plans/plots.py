"""The data behind plots: series, summaries and maps. Drawing is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.time import season_code_date
from tidegrid.model import BBox
from tidegrid.operators.aggregate import aggregate_by_space_time, aggregate_by_time, aggregate_by_time_stats
from tidegrid.operators.grid import nearest_node


def at_point(df: DataFrame, lon: float, lat: float) -> DataFrame:
    """The rows of the cell nearest to a point."""
    out = df
    for name, value in (("lat", lat), ("lon", lon)):
        wanted = df.sparkSession.createDataFrame([(float(value),)], f"{name} double")
        node = nearest_node(df.select(F.col(name).cast("double").alias(name)), wanted, name)
        out = out.join(node.select(F.col("node").alias(name)), name, "left_semi")
    return out


def time_series(df: DataFrame, variables: Sequence[str], where: tuple | BBox | None = None, agg_by: str = "month") -> DataFrame:
    """One to four variables over a box (4 numbers) or at a point (2 numbers), with a date for each bucket."""
    if not 1 <= len(variables) <= 4:
        raise ValueError("one to four variables")
    if isinstance(where, tuple) and len(where) == 2:
        df = at_point(df, *where)
    elif where is not None:
        df = df.filter((where if isinstance(where, BBox) else BBox(*where)).predicate())
    out = aggregate_by_time(df, variables, agg_by)
    return out.withColumn("date", season_code_date(F.col("time_agg")) if agg_by == "season" else F.col("time_agg"))


def stats_summary(df: DataFrame, variable: str, agg_by: str = "month") -> DataFrame:
    return aggregate_by_time_stats(df, variable, agg_by)


def spatial_maps(df: DataFrame, variable: str, agg_by: str = "month") -> DataFrame:
    return aggregate_by_space_time(df, [variable], agg_by)


def lowess(x: Sequence[float], y: Sequence[float], share: float = 0.3) -> list[float]:
    """Locally weighted linear trend of an aggregated series; each fit uses the nearest share of points."""
    a, b = np.asarray(x, float), np.asarray(y, float)
    n = len(a)
    k = max(2, min(n, int(np.ceil(share * n))))
    out = []
    for at in a:
        far = np.abs(a - at)
        reach = np.sort(far)[k - 1] or 1.0
        w = np.clip(1 - (far / reach) ** 3, 0, 1) ** 3
        mx, my = np.average(a, weights=w), np.average(b, weights=w)
        spread = np.sum(w * (a - mx) ** 2)
        slope = np.sum(w * (a - mx) * (b - my)) / spread if spread > 0 else 0.0
        out.append(float(my + slope * (at - mx)))
    return out


def split_by_group(df: DataFrame, group: str, order: Sequence | None = None) -> dict[object, DataFrame]:
    """A frame for each value of a month or season column, in order."""
    values = list(order) if order is not None else [r[0] for r in df.select(group).distinct().orderBy(group).collect()]  # a dozen at most
    return {v: df.filter(F.col(group) == v) for v in values}


def points(df: DataFrame, geometry: str = "points") -> DataFrame:
    """One row for each point of an array column of (lon, lat)."""
    return df.withColumn("p", F.explode(geometry)).withColumns({"lon": F.col("p.lon"), "lat": F.col("p.lat")}).drop("p", geometry)


def export_map(df: DataFrame, path: str, overwrite: bool = False) -> bool:
    """The same rows laid out by time for maps, beside a store laid out for series; False if it is there already."""
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not overwrite and where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return False
    df.repartition("time").sortWithinPartitions("time", "lat", "lon").write.mode("overwrite").parquet(path)
    return True

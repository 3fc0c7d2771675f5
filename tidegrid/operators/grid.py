"""Grids: cell centres, snapping, regridding, blocks, neighbourhoods, depth levels, dense completion."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.model import BBox

#: Values of an axis that are sent to every task: 8 MB.
AXIS_NODES = 1_000_000


def centres(spark: SparkSession, low: float, high: float, step: float, name: str) -> DataFrame:
    """Cell centres from low + step / 2 below high, by integer index, so that rounding doesn't add up."""
    n = math.ceil((high - low) / step - 1e-9)
    return spark.range(max(0, n)).select((F.col("id") * step + (low + step / 2)).alias(name))


def generate_grid(spark: SparkSession, bbox: BBox, dx: float, dy: float | None = None) -> DataFrame:
    """All cells (lat, lon) of a box."""
    lats, lons = centres(spark, bbox.ymin, bbox.ymax, dy or dx, "lat"), centres(spark, bbox.xmin, bbox.xmax, dx, "lon")
    return lats.crossJoin(F.broadcast(lons))  # both axes are a few thousand numbers, and the grid is what is asked for


def snap(df: DataFrame, axes: Sequence[str] = ("lat", "lon"), places: int = 4) -> DataFrame:
    """Coordinates rounded half to even, on axes where that merges no two of them."""
    counts = df.agg(*[F.struct(F.count_distinct(a), F.count_distinct(F.bround(a, places))).alias(a) for a in axes]).first()
    return df.withColumns({a: F.bround(a, places) for a in axes if counts[a][0] == counts[a][1]})


def _between(nodes: DataFrame, targets: DataFrame, name: str) -> DataFrame:
    """For each target x: the nodes lo <= x <= hi around it; null beyond the ends.

    An axis of at most AXIS_NODES values goes to the tasks, where each target is searched for in it, so
    targets may be as many as points. A longer one meets the targets in one ordered window.
    """
    axis = nodes.select(F.col(name).cast("double").alias("node")).filter("node IS NOT NULL").distinct()
    held = sorted(r[0] for r in axis.limit(AXIS_NODES + 1).collect())
    if len(held) <= AXIS_NODES:
        return _searched(np.array(held), targets.select(F.col(name).cast("double").alias("x")).filter("x IS NOT NULL"))
    points = nodes.select(F.col(name).alias("x"), F.col(name).alias("node"), F.lit(0).alias("target")).unionByName(
        targets.select(F.col(name).alias("x"), F.lit(None).cast("double").alias("node"), F.lit(1).alias("target"))
    )
    w = Window.partitionBy(F.lit(0)).orderBy("x")
    # the default frame holds all rows of the same x, so that a node at x is both lo and hi
    lo = F.last("node", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    hi = F.first("node", ignorenulls=True).over(w.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    return points.select("x", "target", lo.alias("lo"), hi.alias("hi")).filter("target = 1").drop("target")


def _searched(axis: np.ndarray, targets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False)
            lo, hi = np.searchsorted(axis, x, "right") - 1, np.searchsorted(axis, x, "left")
            ends = [(axis[np.clip(k, 0, len(axis) - 1)], out) if len(axis) else (np.zeros(len(x)), np.ones(len(x), bool)) for k, out in ((lo, lo < 0), (hi, hi >= len(axis)))]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(v, pa.float64(), mask=m) for v, m in ends]], names=["x", "lo", "hi"])

    return targets.mapInArrow(run, "x double, lo double, hi double")


def linear_weights(nodes: DataFrame, targets: DataFrame, name: str) -> DataFrame:
    """(node, x, w, n): the one or two nodes that a target is interpolated from. Targets outside the nodes have none."""
    b = _between(nodes, targets, name).filter("lo IS NOT NULL AND hi IS NOT NULL")
    share = (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    one = F.array(F.struct(F.col("lo").alias("node"), F.lit(1.0).alias("w")))
    two = F.array(F.struct(F.col("lo").alias("node"), (1 - share).alias("w")), F.struct(F.col("hi").alias("node"), share.alias("w")))
    parts = F.when(F.col("lo") == F.col("hi"), one).otherwise(two)
    return b.select("x", F.size(parts).alias("n"), F.explode(parts).alias("p")).select(F.col("p.node").alias("node"), "x", F.col("p.w").alias("w"), "n")


def regrid_linear(df: DataFrame, variables: Sequence[str], lats: DataFrame, lons: DataFrame, keys: Sequence[str] = ("time",)) -> DataFrame:
    """Bilinear interpolation to the axes lats (lat) and lons (lon).

    Every source cell is sent to the few target cells it is a corner of, by two joins with axis
    tables, and sums of weight times value meet in one shuffle with map-side combine. A target
    is null where a corner is missing; outside the source's hull it has no row.
    """
    sides = []
    for name, targets in (("lat", lats), ("lon", lons)):
        w = linear_weights(df.select(name).distinct(), targets, name)
        sides.append(w.select(F.col("node").alias(name), F.col("x").alias(f"t_{name}"), F.col("w").alias(f"w_{name}"), F.col("n").alias(f"n_{name}")))
    spread = df.select(*keys, "lat", "lon", *variables).join(sides[0], "lat").join(sides[1], "lon")
    weight = F.col("w_lat") * F.col("w_lon")
    sums = []
    for v in variables:
        sums += [F.sum(weight * F.col(v)).alias(v), F.count(v).alias(f"__n_{v}")]
    out = spread.groupBy(*keys, F.col("t_lat").alias("lat"), F.col("t_lon").alias("lon"), F.col("n_lat"), F.col("n_lon")).agg(*sums)
    return out.select(*keys, "lat", "lon", *[F.when(F.col(f"__n_{v}") == F.col("n_lat") * F.col("n_lon"), F.col(v)).alias(v) for v in variables])


def nearest_node(nodes: DataFrame, targets: DataFrame, name: str, tie_to_higher: bool = False) -> DataFrame:
    """(x, node): the node nearest to each distinct target; beyond the ends the end. Ties go to the lower node unless told."""
    b = _between(nodes.distinct(), targets.select(name).filter(F.col(name).isNotNull()).distinct(), name)
    up, down = F.col("hi") - F.col("x"), F.col("x") - F.col("lo")
    nearer = (up <= down) if tie_to_higher else (up < down)
    return b.select("x", F.when(F.col("lo").isNull() | nearer, F.coalesce("hi", "lo")).otherwise(F.col("lo")).alias("node"))


def coarsen(df: DataFrame, variables: Sequence[str], factor_lat: int, factor_lon: int, lat0: float, lon0: float, dlat: float, dlon: float, keys: Sequence[str] = ()) -> DataFrame:
    """Block means and population deviations over factor_lat x factor_lon cells; coordinates are the blocks' means."""
    if min(factor_lat, factor_lon) < 1:
        raise ValueError("factors must be positive")
    i = F.floor(F.round((F.col("lat") - lat0) / dlat) / factor_lat).alias("bi")
    j = F.floor(F.round((F.col("lon") - lon0) / dlon) / factor_lon).alias("bj")
    out = df.groupBy(*keys, i, j).agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), *[F.avg(v).alias(v) for v in variables], *[F.stddev_pop(v).alias(f"{v}_std") for v in variables]
    )
    return out.drop("bi", "bj")


def coarsen_factor(fine: float, coarse: float) -> int:
    """How many fine steps a coarse one has; it must be a whole number to within a thousandth."""
    n = round(coarse / fine)
    if n < 1 or abs(coarse / fine - n) > 1e-3 * n:
        raise ValueError(f"{coarse} is no multiple of {fine}")
    return n


def neighbourhood_std(df: DataFrame, variable: str, i: Column, j: Column, keys: Sequence[str] = ("time",), name: str | None = None) -> DataFrame:
    """Population deviation over each cell's 3 x 3 neighbourhood, cut off at edges, without missing values.

    i and j are the cell's integer indices. A cell is sent to its nine neighbours; partial sums are
    combined before the shuffle. Only cells that exist come back.
    """
    name = name or f"{variable}_std"
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    sent = df.select(*keys, i.cast("long").alias("__i"), j.cast("long").alias("__j"), "lat", "lon", F.col(variable).alias("__v"), F.explode(steps).alias("s"))
    own = (F.col("s.a") == 0) & (F.col("s.b") == 0)
    met = sent.groupBy(*keys, (F.col("__i") + F.col("s.a")).alias("__i"), (F.col("__j") + F.col("s.b")).alias("__j")).agg(
        F.max(F.when(own, F.col("lat"))).alias("lat"), F.max(F.when(own, F.col("lon"))).alias("lon"), F.max(F.when(own, F.col("__v"))).alias(variable), F.stddev_pop("__v").alias(name)
    )
    return met.filter(F.col("lat").isNotNull()).drop("__i", "__j")


def dense(df: DataFrame, variables: Sequence[str], time: str = "time") -> DataFrame:
    """Every (time, lat, lon) of the distinct coordinates; absent cells are null.

    The product of the axes is the result itself; axes are broadcast only as a grid's two short ones.
    """
    times, lats, lons = df.select(time).distinct(), df.select("lat").distinct(), df.select("lon").distinct()
    return times.crossJoin(lats.crossJoin(lons)).join(df.select(time, "lat", "lon", *variables), [time, "lat", "lon"], "left")


def depth_columns(df: DataFrame, variable: str, depths: Sequence[float], keys: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """A column `variable_depth` for each wanted depth, from the level nearest to it (the upper one on a tie)."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(float(d),) for d in depths], "depth double")
    levels = nearest_node(df.select(F.col("depth").cast("double")), wanted, "depth")
    picked = df.withColumn("depth", F.col("depth").cast("double")).join(levels.select(F.col("node").alias("depth"), F.col("x")), "depth")
    return picked.groupBy(*keys).pivot("x", [float(d) for d in depths]).agg(F.first(variable)).withColumnsRenamed({str(float(d)): f"{variable}_{d:g}" for d in depths})


def one_depth(df: DataFrame, depth: float) -> DataFrame:
    """The rows of the level nearest to a depth, without the depth column."""
    wanted = df.sparkSession.createDataFrame([(float(depth),)], "depth double")
    level = nearest_node(df.select(F.col("depth").cast("double")), wanted, "depth").select(F.col("node").alias("depth"))
    return df.withColumn("depth", F.col("depth").cast("double")).join(level, "depth", "left_semi").drop("depth")


def matrix(df: DataFrame, variable: str, rows: str = "lat", columns: str = "lon") -> DataFrame:
    """One row for each latitude, one column for each longitude."""
    names = [r[0] for r in df.select(columns).distinct().orderBy(columns).collect()]  # an axis
    return df.groupBy(rows).pivot(columns, names).agg(F.first(variable)).orderBy(rows)


def degenerate_axis(df: DataFrame, axis: str, least: float = 1e-6) -> bool:
    """Whether an axis has steps that are nothing beside its usual one."""
    steps = df.select(axis).distinct().withColumn("step", F.col(axis) - F.lag(axis).over(Window.partitionBy(F.lit(0)).orderBy(axis)))
    low, usual = steps.agg(F.min("step"), F.percentile("step", 0.5)).first()
    return bool(low is not None and usual and low / usual < least)


def on_grid(grid: DataFrame, per_day: DataFrame, time: str = "time") -> DataFrame:
    """A value a day, set on every cell. The result is as large as the product, which is what is asked for."""
    return per_day.crossJoin(grid.select("lat", "lon"))


def clip_land(df: DataFrame, sea: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Values on land are null, rows stay; sea: (lat, lon) of sea cells."""
    marked = df.join(sea.select("lat", "lon").distinct().withColumn("__sea", F.lit(True)), ["lat", "lon"], "left")
    return marked.withColumns({v: F.when(F.col("__sea"), F.col(v)) for v in variables}).drop("__sea")


def grid_step(df: DataFrame, axis: str) -> float:
    """Step between the first two values of an axis."""
    a = [r[0] for r in df.select(axis).distinct().orderBy(axis).limit(2).collect()]
    if len(a) < 2:
        raise ValueError(f"{axis} has no step")
    return abs(float(a[1]) - float(a[0]))

"""Compilation: variables of different grids on one grid, merged by coordinates, and the run over all keys."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.physics import moon_illumination
from tidegrid.model import DateRange, TimeResolution
from tidegrid.operators.grid import clip_land, depth_columns, on_grid, regrid_linear
from tidegrid.operators.join import outer_merge
from tidegrid.operators.ocean import non_negative
from tidegrid.sources.store import CubeStore

log = logging.getLogger(__name__)


@dataclass
class Target:
    """The compiled grid: axes, and optionally which cells are sea."""

    lats: DataFrame
    lons: DataFrame
    sea: DataFrame | None = None

    def cells(self) -> DataFrame:
        return self.lats.crossJoin(F.broadcast(self.lons))  # the axes of one grid


def default(df: DataFrame, target: Target, variables: Sequence[str]) -> DataFrame:
    return regrid_linear(df, variables, target.lats, target.lons)


def static(df: DataFrame, target: Target, variables: Sequence[str]) -> DataFrame:
    """A layer without time."""
    return regrid_linear(df, variables, target.lats, target.lons, keys=())


def depths(levels: Sequence[float]) -> Callable[[DataFrame, Target, Sequence[str]], DataFrame]:
    def run(df: DataFrame, target: Target, variables: Sequence[str]) -> DataFrame:
        (variable,) = variables
        wide = depth_columns(df, variable, levels)
        return default(wide, target, [c for c in wide.columns if c not in ("time", "lat", "lon")])

    return run


def named_depths(df: DataFrame, target: Target, variables: Sequence[str], levels: Sequence[float] | None = None) -> DataFrame:
    """A variable of levels, at those that its configuration names (Variable.levels)."""
    if not levels:
        raise ValueError(f"{', '.join(variables)}: no depths are configured")
    return depths(levels)(df, target, variables)


def moon(df: DataFrame, target: Target, variables: Sequence[str]) -> DataFrame:
    """The lit share on each day of df, on every sea cell."""
    days = df.select(F.to_date("time").alias("time")).distinct().withColumn("moon", moon_illumination(F.col("time")))
    out = on_grid(target.cells(), days)
    return clip_land(out, target.sea, ["moon"]) if target.sea is not None else out


def temperature(df: DataFrame, target: Target, variables: Sequence[str]) -> DataFrame:
    clipped = non_negative("sst_fdist")(df) if "sst_fdist" in df.columns else df
    return default(clipped, target, variables)


def pumping(df: DataFrame, target: Target, variables: Sequence[str]) -> DataFrame:
    return default(df.drop("dayofyear", "month", "quantile"), target, [v for v in variables if v not in ("dayofyear", "month", "quantile")])


COMPILERS: dict[str, Callable[[DataFrame, Target, Sequence[str]], DataFrame]] = {
    "bathy": static, "moon": moon, "o2": named_depths, "thetao": named_depths, "sst": temperature, "atm-accum-avg": pumping,
}


@dataclass
class Variable:
    key: str
    table: DataFrame
    columns: Sequence[str]
    compiler: Callable[[DataFrame, Target, Sequence[str]], DataFrame] | None = None
    levels: Sequence[float] | None = None


def compiled(variables: Sequence[Variable], target: Target, dates: DateRange | None = None) -> DataFrame:
    """All variables on the target grid, in one row for each (time, lat, lon) that any has; static ones on all of them."""
    moving, still = [], []
    for v in variables:
        run = v.compiler or (depths(v.levels) if v.levels else COMPILERS.get(v.key, default))
        table = v.table
        if "time" in table.columns:
            if dates is not None:
                table = table.filter(dates.predicate())
            moving.append(run(table, target, v.columns))
        else:
            still.append(run(table, target, v.columns))
    out = outer_merge(moving)
    for s in still:
        out = out.join(s, ["lat", "lon"], "left")
    return out


def compile_into(store: CubeStore, variables: Sequence[Variable], target: Target, dates: DateRange) -> bool:
    """Year by year into a store; variables without days in a year are left out of it."""
    good = True
    for part in dates.split(TimeResolution.YEAR):
        some = [v for v in variables if "time" not in v.table.columns or not v.table.filter(part.predicate()).isEmpty()]
        if not any("time" in v.table.columns for v in some):
            continue
        try:
            store.add_data(compiled(some, target, part))
        except ValueError:
            log.exception("%s failed", part.label())
            good = False
    return good


@dataclass
class Pipeline:
    """Steps by key, run in order; a key's failure is logged and the others go on."""

    steps: Mapping[str, Sequence[Callable[[str], object]]] = field(default_factory=dict)

    def run(self, keys: Sequence[str] | None = None) -> bool:
        good = True
        for key in keys or list(self.steps):
            if key not in self.steps:
                raise ValueError(f"no such variable: {key}")
            try:
                for step in self.steps[key]:
                    if step(key) is False:
                        good = False
            except Exception:
                log.exception("%s failed", key)
                good = False
        return good

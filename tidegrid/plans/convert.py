"""Raw files to Zarr stores, Zarr to Parquet and back, eddies to daily grids, and the run of all of it."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import AppConfig
from tidegrid.model import BBox, DateRange, TimeResolution, file_label
from tidegrid.operators.eddies import both_kinds, merged_sources, prepared
from tidegrid.operators.grid import centres
from tidegrid.operators.ocean import CELL, PROCESSORS
from tidegrid.plans.compile import Pipeline, Target, Variable, compile_into
from tidegrid.plans.incremental import update
from tidegrid.sources.catalog import write_provenance
from tidegrid.sources.netcdf import read_netcdf
from tidegrid.sources.store import CubeStore
from tidegrid.sources.zarr import append_zarr, scan_zarr

log = logging.getLogger(__name__)


def window(start, end) -> DateRange | None:
    """A closed range if both ends are given, none if neither is; ValueError for one alone."""
    if (start is None) != (end is None):
        raise ValueError("a window has a start and an end")
    return DateRange(start, end) if start is not None else None


def values_of(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("time", *CELL, "year", "month", "day")]


def periods(dates: DateRange, by: TimeResolution | str) -> list[DateRange]:
    return dates.split(TimeResolution(by))


def netcdf_to_zarr(spark: SparkSession, paths: str | Sequence[str], variables: Sequence[str], key: str, folder: str, dates: DateRange | None = None, by: str = "year", processor: Callable[[DataFrame], DataFrame] | None = None, manifest: Sequence[Mapping] = ()) -> list[str]:
    """Files of a key through its processor (PROCESSORS, or the one given) into a store for each period; their paths."""
    df = read_netcdf(spark, paths, variables)
    if dates is not None:
        df = df.filter(dates.predicate())
    run = processor or PROCESSORS.get(key)
    out = (run(df) if run else df).withColumn("time", F.to_date("time")).checkpoint()
    if out.isEmpty():
        log.warning("%s: no data", key)
        return []
    written = []
    for part in periods(DateRange.of(out), by):
        rows = out.filter(part.predicate())
        if rows.isEmpty():
            continue
        path = f"{folder.rstrip('/')}/{key}_{_label(part, by)}.zarr"
        append_zarr(rows, path, values_of(rows))
        write_provenance(spark, path, manifest, part.start, part.end)
        written.append(path)
    return written


def _label(part: DateRange, by: str) -> str:
    return f"{part.start:%Y}" if by == "year" else f"{part.start:%Y-%m}"


def zarr_to_parquet(spark: SparkSession, paths: Sequence[str], store: CubeStore, start=None, end=None, by: str = "month", variables: Sequence[str] | None = None) -> bool:
    """A Parquet store brought up to Zarr stores: see incremental.update."""
    return update(store, scan_zarr(spark, paths).withColumn("time", F.to_date("time")), start, end, TimeResolution(by), variables)


def parquet_to_zarr(store: CubeStore, folder: str, name: str, start=None, end=None, variables: Sequence[str] | None = None, by: str = "year", layout: str = "series") -> list[str]:
    """A Zarr store for each period of a Parquet store."""
    held = store.time_coverage()
    dates = DateRange(start or held.start, end or held.end)
    written = []
    for part in periods(dates, by):
        rows = store.scan(part, columns=variables).drop("year", "month", "day")
        if rows.isEmpty():
            continue
        path = f"{folder.rstrip('/')}/{name}_{_label(part, by)}.zarr"
        append_zarr(rows.select("time", *[F.col(c).cast("double").alias(c) for c in CELL], *values_of(rows)), path, values_of(rows), layout=layout)
        written.append(path)
    return written


@dataclass
class EddyFile:
    """Observations of one kind of eddy from one dataset, and the days that are taken from it."""

    table: DataFrame
    kind: str
    dataset_type: str
    dates: DateRange


def eddies_to_zarr(files: Sequence[EddyFile], grid: DataFrame, bbox: BBox, folder: str, start=None, end=None, by: str = "year", manifest: Sequence[Mapping] = ()) -> list[str]:
    """Daily grids of both kinds, a store for each period.

    A file gives only days of its own window; near-real-time files give those after the last reprocessed one of
    their kind. Nothing is written of periods without observations.
    """
    if bad := [f.kind for f in files if f.kind not in ("anticyclonic", "cyclonic")]:
        raise ValueError(f"no such kind: {bad[0]}")
    asked = window(start, end)
    spans = [(f, f.dates.intersection(asked) if asked else f.dates) for f in files]
    spans = [(f, d) for f, d in spans if d]
    if not spans:
        log.info("no file has days that are asked for")
        return []
    whole = reduce(DateRange.envelope, [d for _, d in spans])
    spark, written = grid.sparkSession, []
    for part in periods(whole, by):
        feeds: dict[str, list[DataFrame]] = {"rep": [], "nrt": []}
        for f, d in spans:
            if mine := d.intersection(part):
                feeds[f.dataset_type].append(prepared(f.table, bbox, mine).withColumn("kind", F.lit(f.kind)))
        rep, nrt = (reduce(DataFrame.unionByName, tables) if tables else None for tables in feeds.values())
        obs = merged_sources(rep, nrt) if rep is not None and nrt is not None else rep if rep is not None else nrt
        if obs is None or obs.isEmpty():
            continue
        days = both_kinds(obs, grid).checkpoint()
        path = f"{folder.rstrip('/')}/{file_label('eddies', '', bbox, None)}_{_label(part, by)}.zarr"
        append_zarr(days, path, values_of(days))
        write_provenance(spark, path, manifest, part.start, part.end)
        written.append(path)
    return written


def compile_stores(spark: SparkSession, stores: Mapping[str, Sequence[str]], out: CubeStore, bbox: BBox, step: float, dates: DateRange | None = None) -> bool:
    """Zarr stores by key on one grid, merged into a Parquet store."""
    tables = {k: scan_zarr(spark, p).withColumn("time", F.to_date("time")) for k, p in stores.items() if p}
    if not tables:
        raise FileNotFoundError("no stores to compile")
    target = Target(centres(spark, bbox.ymin, bbox.ymax, step, "lat"), centres(spark, bbox.xmin, bbox.xmax, step, "lon"))
    span = dates or reduce(DateRange.envelope, [DateRange.of(t) for t in tables.values()])
    return compile_into(out, [Variable(k, t, values_of(t)) for k, t in tables.items()], target, span)


def run(spark: SparkSession, config: AppConfig, keys: Sequence[str] | None = None, dates: DateRange | None = None, bbox: BBox | None = None, step: float = 0.25, convert: bool = True, compiled: bool = True, dry: bool = False) -> bool:
    """Convert the raw files of every key (downloads_root/KEY/*.nc) and compile the stores; a key's failure leaves the others."""
    wanted = list(keys or config.downloadable())
    for k in wanted:
        config.key(k)
    if dry:
        for k in wanted:
            log.info("%s: %s/%s/*.nc -> %s/%s", k, config.downloads_root, k, config.store_root, k)
        return True
    good, made = True, {}

    def one(key: str) -> bool:
        made[key] = netcdf_to_zarr(spark, f"{config.downloads_root}/{key}/*.nc", config.key(key).variables, key, f"{config.store_root}/{key}", dates, config.key(key).time_resolution)
        return bool(made[key])

    if convert:
        good = Pipeline({k: [one] for k in wanted}).run()
    if compiled and made:
        if bbox is None:
            raise ValueError("compiling needs a box")
        good = compile_stores(spark, made, CubeStore(spark, f"{config.store_root}/compiled"), bbox, step, dates) and good
    return good

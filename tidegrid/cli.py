"""Command line: python -m tidegrid.cli COMMAND ..."""

from __future__ import annotations

import argparse
import csv
import sys
from collections.abc import Sequence

from tidegrid.model import BBox, DateRange


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidegrid", description="Cube stores of gridded time series.")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=text)
        c.add_argument("store", help="folder of the store")
        return c

    command("coverage", "days, box and columns of a store")
    scan = command("scan", "rows as CSV, to the screen or into a folder")
    scan.add_argument("--columns", nargs="*")
    scan.add_argument("--output", help="folder, written by all tasks")
    add = command("add", "add Parquet rows to a store, upserting where days meet")
    add.add_argument("input")
    add.add_argument("--format", help="pattern of a text time column")
    up = command("update", "bring a store up to a source store")
    up.add_argument("source")
    files = command("csv", "CSV files by day, month or year")
    files.add_argument("output")
    files.add_argument("--freq", default="month", choices=("day", "month", "year"))
    agg = command("aggregate", "means by time bucket")
    agg.add_argument("--by", default="month", choices=("day", "week", "month", "year", "season"))
    agg.add_argument("--variables", nargs="+", required=True)
    conv = command("convert", "NetCDF files of a key into Zarr stores below a folder")
    conv.add_argument("input", help="path or pattern")
    conv.add_argument("--key", required=True)
    conv.add_argument("--variables", nargs="+", required=True)
    conv.add_argument("--resolution", default="year", choices=("year", "month"))
    cat = command("catalog", "what Zarr stores hold")
    cat.add_argument("more", nargs="*", help="more stores")
    cat.add_argument("--save", help="folder to keep the table in")
    comp = command("compile", "Zarr stores on one grid into a Parquet store")
    comp.add_argument("inputs", nargs="+", metavar="KEY=PATH")
    comp.add_argument("--step", type=float, default=0.25)
    z2p = command("zarr2parquet", "a Parquet store brought up to Zarr stores")
    z2p.add_argument("inputs", nargs="+")
    z2p.add_argument("--variables", nargs="*")
    p2z = command("parquet2zarr", "a Zarr store for each period of a Parquet store")
    p2z.add_argument("output")
    p2z.add_argument("--name", default="cube")
    p2z.add_argument("--variables", nargs="*")
    p2z.add_argument("--layout", default="series", choices=("series", "map"))
    for c in (z2p, p2z):
        c.add_argument("--resolution", default="month", choices=("year", "month"))
    run = sub.add_parser("run", help="convert and compile the keys of a configuration")
    run.add_argument("config")
    run.add_argument("--keys", nargs="*")
    run.add_argument("--step", type=float, default=0.25)
    for flag in ("--no-convert", "--no-compile", "--dry-run"):
        run.add_argument(flag, action="store_true")
    comp.add_argument("--bbox", nargs=4, type=float, required=True, metavar=("XMIN", "YMIN", "XMAX", "YMAX"))
    run.add_argument("--bbox", nargs=4, type=float, metavar=("XMIN", "YMIN", "XMAX", "YMAX"))
    for c in (scan, files, agg, up, conv, comp, z2p, p2z, run):
        c.add_argument("--start-date")
        c.add_argument("--end-date")
    for c in (scan, agg):
        c.add_argument("--bbox", nargs=4, type=float, metavar=("XMIN", "YMIN", "XMAX", "YMAX"))
    return p


def main(args: Sequence[str] | None = None) -> int:
    a = parser().parse_args(args)
    from tidegrid import config
    from tidegrid.operators.aggregate import aggregate_by_time
    from tidegrid.plans import convert
    from tidegrid.plans.incremental import update
    from tidegrid.session import session
    from tidegrid.sources import catalog
    from tidegrid.sources.files import export_csv
    from tidegrid.sources.store import CubeStore

    spark = session()
    store = CubeStore(spark, getattr(a, "store", ""))
    dates = (a.start_date, a.end_date) if getattr(a, "start_date", None) and a.end_date else None
    box = BBox(*a.bbox) if getattr(a, "bbox", None) else None
    if a.command == "coverage":
        print(store.time_coverage().label(), store.geo_extent().label())
        store.var_coverage().show(200, truncate=False)
    elif a.command == "scan":
        rows = store.scan(dates, box, a.columns)
        if a.output:
            rows.write.option("header", "true").csv(a.output)
        else:
            out = csv.writer(sys.stdout, lineterminator="\n")
            out.writerow(rows.columns)
            out.writerows(rows.toLocalIterator())  # a partition at a time
    elif a.command == "convert":
        paths = convert.netcdf_to_zarr(spark, a.input, a.variables, a.key, a.store, convert.window(a.start_date, a.end_date), a.resolution)
        print(*paths, sep="\n")
        return int(not paths)
    elif a.command == "catalog":
        table = catalog.scan_stores(spark, [a.store, *a.more])
        table.show(1000, truncate=False)
        if a.save:
            catalog.save_catalog(table, a.save)
    elif a.command == "compile":
        inputs: dict[str, list[str]] = {}
        for key, _, path in (x.partition("=") for x in a.inputs):
            inputs.setdefault(key, []).append(path)
        return int(not convert.compile_stores(spark, inputs, store, box, a.step, convert.window(a.start_date, a.end_date)))
    elif a.command == "zarr2parquet":
        return int(not convert.zarr_to_parquet(spark, a.inputs, store, a.start_date, a.end_date, a.resolution, a.variables))
    elif a.command == "parquet2zarr":
        print(*convert.parquet_to_zarr(store, a.output, a.name, a.start_date, a.end_date, a.variables, a.resolution, a.layout), sep="\n")
    elif a.command == "run":
        return int(not convert.run(spark, config.load(a.config), a.keys, convert.window(a.start_date, a.end_date), box, a.step, not a.no_convert, not a.no_compile, a.dry_run))
    elif a.command == "add":
        print(store.add_data(spark.read.parquet(a.input), a.format))
    elif a.command == "update":
        return int(not update(store, CubeStore(spark, a.source).scan(), a.start_date, a.end_date))
    elif a.command == "csv":
        export_csv(store.read(), a.output, DateRange(*dates) if dates else None, a.freq)
    elif a.command == "aggregate":
        aggregate_by_time(store.scan(dates, box, a.variables), a.variables, a.by).toPandas().to_csv(sys.stdout, index=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

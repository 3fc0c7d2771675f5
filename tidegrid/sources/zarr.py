"""Zarr (version 2) stores as long tables, and back.

Chunk files are read by Spark as binary files, so any file system that Spark reads will do, and
one chunk is one row of work. Only metadata and coordinate axes, which are small, are read on the
driver. Compressors: none, zlib, gzip and, where the package is there, zstd; others are refused.
"""

from __future__ import annotations

import datetime as dt
import gzip
import json
import logging
import math
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.model import BBox, to_day
from tidegrid.operators.grid import snap
from tidegrid.operators.join import outer_merge, replace_window

log = logging.getLogger(__name__)

_DIMS = ("time", "lat", "lon")
_UNITS = {"days": 86400, "hours": 3600, "minutes": 60, "seconds": 1}


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _bytes(spark: SparkSession, path: str) -> bytes | None:
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def decompressed(data: bytes, compressor: dict | None) -> bytes:
    kind = compressor["id"] if compressor else None
    if kind is None:
        return data
    if kind == "zlib":
        return zlib.decompress(data)
    if kind == "gzip":
        return gzip.decompress(data)
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"no such compressor here: {kind}")


def chunk_array(data: bytes, meta: dict) -> np.ndarray:
    """One chunk, in its full chunk shape."""
    if meta.get("filters"):
        raise ValueError("filtered arrays aren't read")
    return np.frombuffer(decompressed(data, meta["compressor"]), np.dtype(meta["dtype"])).reshape(meta["chunks"], order=meta["order"])


class ZarrStore:
    """Metadata of a consolidated or plain version 2 group."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        fs, where = _fs(spark, self.path)
        if not fs.exists(where):
            raise FileNotFoundError(path)
        self.arrays: dict[str, dict] = {}
        self.dims: dict[str, list[str]] = {}
        self.attrs: dict[str, dict] = {}
        for s in fs.listStatus(where):
            name = s.getPath().getName()
            if s.isDirectory() and (raw := _bytes(spark, f"{self.path}/{name}/.zarray")):
                self.arrays[name] = json.loads(raw)
                self.attrs[name] = json.loads(_bytes(spark, f"{self.path}/{name}/.zattrs") or b"{}")
                self.dims[name] = self.attrs[name].get("_ARRAY_DIMENSIONS", [name])

    def axis(self, name: str) -> np.ndarray:
        """A coordinate; times as microseconds since 1970."""
        meta = self.arrays[name]
        size = meta["shape"][0]
        out = []
        for i in range(math.ceil(size / meta["chunks"][0])):
            raw = _bytes(self.spark, f"{self.path}/{name}/{i}")
            out.append(np.full(meta["chunks"], meta["fill_value"]) if raw is None else chunk_array(raw, meta))
        values = np.concatenate(out)[:size]
        if m := re.fullmatch(r"(\w+) since (.+)", self.attrs[name].get("units", "")):
            first = np.datetime64(m[2].strip().replace(" ", "T").removesuffix("Z"), "us").astype(np.int64)
            return (values.astype(np.float64) * _UNITS[m[1]] * 1e6).round().astype(np.int64) + first
        return values

    def variables(self) -> list[str]:
        return [n for n in self.arrays if n not in {d for dims in self.dims.values() for d in dims}]


def _rows(meta: dict, dims: list[str], axes: dict[str, np.ndarray], name: str, attrs: dict, keep: dict[str, np.ndarray]):
    separator = meta.get("dimension_separator", ".")
    fill, scale, offset = meta.get("fill_value"), attrs.get("scale_factor", 1.0), attrs.get("add_offset", 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tail = path.rsplit(f"/{name}/", 1)[1]
                index = [int(x) for x in tail.split(separator)]
                block = chunk_array(data, meta)
                cut = tuple(slice(0, min(c, n - i * c)) for i, c, n in zip(index, meta["chunks"], meta["shape"], strict=True))
                block = block[cut]
                picked = {d: np.flatnonzero(keep[d][i * c : i * c + n]) if d in keep else np.arange(n) for d, i, c, n in zip(dims, index, meta["chunks"], block.shape, strict=True)}
                block = block[np.ix_(*picked.values())]
                values = block.astype(np.float64)
                missing = np.isnan(values)
                if isinstance(fill, (int, float)):
                    missing |= block == fill
                values = values * scale + offset
                grid = np.meshgrid(*[axes[d][i * c + picked[d]] for d, i, c in zip(dims, index, meta["chunks"], strict=True)], indexing="ij")
                columns = [pa.array(g.ravel().astype(np.int64) if d == "time" else g.ravel().astype(np.float64)) for d, g in zip(dims, grid, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(values.ravel(), mask=missing.ravel())], names=[*dims, name])

    return run


def _chunk_paths(store: ZarrStore, name: str, keep: dict[str, np.ndarray]) -> str | None:
    """A pattern of the chunks that keep any cell, by the numbers in their names; None if none is there."""
    meta, parts = store.arrays[name], []
    for d, size in zip(store.dims[name], meta["chunks"], strict=True):
        parts.append("{" + ",".join(map(str, np.unique(np.flatnonzero(keep[d]) // size))) + "}" if d in keep else "*")
    pattern = f"{store.path}/{name}/{meta.get('dimension_separator', '.').join(parts)}"
    if "{}" in pattern:
        return None
    fs, where = _fs(store.spark, pattern)
    return pattern if fs.globStatus(where) else None


def read_zarr(spark: SparkSession, path: str, variables: Sequence[str] | None = None, keep: dict[str, np.ndarray] | None = None) -> DataFrame:
    """One row for each cell that any of the variables has a chunk for; scaled, missing values null.

    keep: by dimension which of its steps are wanted; chunks without one are not read.
    """
    store = ZarrStore(spark, path)
    names = list(variables or store.variables())
    if unknown := [n for n in names if n not in store.arrays]:
        raise ValueError(f"no such variables: {', '.join(unknown)}")
    tables = []
    for n in names:
        meta, dims = store.arrays[n], store.dims[n]
        axes = {d: store.axis(d) for d in dims}
        mine = {d: m for d, m in (keep or {}).items() if d in dims}
        schema = ", ".join(f"{d} {'long' if d == 'time' else 'double'}" for d in dims) + f", {n} double"
        where = _chunk_paths(store, n, mine)
        if where is None:
            out = spark.createDataFrame([], schema)
        else:
            raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(where)
            raw = raw.filter(~F.regexp_extract("path", r"([^/]+)$", 1).startswith(".")).select("path", "content")
            out = raw.mapInArrow(_rows(meta, dims, axes, n, store.attrs[n], mine), schema)
        if "time" in dims:
            out = out.withColumn("time", F.timestamp_micros("time"))
        tables.append(out)
    keys = store.dims[names[0]]
    return tables[0] if len(tables) == 1 else outer_merge(tables, keys)


def scan_zarr(spark: SparkSession, paths: str | Sequence[str], dates=None, start_date=None, end_date=None, bbox: BBox | None = None, variables: Sequence[str] | None = None) -> DataFrame:
    """Single days, or a closed range of days that may be open at an end, of stores that follow each other in time.

    Stores and chunks outside are not read. time is midnight. A range that reaches beyond what is stored is cut, with a
    warning; single days that aren't there are left out, with a warning. ValueError if both kinds are given,
    FileNotFoundError if no day is left. Stores without time are cut by the box alone.
    """
    if dates is not None and (start_date is not None or end_date is not None):
        raise ValueError("single dates or a range, not both")
    stores = {p: ZarrStore(spark, p) for p in ([paths] if isinstance(paths, str) else paths)}
    if not stores:
        raise FileNotFoundError("no stores")
    held = {p: s.axis("time").astype("datetime64[us]").astype("datetime64[D]") for p, s in stores.items() if "time" in s.arrays}
    every = np.unique(np.concatenate(list(held.values()))) if held else None
    if every is not None and dates is not None:
        wanted = np.array(sorted({np.datetime64(to_day(d), "D") for d in ([dates] if isinstance(dates, (str, dt.date)) else dates)}), "datetime64[D]")
        if len(wanted) == 0:
            raise ValueError("no dates")
        if len(missing := np.setdiff1d(wanted, every)):
            log.warning("days that aren't stored: %s", ", ".join(map(str, missing)))
        chosen = {p: np.isin(t, wanted) for p, t in held.items()}
    elif every is not None:
        low, high = (np.datetime64(to_day(d), "D") if d is not None else None for d in (start_date, end_date))
        if low is not None and low < every[0]:
            log.warning("starts on %s, not %s", every[0], low)
        if high is not None and high > every[-1]:
            log.warning("ends on %s, not %s", every[-1], high)
        low, high = every[0] if low is None else low, every[-1] if high is None else high
        chosen = {p: (t >= low) & (t <= high) for p, t in held.items()}
    else:
        chosen = {}
    if chosen and not any(m.any() for m in chosen.values()):
        raise FileNotFoundError("no stored day is among those asked for")
    tables = []
    for p, s in stores.items():
        keep = {}
        if p in chosen:
            if not chosen[p].any():
                continue
            keep["time"] = chosen[p]
        if bbox is not None:
            for d, low, high in (("lat", bbox.ymin, bbox.ymax), ("lon", bbox.xmin, bbox.xmax)):
                if d in s.arrays:
                    keep[d] = (s.axis(d) >= low) & (s.axis(d) <= high)
        out = read_zarr(spark, p, variables, keep)
        tables.append(out.withColumn("time", F.date_trunc("day", "time")) if "time" in out.columns else out)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def merge_tiles(tiles: DataFrame, bbox: BBox, path: str, variables: Sequence[str], tile: int = 512) -> None:
    """Tiles of one layer (lat, lon and values) cut to a box, as a store of square chunks. ValueError if the box has no cell."""
    inside = tiles.filter(bbox.predicate()).withColumn("time", F.lit("1970-01-01").cast("date"))
    if inside.isEmpty():
        raise ValueError(f"{bbox} has no cell of the tiles")
    write_zarr(inside, path, variables, (1, tile, tile))


def time_steps_per_chunk(cells: int, bytes_per_value: int = 4, target_mb: float = 32.0) -> int:
    """Steps of a chunk of about the target size, for a tile of so many cells."""
    return max(1, int(target_mb * 1e6 // (cells * bytes_per_value)))


def _steps(times: Sequence) -> np.ndarray:
    """Days since 1970, as they are stored."""
    return np.array([np.datetime64(t, "us").astype(np.int64) for t in times]) / 86400e6


class _Sink:
    """Writes the files of a group."""

    def __init__(self, spark: SparkSession, path: str, compressor: str | None):
        self.spark, self.path, self.zlib = spark, path, compressor == "zlib"
        self.fs, _ = _fs(spark, path)

    def put(self, name: str, data: bytes) -> None:
        stream = self.fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)
        stream.write(bytearray(data))
        stream.close()

    def array(self, name: str, dims: Sequence[str], shape: Sequence[int], chunks: Sequence[int], dtype: str, fill, **attrs) -> None:
        c = {"id": "zlib", "level": 1} if self.zlib else None
        about = {"zarr_format": 2, "shape": list(shape), "chunks": list(chunks), "dtype": dtype, "compressor": c, "fill_value": fill, "order": "C", "filters": None}
        self.put(f"{name}/.zattrs", json.dumps({"_ARRAY_DIMENSIONS": list(dims), **attrs}).encode())
        self.put(f"{name}/.zarray", json.dumps(about).encode())

    def axis(self, name: str, values: np.ndarray, **attrs) -> None:
        raw = values.astype("<f8").tobytes()
        self.put(f"{name}/0", zlib.compress(raw, 1) if self.zlib else raw)
        self.array(name, [name], values.shape, values.shape, "<f8", None, **attrs)

    def blocks(self, df: DataFrame, axes: dict[str, Sequence], chunks: Sequence[int], variables: Sequence[str]) -> None:
        """The chunks that rows fall in, made on the executors and written one after the other."""
        place = df
        for k, d in enumerate(_DIMS):
            table = self.spark.createDataFrame([(x, i) for i, x in enumerate(axes[d])], f"{d} {dict(df.dtypes)[d]}, __{k} long")
            place = place.join(table, d)
        at = [F.expr(f"__{k} div {c}").alias(f"c{k}") for k, c in enumerate(chunks)]
        inner = [F.expr(f"__{k} % {c}").alias(f"i{k}") for k, c in enumerate(chunks)]
        names, sizes, packed = list(variables), tuple(chunks), self.zlib

        def block(pdf: pd.DataFrame) -> pd.DataFrame:
            out = []
            key = ".".join(str(int(pdf[f"c{k}"].iloc[0])) for k in range(3))
            for n in names:
                a = np.full(sizes, np.nan, "<f4")
                a[pdf["i0"], pdf["i1"], pdf["i2"]] = pdf[n].to_numpy(dtype=np.float32)
                out.append((f"{n}/{key}", zlib.compress(a.tobytes(), 1) if packed else a.tobytes()))
            return pd.DataFrame(out, columns=["name", "data"])

        made = place.select(*at, *inner, *names).groupBy("c0", "c1", "c2").applyInPandas(block, "name string, data binary")
        for r in made.toLocalIterator():  # one chunk at a time
            self.put(r["name"], bytes(r["data"]))


def _axes(df: DataFrame) -> dict[str, list]:
    return {d: sorted(r[0] for r in df.select(d).distinct().collect()) for d in _DIMS}  # axes


def write_zarr(df: DataFrame, path: str, variables: Sequence[str], chunks: tuple[int, int, int] | None = None, layout: str = "series", compressor: str | None = "zlib") -> None:
    """A cube as a version 2 group of (time, lat, lon) float arrays.

    layout series: tiles of at most 256 x 256 cells and long times; map: all cells and few steps. Metadata
    come after the chunks, so a group that was cut short has none.
    """
    if layout not in ("series", "map"):
        raise ValueError(f"no such layout: {layout}")
    axes = _axes(df)
    shape = [len(axes[d]) for d in _DIMS]
    if chunks is None:
        tile = (min(256, shape[1]), min(256, shape[2])) if layout == "series" else tuple(shape[1:])
        steps = time_steps_per_chunk(tile[0] * tile[1]) if layout == "series" else 14
        chunks = (max(1, min(steps, shape[0])), *tile)
    sink = _Sink(df.sparkSession, path, compressor)
    sink.blocks(df, axes, chunks, variables)
    sink.axis("time", _steps(axes["time"]), units="days since 1970-01-01")
    for d in ("lat", "lon"):
        sink.axis(d, np.array(axes[d], float))
    for n in variables:
        sink.array(n, _DIMS, shape, chunks, "<f4", "NaN")
    sink.put(".zgroup", b'{"zarr_format": 2}')


def group_attributes(spark: SparkSession, path: str) -> dict:
    return json.loads(_bytes(spark, f"{path.rstrip('/')}/.zattrs") or b"{}")


def set_attributes(spark: SparkSession, path: str, attributes: dict) -> dict:
    """Attributes of a group, merged into those it has."""
    out = {**group_attributes(spark, path), **attributes}
    _Sink(spark, path.rstrip("/"), None).put(".zattrs", json.dumps(out, default=str).encode())
    return out


# -- appending -----------------------------------------------------------------------------------


def recover(spark: SparkSession, path: str) -> str | None:
    """Finish or undo a replacement that was cut short: "restored", "cleaned" or None."""
    fs, where = _fs(spark, path)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    backup, fresh = Path(f"{path}.bak"), Path(f"{path}.tmp")
    done = None
    if fs.exists(fresh):
        fs.delete(fresh, True)
        done = "cleaned"
    if fs.exists(backup):
        if fs.exists(where):
            fs.delete(backup, True)
            return "cleaned"
        fs.rename(backup, where)
        return "restored"
    return done


def _replace(spark: SparkSession, path: str, steps: int) -> None:
    """path.tmp, once it can be opened, instead of path."""
    if len(ZarrStore(spark, f"{path}.tmp").axis("time")) != steps:
        raise OSError(f"{path}.tmp is not what was written")
    fs, where = _fs(spark, path)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    if fs.exists(where):
        fs.rename(where, Path(f"{path}.bak"))
    fs.rename(Path(f"{path}.tmp"), where)
    fs.delete(Path(f"{path}.bak"), True)


def append_zarr(df: DataFrame, path: str, variables: Sequence[str], **layout) -> str:
    """Add a cube to a store; returns how: "created", "appended", "replaced" or "merged".

    Later steps of the same variables on the same cells are appended: of what is stored, only an unfilled
    last row of chunks is written anew, with the same values in it. Anything else replaces the store whole, by way
    of a copy that is moved into place: by df alone if it has all stored variables over all stored days, else by
    both (join.replace_window). ValueError if the boxes lie apart. time is a day or a timestamp.
    """
    spark = df.sparkSession
    recover(spark, path)
    df = snap(df.select(*_DIMS, *variables))
    axes = _axes(df)
    if not axes["time"]:
        raise ValueError("nothing to append")
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        write_zarr(df, f"{path}.tmp", variables, **layout)
        _replace(spark, path, len(axes["time"]))
        return "created"
    store = ZarrStore(spark, path)
    days, lats, lons = (store.axis(d) for d in _DIMS)
    if min(axes["lat"]) > lats.max() or max(axes["lat"]) < lats.min() or min(axes["lon"]) > lons.max() or max(axes["lon"]) < lons.min():
        raise ValueError(f"the box of the input doesn't meet that of {path}")
    steps = (_steps(axes["time"]) * 86400e6).round().astype(np.int64)
    held = set(store.variables())
    metas = [store.arrays[n] for n in variables if n in held]
    plain = all(store.dims[n] == list(_DIMS) and store.arrays[n]["dtype"] == "<f4" and store.arrays[n]["chunks"] == metas[0]["chunks"] and (store.arrays[n]["compressor"] or {"id": "zlib"})["id"] == "zlib" for n in held & set(variables))
    same = held == set(variables) and np.array_equal(lats, axes["lat"]) and np.array_equal(lons, axes["lon"])
    day = dict(df.dtypes)["time"] == "date"

    def stored(keep: dict[str, np.ndarray] | None = None) -> DataFrame:
        old = read_zarr(spark, path, sorted(held), keep)
        return snap(old.withColumn("time", F.to_date("time")) if day else old)

    if plain and same and steps[0] > days[-1] and np.all(np.diff(days) > 0):
        sizes, compressor = metas[0]["chunks"], "zlib" if metas[0]["compressor"] else None
        first = len(days) // sizes[0] * sizes[0]
        tail = stored({"time": np.arange(len(days)) >= first}).select(df.columns) if first < len(days) else None
        every = np.concatenate([days, steps])
        values = [np.datetime64(int(t), "us").astype("datetime64[us]").item() for t in every]
        full = {"time": [v.date() for v in values] if day else values, "lat": axes["lat"], "lon": axes["lon"]}
        sink = _Sink(spark, path, compressor)
        sink.blocks(df if tail is None else tail.unionByName(df), full, sizes, variables)
        sink.axis("time", every / 86400e6, units="days since 1970-01-01")
        for n in variables:
            sink.array(n, _DIMS, [len(every), len(lats), len(lons)], sizes, "<f4", "NaN")
        return "appended"
    covers = held <= set(variables) and steps[0] <= days[0] and steps[-1] >= days[-1]
    whole = df if covers else replace_window(stored(), df)
    names = list(dict.fromkeys([*variables, *([] if covers else sorted(held))]))
    write_zarr(whole, f"{path}.tmp", names, **layout)
    _replace(spark, path, len(ZarrStore(spark, f"{path}.tmp").axis("time")))
    return "replaced" if covers else "merged"

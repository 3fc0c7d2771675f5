import datetime as dt
import json
import logging
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_support import cube
from tidegrid import cli, config
from tidegrid.functions import crs
from tidegrid.model import BBox, DateRange, with_attributes
from tidegrid.operators.grid import generate_grid
from tidegrid.plans import convert
from tidegrid.sources import catalog, connectors, files, netcdf, zarr
from tidegrid.sources.store import CubeStore

D = dt.date
LAT, LON = np.array([30.0, 35.0, 40.0]), np.array([-10.0, -5.0, 0.0])


def raw(path, first, n, name="mlotst"):
    v = np.arange(n * 9.0).reshape(n, 3, 3) + 1000 * first
    netcdf.write_classic(str(path), {"time": np.arange(first, first + n, dtype=float), "lat": LAT, "lon": LON}, {name: v}, {"time": {"units": "days since 2020-12-30 00:00:00"}})


def test_convert_compile_and_back(spark, tmp_path, capsys):
    (tmp_path / "raw" / "mld").mkdir(parents=True)
    raw(tmp_path / "raw" / "mld" / "a.nc", 0, 3)
    raw(tmp_path / "raw" / "mld" / "b.nc", 3, 2)
    z, p = str(tmp_path / "z"), str(tmp_path / "p")
    assert cli.main(["convert", z, str(tmp_path / "raw" / "mld" / "*.nc"), "--key", "mld", "--variables", "mlotst"]) == 0
    paths = capsys.readouterr().out.split()
    assert [x.rsplit("/", 1)[1] for x in paths] == ["mld_2020.zarr", "mld_2021.zarr"]
    assert zarr.scan_zarr(spark, paths).filter("time = DATE '2021-01-02' AND lat = 35 AND lon = 0").first()["mld"] == 3005.0
    assert cli.main(["catalog", *paths, "--save", str(tmp_path / "cat")]) == 0
    held = catalog.load_catalog(spark, str(tmp_path / "cat"))
    assert sorted((r["start_date"], r["end_date"], r["num_timesteps"], r["variables"]) for r in held.collect()) == [(D(2020, 12, 30), D(2020, 12, 31), 2, ["mld"]), (D(2021, 1, 1), D(2021, 1, 3), 3, ["mld"])]
    catalog.save_catalog(held.filter("num_timesteps = 3"), str(tmp_path / "cat"))
    assert catalog.load_catalog(spark, str(tmp_path / "cat")).count() == 1 and catalog.load_catalog(spark, str(tmp_path / "none")).isEmpty()
    assert cli.main(["compile", p, *[f"mld={x}" for x in paths], "--step", "2.5", "--bbox", "-10", "30", "0", "40"]) == 0
    compiled = CubeStore(spark, p)
    assert compiled.time_coverage() == DateRange("2020-12-30", "2021-01-03") and compiled.scan().count() == 5 * 16
    row = compiled.scan(("2020-12-30", "2020-12-30")).filter("lat = 31.25 AND lon = -8.75").first()
    assert row["mld"] == pytest.approx(0.25 + 0.75)  # a quarter of the way to the next of 1 and of 3
    q = str(tmp_path / "q")
    assert cli.main(["zarr2parquet", q, *paths]) == 0
    assert cli.main(["parquet2zarr", q, str(tmp_path / "zz"), "--resolution", "year"]) == 0
    back = capsys.readouterr().out.split()[-2:]
    a, b = (sorted(map(tuple, zarr.scan_zarr(spark, x).select("time", "lat", "lon", "mld").collect())) for x in (paths, back))
    assert a == b and len(a) == 45
    assert cli.main(["scan", q, "--output", str(tmp_path / "csv")]) == 0 and spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 45
    with pytest.raises(ValueError):
        convert.window("2020-01-01", None)
    with pytest.raises(FileNotFoundError):
        convert.compile_stores(spark, {}, compiled, BBox(0, 0, 1, 1), 1.0)


def test_the_run_of_a_configuration(spark, tmp_path, caplog):
    (tmp_path / "raw" / "mld").mkdir(parents=True)
    raw(tmp_path / "raw" / "mld" / "a.nc", 2, 3)
    about = {"store_root": str(tmp_path / "out"), "downloads_root": str(tmp_path / "raw"), "keys": {"mld": {"variables": ["mlotst"]}, "chl": {"variables": ["CHL"]}}, "attributes": {"global": {"a": "1", "b": "1"}, "mld": {"b": "2"}}}
    (tmp_path / "c.json").write_text(json.dumps(about))
    assert cli.main(["run", str(tmp_path / "c.json"), "--dry-run"]) == 0 and not (tmp_path / "out").exists()
    assert cli.main(["run", str(tmp_path / "c.json"), "--keys", "mld", "--bbox", "-10", "30", "0", "40", "--step", "5"]) == 0
    assert CubeStore(spark, str(tmp_path / "out" / "compiled")).scan().count() == 3 * 4
    assert cli.main(["run", str(tmp_path / "c.json"), "--no-compile"]) == 1 and "chl failed" in caplog.text  # no files of chl
    assert config.load(tmp_path / "c.json").variable_attributes("mld") == {"a": "1", "b": "2"}


def test_eddies_of_two_feeds(spark, tmp_path):
    def obs(days, track):
        rows = [(dt.datetime(2020, 12, d) if d < 32 else dt.datetime(2021, 1, d - 31), 35.0, 355.0, track, 3, 50000.0, 40000.0, 0.1, 0.5) for d in days]
        return spark.createDataFrame(rows, "time timestamp, latitude double, longitude double, track int, observation_number int, effective_radius double, speed_radius double, amplitude double, speed_average double")

    box = BBox(-10, 30, 0, 40)
    span = lambda a, b: DateRange(D(2020, 12, 1) + dt.timedelta(days=a - 1), D(2020, 12, 1) + dt.timedelta(days=b - 1))
    parts = [convert.EddyFile(obs([29, 30, 31], 1), "cyclonic", "rep", span(29, 31)), convert.EddyFile(obs([30, 31, 32], 2), "cyclonic", "nrt", span(30, 32)), convert.EddyFile(obs([31, 32], 3), "anticyclonic", "rep", span(31, 32))]
    manifest = [{"dataset_id": "r", "dataset_type": "rep", "start": "2020-01-01", "end": "2020-12-31"}, {"dataset_id": "n", "dataset_type": "nrt", "start": "2021-01-01", "end": "2021-06-01"}]
    paths = convert.eddies_to_zarr(parts, generate_grid(spark, box, 5.0), box, str(tmp_path), "2020-12-30", "2021-01-01", manifest=manifest)
    assert [p.rsplit("_", 1)[1] for p in paths] == ["2020.zarr", "2021.zarr"]
    got = {(r["time"].date(), r["lat"], r["lon"]): r for r in zarr.scan_zarr(spark, paths).collect()}
    assert sorted({k[0] for k in got}) == [D(2020, 12, 30), D(2020, 12, 31), D(2021, 1, 1)] and len(got) == 12
    assert got[(D(2020, 12, 31), 32.5, -7.5)]["c_track"] == 1 and got[(D(2021, 1, 1), 32.5, -7.5)]["c_track"] == 2 and got[(D(2020, 12, 30), 32.5, -7.5)]["ac_track"] is None
    assert [json.loads(r["source_datasets"])[0]["dataset_id"] for r in catalog.scan_stores(spark, paths).orderBy("path").collect()] == ["r", "n"]
    assert convert.eddies_to_zarr(parts, generate_grid(spark, box, 5.0), box, str(tmp_path), "2010-01-01", "2010-01-02") == []
    with pytest.raises(ValueError):
        convert.eddies_to_zarr([convert.EddyFile(obs([29], 1), "other", "rep", span(29, 31))], generate_grid(spark, box, 5.0), box, str(tmp_path))


def test_provenance_widens(spark, tmp_path):
    path = str(tmp_path / "z")
    zarr.write_zarr(cube(spark, [D(2021, 1, 1)]), path, ["sst"])
    tasks = [{"dataset_id": "r", "dataset_type": "rep", "start": "2021-01-01", "end": "2021-01-20"}]
    catalog.write_provenance(spark, path, tasks, "2021-01-01", "2021-01-05")
    out = catalog.write_provenance(spark, path, tasks, "2021-01-10", "2021-03-05")
    assert out == [{"dataset_id": "r", "dataset_type": "rep", "start_date": "2021-01-01", "end_date": "2021-01-20"}]
    assert catalog.write_provenance(spark, path, [], "2021-01-10", "2021-03-05") == out and zarr.read_zarr(spark, path).count() == 9


class Tree:
    def __init__(self, files, fails=0):
        self.files, self.fails, self.got = files, fails, []

    def listing(self, folder):
        names = {f[len(folder) + 1 :].partition("/") for f in self.files if f.startswith(folder + "/")}
        return sorted({(f"{folder}/{a}", bool(b)) for a, b, _ in names})

    def download(self, path, target):
        if self.fails:
            self.fails -= 1
            raise OSError("gone away")
        self.got.append(path)
        with open(target, "w") as f:
            f.write(path)


def test_an_archive_of_files(tmp_path, caplog):
    tree = Tree([f"/rep/2020/x_2020010{d}.nc" for d in (1, 2, 3)] + ["/rep/readme.txt"] + [f"/nrt/x_2020010{d}.nc" for d in (3, 4, 5)], fails=1)
    a = connectors.Archive(tree, r"_(\d{8})\.nc")
    assert a.available("/rep") == DateRange("2020-01-01", "2020-01-03") and a.available("/none") is None
    got = a.run(DateRange("2020-01-02", "2020-01-04"), "/rep", "/nrt", str(tmp_path))
    assert [g[len(str(tmp_path)) :] for g in got] == ["/rep/x_20200102.nc", "/rep/x_20200103.nc", "/nrt/x_20200104.nc"]
    n = len(tree.got)
    a.run(DateRange("2020-01-02", "2020-01-04"), "/rep", "/nrt", str(tmp_path))
    assert len(tree.got) == n and not list(tmp_path.rglob("*.part"))
    with pytest.raises(ValueError):
        connectors.Archive(tree, "x")
    with caplog.at_level(logging.WARNING):
        assert connectors.warn_if_reprocessed("sst", D(2020, 1, 1), D(2020, 2, 1)) and "2020-02-01" in caplog.text
    assert not connectors.warn_if_reprocessed("sst", None, D(2020, 2, 1)) and not connectors.warn_if_reprocessed("sst", D(2020, 1, 1), D(2020, 2, 1), False)


def test_empty_folders_go(spark, tmp_path):
    (tmp_path / "a" / "b" / "c").mkdir(parents=True)
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "f.nc").write_text("x")
    assert files.prune_empty(spark, str(tmp_path)) == 4 and sorted(p.name for p in tmp_path.rglob("*")) == ["d", "f.nc"]
    assert files.prune_empty(spark, str(tmp_path / "none")) == 0


def test_reference_systems(spark):
    df = spark.createDataFrame([(-5.0, 40.0)], "lon double, lat double")
    assert crs.crs_of(df) is None and crs.crs_of(crs.ensure_crs(df, crs.DEGREES)) == crs.DEGREES
    metres = df.select((F.radians("lon") * crs.RADIUS_M).alias("lon"), F.lit(crs.RADIUS_M * math.log(math.tan(math.pi / 4 + math.radians(40) / 2))).alias("lat"))
    got = crs.to_degrees(crs.stamped(metres, crs.MERCATOR)).first()
    assert (got["lon"], got["lat"]) == (pytest.approx(-5), pytest.approx(40)) and crs.to_degrees(df).first() == df.first()
    with pytest.raises(ValueError):
        crs.to_degrees(df, "EPSG:27700")
    named = with_attributes(df, {"lon": {"units": "degrees"}, "other": {}})
    assert named.schema["lon"].metadata == {"units": "degrees"} and named.columns == ["lon", "lat"]

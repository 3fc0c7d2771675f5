import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_support import cube
from tidegrid.cube import Cube
from tidegrid.model import BBox
from tidegrid.operators import extract, ocean
from tidegrid.plans import plots
from tidegrid.sources import netcdf, zarr

D = dt.date


def days(n):
    return [D(2021, 1, 1) + dt.timedelta(days=i) for i in range(n)]


@pytest.mark.parametrize(("layout", "chunks", "compressor"), [("series", (4, 2, 2), "zlib"), ("map", None, None), ("series", None, "zlib")])
def test_zarr_round_trip(spark, tmp_path, layout, chunks, compressor):
    df = cube(spark, days(10)).filter("NOT (time = DATE '2021-01-03' AND lat = 35)").withColumn("chl", F.when(F.col("lat") > 30, F.col("sst") / 8))
    path = str(tmp_path / "z")
    zarr.write_zarr(df, path, ["sst", "chl"], chunks, layout, compressor)
    back = zarr.read_zarr(spark, path).withColumn("time", F.to_date("time"))
    assert back.count() == 90
    want = {(r["time"], r["lat"], r["lon"]): (r["sst"], r["chl"]) for r in df.collect()}
    for r in back.collect():
        assert (r["sst"], r["chl"]) == want.get((r["time"], r["lat"], r["lon"]), (None, None))
    assert zarr.read_zarr(spark, path, ["chl"]).columns == ["time", "lat", "lon", "chl"]
    with pytest.raises(ValueError):
        zarr.read_zarr(spark, path, ["none"])
    with pytest.raises(FileNotFoundError):
        zarr.read_zarr(spark, path + "x")


def test_zarr_steps():
    assert zarr.time_steps_per_chunk(256 * 256) == 122 and zarr.time_steps_per_chunk(10**9) == 1
    with pytest.raises(ValueError):
        zarr.decompressed(b"", {"id": "blosc"})


def test_classic_netcdf(spark, tmp_path):
    lat, lon = np.array([30.0, 35.0]), np.array([-10.0, -5.0, 0.0])
    for k in range(2):
        v = np.arange(12.0).reshape(2, 2, 3) + 100 * k
        v[0, 0, 0] = -999
        netcdf.write_classic(str(tmp_path / f"f{k}.nc"), {"time": np.array([2.0 * k, 2.0 * k + 1]), "lat": lat, "lon": lon}, {"CHL": v}, {"time": {"units": "days since 2021-01-01 00:00:00"}, "CHL": {"_FillValue": -999.0, "scale_factor": 0.5}})
    df = netcdf.read_netcdf(spark, str(tmp_path / "*.nc"), ["CHL"], renames={"CHL": "chl"}, processor=ocean.non_negative("chl"))
    assert df.count() == 24 and df.filter("chl IS NULL").count() == 2
    assert df.filter("time = TIMESTAMP '2021-01-04' AND lat = 35 AND lon = 0").first()["chl"] == 55.5
    with pytest.raises(ValueError):
        netcdf.ClassicFile(b"\x89HDF")


def test_the_facade(spark, tmp_path):
    c = Cube(spark, str(tmp_path / "s"))
    assert "empty" in repr(c)
    c.add_data(cube(spark, days(40)))
    assert "2021-01-01_2021-02-09" in repr(c) and "sst" in repr(c)
    first = c.stats_summary("sst")
    assert first is c.stats_summary("sst") and first.count() == 2
    c.add_data(cube(spark, [D(2021, 3, 1)]))
    assert c.stats_summary("sst").count() == 3 and len(c.load(("2021-03-01", "2021-03-01"))) == 9
    assert c.time_series(["sst"], (-10.0, 30.0)).count() == 3 and c.spatial_maps("sst").count() == 27
    with pytest.raises(ValueError):
        c.time_series([])
    parts = plots.split_by_group(c.spatial_maps("sst"), "month")
    assert list(parts) == [1, 2, 3] and parts[2].count() == 9
    assert plots.export_map(c.scan(), str(tmp_path / "m")) and not plots.export_map(c.scan(), str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 41 * 9


def test_trends():
    x = np.arange(30.0)
    assert plots.lowess(x, 2 * x + 1) == pytest.approx((2 * x + 1).tolist())
    assert plots.lowess([1, 1, 1], [1, 2, 3]) == pytest.approx([2, 2, 2])


def test_extraction_resumes(spark, tmp_path):
    p = spark.createDataFrame([(1, D(2021, 1, 2), -5.0, 35.0)], "row_id int, time date, lon double, lat double")
    good = cube(spark, days(3))
    bad = good.withColumnRenamed("sst", "x")
    out, failed = extract.extract_keys(p, {"a": (good, ["sst"]), "b": (bad, ["missing"])}, str(tmp_path / "stage"))
    assert failed == ["b"] and out.first()["sst"] == 13.0
    out, failed = extract.extract_keys(p, {"a": (None, ["sst"]), "b": (bad, ["x"])}, str(tmp_path / "stage"))
    assert not failed and (out.first()["sst"], out.first()["x"]) == (13.0, 13.0) and not (tmp_path / "stage").exists()


def test_points_of_a_multipoint(spark):
    df = spark.createDataFrame([(1, [(1.0, 2.0), (3.0, 4.0)])], "id int, points array<struct<lon: double, lat: double>>")
    assert [(r["lon"], r["lat"]) for r in plots.points(df).collect()] == [(1.0, 2.0), (3.0, 4.0)]


def test_zarr_scan_reads_only_the_chunks_it_needs(spark, tmp_path, caplog):
    path = str(tmp_path / "a")
    df = cube(spark, days(10))
    zarr.write_zarr(df, path, ["sst"], (4, 2, 2))
    later = str(tmp_path / "b")
    zarr.write_zarr(cube(spark, [D(2021, 1, 11), D(2021, 1, 12)]), later, ["sst"])
    box = BBox(-6, 36, 1, 41)
    for gone in ("0.0.0", "0.1.0", "2.1.0", "1.0.1"):
        (tmp_path / "a" / "sst" / gone).write_bytes(b"not to be read")
    got = zarr.scan_zarr(spark, [path, later], start_date="2021-01-05", end_date="2021-01-08", bbox=BBox(-1, 36, 1, 41)).collect()
    assert sorted((r["time"].day, r["lat"], r["lon"], r["sst"]) for r in got) == [(d, 40.0, 0.0, (d - 1) * 9 + 8.0) for d in range(5, 9)]
    zarr.write_zarr(df, path, ["sst"], (4, 2, 2))
    assert zarr.scan_zarr(spark, [path, later], ["2021-01-02", "2021-01-12", "2025-01-01"], bbox=box).count() == 4 and "2025-01-01" in caplog.text
    caplog.clear()
    assert zarr.scan_zarr(spark, [path, later], start_date="2020-01-01", end_date="2021-01-01").count() == 9 and "2020-01-01" in caplog.text
    assert zarr.scan_zarr(spark, path).count() == 90
    for bad, kind in (({"dates": ["2021-01-01"], "end_date": "2021-01-02"}, ValueError), ({"dates": []}, ValueError), ({"dates": "2030-01-01"}, FileNotFoundError), ({"start_date": "2030-01-01"}, FileNotFoundError)):
        with pytest.raises(kind):
            zarr.scan_zarr(spark, path, **bad)


def test_zarr_append(spark, tmp_path):
    path = str(tmp_path / "z")
    every = days(9)

    def values():
        return {(r["time"].date(), r["lat"], r["lon"]): tuple(r[c] for c in sorted(r.asDict()) if c not in ("time", "lat", "lon")) for r in zarr.read_zarr(spark, path).collect()}

    assert zarr.append_zarr(cube(spark, every[:5]), path, ["sst"], chunks=(3, 2, 2)) == "created"
    untouched = (tmp_path / "z" / "sst" / "0.0.0").stat().st_mtime_ns
    assert zarr.append_zarr(cube(spark, every[5:7], lambda t, i, j: 100 * t + i + j), path, ["sst"]) == "appended"
    assert (tmp_path / "z" / "sst" / "0.0.0").stat().st_mtime_ns == untouched
    got = values()
    assert len(got) == 63 and got[(every[4], 40.0, 0.0)] == (44.0,) and got[(every[6], 35.0, 0.0)] == (103.0,)
    assert zarr.append_zarr(cube(spark, every[6:8], lambda *x: 1.0), path, ["sst"]) == "merged"
    got = values()
    assert len(got) == 72 and got[(every[5], 30.0, -5.0)] == (1.0,) and got[(every[6], 35.0, 0.0)] == (1.0,) and got[(every[0], 30.0, 0.0)] == (2.0,)
    assert zarr.append_zarr(cube(spark, every[:1], name="chl"), path, ["chl"]) == "merged"
    got = values()
    assert got[(every[0], 30.0, 0.0)] == (2.0, 2.0) and got[(every[1], 30.0, 0.0)] == (None, 11.0)
    both = cube(spark, every).withColumn("chl", F.lit(7.0))
    assert zarr.append_zarr(both, path, ["sst", "chl"]) == "replaced" and values()[(every[1], 30.0, 0.0)] == (7.0, 11.0)
    with pytest.raises(ValueError):
        zarr.append_zarr(both.withColumn("lat", F.col("lat") + 90), path, ["sst"])
    with pytest.raises(ValueError):
        zarr.append_zarr(both.filter("false"), path, ["sst"])


def test_a_replacement_that_was_cut_short(spark, tmp_path):
    path = str(tmp_path / "z")
    zarr.write_zarr(cube(spark, days(2)), path + ".bak", ["sst"])
    (tmp_path / "z.tmp").mkdir()
    assert zarr.recover(spark, path) == "restored" and zarr.read_zarr(spark, path).count() == 18
    zarr.write_zarr(cube(spark, days(1)), path + ".bak", ["sst"])
    assert zarr.recover(spark, path) == "cleaned" and zarr.read_zarr(spark, path).count() == 18 and zarr.recover(spark, path) is None


def test_tiles_are_merged(spark, tmp_path):
    tiles = cube(spark, days(1), name="z").drop("time")
    zarr.merge_tiles(tiles, BBox(-6, 30, 0, 36), str(tmp_path / "m"), ["z"], tile=1)
    assert zarr.read_zarr(spark, str(tmp_path / "m")).count() == 4
    with pytest.raises(ValueError):
        zarr.merge_tiles(tiles, BBox(50, 30, 60, 36), str(tmp_path / "n"), ["z"])

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests_support import cube
from tidegrid.model import BBox, DateRange
from tidegrid.plans import compile as compiling
from tidegrid.plans.incremental import backfill_window, update
from tidegrid.operators import grid
from tidegrid.sources import catalog, files
from tidegrid.sources.store import CubeStore
from tidegrid.streaming.late import upsert_stream

D = dt.date


def days(first, n):
    return [first + dt.timedelta(days=i) for i in range(n)]


def test_create_append_merge(spark, tmp_path):
    s = CubeStore(spark, str(tmp_path / "s"))
    with pytest.raises(RuntimeError):
        s.scan()
    assert s.add_data(cube(spark, days(D(2021, 1, 30), 3))) == "created"
    assert s.add_data(cube(spark, days(D(2021, 3, 1), 2))) == "appended"
    new = cube(spark, days(D(2021, 2, 1), 1), lambda *x: None).withColumn("chl", F.lit(0.5))
    assert s.add_data(new) == "merged"
    got = {r["time"]: (r["sst"], r["chl"]) for r in s.scan().filter("lat = 30 AND lon = -10").collect()}
    assert got[D(2021, 2, 1)] == (None, 0.5) and got[D(2021, 1, 30)] == (0.0, None) and len(got) == 5
    assert dict(s.read().dtypes)["lat"] == "float" and s.variables() == ["sst", "chl"]
    assert s.time_coverage() == DateRange("2021-01-30", "2021-03-02") and s.geo_extent() == BBox(-10, 30, 0, 40)
    with pytest.raises(ValueError):
        s.add_data(cube(spark, days(D(2021, 2, 1), 1)).withColumn("lon", F.col("lon") + 100))
    with pytest.raises(ValueError):
        s.add_data(cube(spark, days(D(2021, 2, 1), 1)).drop("lat"))


def test_scans_prune_partitions_and_columns(spark, tmp_path):
    s = CubeStore(spark, str(tmp_path / "s"))
    s.add_data(cube(spark, days(D(2021, 1, 1), 90)).withColumn("chl", F.lit(1.0)))
    df = s.scan(("2021-02-10", "2021-02-20"), BBox(-10, 30, -5, 35), ["sst", "nonsense"])
    assert df.columns == ["time", "lon", "lat", "sst"] and df.count() == 11 * 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "chl" not in plan.split("ReadSchema")[1] and "PartitionFilters: []" not in plan and "PushedFilters: [IsNotNull(time)" in plan
    assert s.scan(["2021-01-05", "2021-03-01", "junk"]).select("time").distinct().count() == 2
    with pytest.raises(ValueError):
        s.scan("2021-01-05")
    assert s.scan(bbox=BBox(-6, 34, -4, 36), padding=5.0).select("lat").distinct().count() == 3


def test_custom_partitions_and_text_times(spark, tmp_path):
    s = CubeStore(spark, str(tmp_path / "s"), ("year", "zone"))
    df = cube(spark, days(D(2021, 1, 1), 2)).withColumn("zone", F.lit("a")).withColumn("time", F.date_format("time", "dd.MM.yyyy"))
    s.add_data(df, fmt="dd.MM.yyyy")
    s.add_data(df.withColumn("sst", F.lit(7.0)), fmt="dd.MM.yyyy")
    assert s.read().filter("sst = 7").count() == 18 == s.read().count()
    with pytest.raises(ValueError):
        s.add_data(df.drop("zone"), fmt="dd.MM.yyyy")


def test_holes_stop_at_a_covered_partition(spark, tmp_path):
    s = CubeStore(spark, str(tmp_path / "s"))
    all_days = days(D(2021, 1, 1), 120)
    holes = {D(2021, 1, 5), D(2021, 3, 7), D(2021, 4, 20)}
    df = cube(spark, all_days).withColumn("other", F.lit(1.0)).withColumn("sst", F.when(~F.col("time").isin(list(holes)), F.col("sst")))
    s.add_data(df)
    assert s.backfill_start(["sst", "other"]) == {"sst": D(2021, 3, 7)}  # February is whole, so January isn't looked at
    assert s.backfill_start(["sst"], {"sst": D(2021, 4, 1)}) == {"sst": D(2021, 4, 20)}
    source = cube(spark, [D(2021, 4, 20), D(2021, 4, 30)], lambda *x: 5)
    assert backfill_window(s, source, "sst") == DateRange("2021-04-20", "2021-04-30")
    assert s.var_coverage_end(["sst", "other"]) == {"sst": D(2021, 4, 30), "other": D(2021, 4, 30)}
    assert {r["column"]: r["first"] for r in s.var_coverage().collect()} == {"sst": D(2021, 1, 1), "other": D(2021, 1, 1)}


def test_updates_append_and_backfill(spark, tmp_path):
    s = CubeStore(spark, str(tmp_path / "s"))
    source = cube(spark, days(D(2021, 5, 1), 31)).withColumn("chl", F.lit(1.0))
    lagging = source.filter("time <= DATE '2021-05-28'").withColumn("chl", F.when(F.col("time") <= "2021-05-26", F.col("chl")))
    s.add_data(lagging)
    assert update(s, source)
    got = s.scan().agg(F.count_distinct("time"), F.count_if(F.col("chl").isNull())).first()
    assert tuple(got) == (31, 0)
    assert update(s, source.withColumn("mld", F.lit(2.0)), variables=["mld"]) and s.scan().filter("mld = 2").count() == 31 * 9
    failures = []
    assert not update(s, source.withColumn("lon", F.col("lon") + 90), "2021-05-01", "2021-05-02", on_error=lambda w, x: failures.append(w))
    assert failures == [DateRange("2021-05-01", "2021-05-02")]


def test_late_files_as_a_stream(spark, tmp_path):
    s = CubeStore(spark, str(tmp_path / "s"))
    s.add_data(cube(spark, days(D(2021, 1, 1), 3)))
    arriving = str(tmp_path / "in")
    late = cube(spark, days(D(2021, 1, 2), 1), lambda *x: 50)
    late.write.parquet(arriving)
    upsert_stream(spark.readStream.schema(late.schema).parquet(arriving), s, str(tmp_path / "c")).awaitTermination()
    assert s.scan().filter("sst = 50").count() == 9 and s.scan().count() == 27


def test_csv_files_by_month(spark, tmp_path):
    df = cube(spark, [D(2021, 1, 1), D(2021, 1, 2), D(2021, 2, 1), D(2022, 3, 15)]).withColumn("ssh", F.lit(float("nan")))
    df = df.withColumn("sst", F.when(F.col("time") != "2021-02-01", F.col("sst")))
    found = files.export_csv(df, str(tmp_path / "csv"))
    names = files.rename_csv(spark, found, str(tmp_path / "out"), "h")
    assert sorted(n.split("/")[-1] for n in names) == ["h_2021-01.csv", "h_2022-03.csv"]  # February has no values
    assert spark.read.option("header", "true").csv(names[0]).count() == 18
    assert files.export_csv(df, str(tmp_path / "csv2"), DateRange("2021-01-01", "2021-12-31"), "day").count() == 2
    with pytest.raises(ValueError):
        files.export_csv(df, str(tmp_path / "csv3"), freq="week")


def test_points_and_results(spark, tmp_path):
    (tmp_path / "p.csv").write_text("time,lon,lat\n2021-01-01,0,30\n2021-01-02,0,30\n")
    p = files.read_points(spark, str(tmp_path / "p.csv"))
    assert sorted(r["row_id"] for r in p.collect()) == [0, 1]
    with pytest.raises(ValueError):
        files.with_key(p.unionByName(p), "row_id")
    with pytest.raises(ValueError):
        files.read_points(spark, "x.txt")
    out = str(tmp_path / "r")
    files.save_results(spark, p.withColumn("a", F.lit(1)), out, "row_id")
    files.save_results(spark, p.select("row_id", F.lit(2).alias("a"), F.lit(3).alias("b")), out, "row_id")
    got = spark.read.option("header", "true").csv(out)
    assert got.count() == 2 and {(r["a"], r["b"], r["lat"]) for r in got.collect()} == {("2", "3", "30")}


def test_raw_files(spark, tmp_path):
    for n in ("a_20210101.nc", "a_20210105-20210107.nc", "b.nc"):
        (tmp_path / n).write_bytes(b"x")
    found = files.list_files(spark, str(tmp_path), "*.nc")
    single = files.file_days(files.keep_names(found, "^a_"), r"_(\d{8})\.")
    assert single.count() == 1
    spans = files.file_days(found, r"(\d{8})-(\d{8})")
    assert [str(r["day"]) for r in spans.orderBy("day").collect()] == ["2021-01-05", "2021-01-06", "2021-01-07"]
    assert files.group_files(spans, "month").first()["month"] == 1
    (tmp_path / "x.bak").write_text("1")
    assert [p.split("/")[-1] for p in files.sweep(spark, str(tmp_path))] == ["x"]


def test_catalogue(spark, tmp_path):
    path = str(tmp_path / "c")
    cube(spark, days(D(2021, 1, 1), 2)).withColumn("chl", F.lit(None).cast("double")).coalesce(1).write.parquet(path)
    r = catalog.scan_files(spark.read.parquet(path)).first()
    assert (r["xmin"], r["ymax"], r["num_timesteps"], r["variables"]) == (-10.0, 40.0, 2, ["sst"])
    assert catalog.read_manifest(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "m.json").write_text(catalog.manifest_json([{"dataset_id": "a", "dataset_type": "rep", "start": D(2020, 1, 1), "end": D(2020, 2, 1)}]))
    assert catalog.read_manifest(spark, str(tmp_path / "m.json")).first()["start"] == "2020-01-01"
    spans = spark.createDataFrame([("a", "rep", D(2020, 1, 1), D(2020, 2, 1)), ("a", "rep", D(2020, 1, 20), D(2020, 3, 1))], catalog.SPAN)
    assert tuple(catalog.merge_provenance(spans).first())[2:] == (D(2020, 1, 1), D(2020, 3, 1))
    assert catalog.window_provenance(spans, "2020-02-10", "2020-02-20").count() == 1


def test_compilation(spark, tmp_path):
    lats = spark.createDataFrame([(32.5,), (35.0,)], "lat double")
    lons = spark.createDataFrame([(-7.5,), (-5.0,)], "lon double")
    target = compiling.Target(lats, lons, sea=spark.createDataFrame([(32.5, -7.5)], "lat double, lon double"))
    sst = cube(spark, days(D(2021, 12, 30), 4), lambda t, i, j: i)
    bathy = cube(spark, [D(2021, 1, 1)], lambda t, i, j: 100 * j, "bathy").drop("time")
    vs = [compiling.Variable("sst", sst, ["sst"]), compiling.Variable("bathy", bathy, ["bathy"]), compiling.Variable("moon", sst, ["moon"])]
    out = compiling.compiled(vs, target, DateRange("2021-12-30", "2022-01-01"))
    r = out.filter("lat = 32.5 AND lon = -7.5 AND time = DATE '2021-12-30'").first()
    assert out.count() == 12 and r["sst"] == pytest.approx(0.5) and r["bathy"] == pytest.approx(50) and r["moon"] > 0
    store = CubeStore(spark, str(tmp_path / "s"))
    assert compiling.compile_into(store, vs, target, DateRange("2021-12-30", "2022-01-05")) and store.scan().count() == 16
    runs = []
    p = compiling.Pipeline({"a": [runs.append], "b": [lambda k: 1 / 0], "c": [runs.append]})
    assert not p.run() and runs == ["a", "c"]
    assert grid.on_grid(target.cells(), spark.createDataFrame([(D(2021, 1, 1),)], "time date")).count() == 4


def test_points_are_numbered_densely(spark):
    p = spark.range(0, 50, 1, 7).select((F.col("id") * 1.5).alias("lon"), F.lit(1.0).alias("a.b")).filter("lon % 2 = 0 OR lon > 30")
    got = files.with_key(p)
    assert got.columns == ["lon", "a.b", "row_id"] and sorted(r["row_id"] for r in got.collect()) == list(range(p.count()))
    assert files.with_key(p.filter("false")).isEmpty()

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions import physics as ph
from tidegrid.functions.time import has_time_of_day, parse_time, season_code, season_code_date
from tidegrid.model import BBox, DateRange
from tidegrid.operators import aggregate, eddies, extract, fronts, grid, join, ocean, window

D = dt.date
LATS, LONS = (30.0, 35.0, 40.0), (-10.0, -5.0, 0.0)


def cube(spark, days, value=lambda t, i, j: t * 9 + i * 3 + j, name="sst"):
    rows = [(d, la, lo, float(value(t, i, j))) for t, d in enumerate(days) for i, la in enumerate(LATS) for j, lo in enumerate(LONS)]
    return spark.createDataFrame(rows, f"time date, lat double, lon double, {name} double")


def test_a_full_year_has_five_seasons(spark):
    days = spark.range(366).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("time"), F.rand(0).alias("sst"))
    codes = [r[0] for r in aggregate.aggregate_by_time(days, ["sst"], "season").collect()]
    assert codes == [20201, 20202, 20203, 20204, 20214]
    dates = spark.createDataFrame([(c,) for c in codes], "c int").select(season_code_date(F.col("c"))).collect()
    assert [r[0] for r in dates] == [D(2020, 3, 1), D(2020, 6, 1), D(2020, 9, 1), D(2020, 12, 1), D(2021, 12, 1)]
    assert spark.range(1).select(season_code(F.lit("2020-12-31").cast("date"))).first()[0] == 20214
    with pytest.raises(ValueError):
        aggregate.aggregate_by_time(days, ["sst"], "hour")


def test_climatology_counts_rows_with_nulls(spark):
    df = cube(spark, [D(2020, 1, 1), D(2021, 1, 1)]).withColumn("sst", F.when(F.year("time") == 2020, F.col("sst")))
    got = aggregate.aggregate_by_space_time(df, ["sst"], "month").filter("lat = 30 AND lon = -10").first()
    assert (got["sst"], got["n"]) == (0.0, 2)


def test_sample_deviation_of_one_row_is_null(spark):
    r = aggregate.aggregate_by_time_stats(cube(spark, [D(2020, 1, 1)]).limit(1), "sst").first()
    assert r["std"] is None and r["min"] == r["max"]


def test_upsert_takes_nulls_and_keeps_old_columns(spark):
    old = cube(spark, [D(2020, 1, 1), D(2020, 1, 2)]).withColumn("chl", F.lit(1.0))
    new = cube(spark, [D(2020, 1, 2), D(2020, 1, 3)]).withColumn("sst", F.lit(None).cast("double"))
    got = {r["time"]: r for r in join.upsert(old, new).filter("lat = 30 AND lon = 0").collect()}
    assert got[D(2020, 1, 1)]["sst"] == 2.0 and got[D(2020, 1, 2)]["sst"] is None and got[D(2020, 1, 2)]["chl"] == 1.0 and got[D(2020, 1, 3)]["chl"] is None
    assert len(got) == 3


def test_replacing_a_window_drops_days_that_new_data_lacks(spark):
    days = [D(2020, 1, d) for d in range(1, 6)]
    old = cube(spark, days).withColumn("chl", F.lit(1.0))
    new = cube(spark, [days[1], days[3]])
    got = {r["time"]: (r["sst"], r["chl"]) for r in join.replace_window(old, new).filter("lat = 30 AND lon = -10").collect()}
    assert got[days[2]] == (None, 1.0) and got[days[1]] == (0.0, 1.0) and got[days[4]] == (36.0, 1.0)
    with pytest.raises(ValueError):
        join.add_variables(old, new)


def test_nearest_step_tie_goes_to_the_later(spark):
    left = spark.createDataFrame([(1, "a", D(2020, 1, 8)), (2, "a", D(2019, 1, 1)), (3, "a", D(2030, 1, 1)), (4, "b", D(2020, 1, 8))], "id int, k string, at date")
    right = spark.createDataFrame([("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 15), 2.0)], "k string, time date, v double")
    got = {r["id"]: r["v"] for r in join.nearest_in_time(left, right, ["k"], "at", "time", ["v"]).collect()}
    assert got == {1: 2.0, 2: 1.0, 3: 2.0, 4: None}


def test_points_get_exact_cells(spark):
    df = cube(spark, [D(2020, 1, 1), D(2020, 1, 2)])
    p = spark.createDataFrame([(1, "2020-01-02", -4.9, 41.0), (2, "2020-01-01", 0.0, 30.0), (3, "2020-05-01", 0.0, 30.0), (4, "2020-01-01", None, 30.0)], "row_id int, time string, lon double, lat double").withColumn("time", F.to_date("time"))
    got = {r["row_id"]: r["sst"] for r in extract.extract_points(p, df, ["sst"], bbox=BBox(-10, 30, 0, 45)).collect()}
    assert got == {1: 16.0, 2: 2.0, 3: None, 4: None}


def test_grid_centres_snapping_and_regridding(spark):
    assert [r[0] for r in grid.centres(spark, 0, 1, 0.25, "x").collect()] == [0.125, 0.375, 0.625, 0.875]
    noisy = spark.createDataFrame([(30.000001, 1.0), (35.00002, 1.00001)], "lat double, lon double")
    assert sorted(r[0] for r in grid.snap(noisy).collect()) == [30.0, 35.0]
    assert sorted(r[1] for r in grid.snap(noisy).collect()) == [1.0, 1.00001]  # rounding would merge these
    rng = np.random.default_rng(0)
    field = rng.random((3, 3))
    df = cube(spark, [D(2020, 1, 1)], lambda t, i, j: field[i, j])
    lats = spark.createDataFrame([(29.0,), (30.0,), (31.0,), (37.5,), (40.0,)], "lat double")
    lons = spark.createDataFrame([(-10.0,), (-7.0,), (0.0,), (1.0,)], "lon double")
    got = {(r["lat"], r["lon"]): r["sst"] for r in grid.regrid_linear(df, ["sst"], lats, lons).collect()}
    assert set(got) == {(a, o) for a in (30.0, 31.0, 37.5, 40.0) for o in (-10.0, -7.0, 0.0)}
    for (a, o), v in got.items():
        i, j = min(int((a - 30) // 5), 1), min(int((o + 10) // 5), 1)
        y, x = (a - LATS[i]) / 5, (o - LONS[j]) / 5
        want = (1 - y) * ((1 - x) * field[i, j] + x * field[i, j + 1]) + y * ((1 - x) * field[i + 1, j] + x * field[i + 1, j + 1])
        assert v == pytest.approx(want)
    holed = df.withColumn("sst", F.when(~((F.col("lat") == 35) & (F.col("lon") == -5)), F.col("sst")))
    got = {(r["lat"], r["lon"]): r["sst"] for r in grid.regrid_linear(holed, ["sst"], lats, lons).collect()}
    assert got[(31.0, -7.0)] is None and got[(30.0, -10.0)] is not None


def test_neighbourhood_deviation_equals_numpy(spark):
    rng = np.random.default_rng(1)
    field = rng.random((3, 3))
    field[1, 2] = np.nan
    df = cube(spark, [D(2020, 1, 1)], lambda t, i, j: field[i, j]).withColumn("sst", ph.missing_to_null(F.col("sst")))
    out = grid.neighbourhood_std(df, "sst", (F.col("lat") - 30) / 5, (F.col("lon") + 10) / 5)
    for r in out.collect():
        i, j = LATS.index(r["lat"]), LONS.index(r["lon"])
        assert r["sst_std"] == pytest.approx(np.nanstd(field[max(0, i - 1) : i + 2, max(0, j - 1) : j + 2]))


def test_coarsen_depths_and_dense(spark):
    assert grid.coarsen_factor(1 / 240, 0.25) == 60
    with pytest.raises(ValueError):
        grid.coarsen_factor(0.1, 0.25)
    df = spark.createDataFrame([(D(2020, 1, 1), 0.0, float(d), 1.0, float(d)) for d in (0, 10, 30)], "time date, lat double, depth double, lon double, o2 double")
    r = grid.depth_columns(df, "o2", [4, 22, 500]).first()
    assert (r["o2_4"], r["o2_22"], r["o2_500"]) == (0.0, 30.0, 30.0)
    assert grid.one_depth(df, 9).first()["o2"] == 10.0
    some = cube(spark, [D(2020, 1, 1), D(2020, 1, 2)]).filter("NOT (lat = 30 AND lon = 0)")
    whole = grid.dense(some.unionByName(cube(spark, [D(2020, 1, 3)])), ["sst"])
    assert whole.count() == 27 and whole.filter("sst IS NULL").count() == 2


def test_radiation_rain_and_energy(spark):
    rows = [(dt.datetime(2020, 1, 1, h), 30.0, -10.0, 3600.0 * h) for h in range(4)]
    df = spark.createDataFrame(rows, "time timestamp, lat double, lon double, ssr double")
    assert [r["rate"] for r in window.rate(df, "ssr").collect()] == [1.0, 1.0, 1.0]
    assert ocean.daily_radiation(df).first()["ssr"] == 1.0
    down = df.withColumn("ssr", -F.col("ssr"))
    assert {r["rate"] for r in window.rate(down, "ssr").collect()} == {0.0}
    rain = spark.createDataFrame([(dt.datetime(2020, 1, 1, h), 30.0, -10.0, 0.001) for h in range(24)], "time timestamp, lat double, lon double, tp double")
    assert ocean.daily_rain(rain).first()["tp"] == pytest.approx(24.0)
    assert ocean.daily_rain(rain.withColumn("tp", F.lit(None).cast("double"))).first()["tp"] == 0.0
    ssh = cube(spark, [D(2020, 1, 1)], name="adt").withColumns({"sla": F.col("adt"), "ugos": F.lit(3.0), "vgos": F.lit(4.0)})
    out = ocean.sea_level(ssh, 30, -10, 5).collect()
    assert {r["gke"] for r in out} == {12.5} and all(r["adt_std"] > 0 for r in out)
    assert ocean.sea_temperature(cube(spark, [D(2020, 1, 1)], lambda *x: 273.15, "analysed_sst"), 30, -10, 5).first()["sst"] == pytest.approx(0.0)


def test_ekman_is_null_at_the_equator_and_wraps(spark):
    rows = [(D(2020, 1, 1), float(la), float(lo), float(lo), 0.0) for la in (0, 10) for lo in range(4)]
    df = spark.createDataFrame(rows, "time date, lat double, lon double, tau_y double, tau_x double")
    got = {(r["lat"], r["lon"]): r for r in ocean.ekman_pumping(df, dlat=10, dlon=1).collect()}
    metre = math.radians(1) * ph.EARTH_M
    assert got[(0.0, 1.0)]["ekman_pumping"] is None
    assert got[(10.0, 1.0)]["curl"] == pytest.approx(1 / (math.cos(math.radians(10)) * metre))
    assert got[(10.0, 0.0)]["curl"] == pytest.approx(-1 / (math.cos(math.radians(10)) * metre))  # (1 - 3) / 2: the far edge is a neighbour


def test_running_windows_count_rows(spark):
    rows = [(D(2020, 1, d), 0.0, 0.0, float(d)) for d in (1, 2, 20)]
    df = spark.createDataFrame(rows, "time date, lat double, lon double, v double")
    got = window.rolling_mean(window.lagged(df, "v", [1]), "v", 2).orderBy("time").collect()
    assert [r["v_roll2"] for r in got] == [1.0, 1.5, 11.0] and [r["v_lag1"] for r in got] == [None, 1.0, 2.0]
    counted = window.event_counts(df.withColumn("v", F.when(F.col("v") > 1, F.col("v"))), F.col("v") > 1, "n", [3]).orderBy("time").collect()
    assert [r["n_3"] for r in counted] == [0, 1, 2]


def test_fronts_of_a_step(spark):
    field = np.where(np.arange(10)[None, :] < 5, 20.0, 10.0).repeat(8, axis=0)
    mask = fronts.front_mask(field, 0.4)
    assert mask[:, 4:6].all() and mask.sum() == 16
    spike = np.zeros((9, 9))
    spike[4, 4] = 5
    assert fronts.extrema(spike, 5)[4, 4] and np.array_equal(fronts.smoothed(spike), spike)
    rows = [(D(2020, 1, 1), float(i), float(j), float(field[i, j]) if (i, j) != (0, 0) else None) for i in range(8) for j in range(10)]
    df = spark.createDataFrame(rows, "time date, lat double, lon double, sst double")
    got = {(r["lat"], r["lon"]): r for r in fronts.front_distance(df, "sst").collect()}
    assert got[(0.0, 0.0)]["sst_fdist"] is None and got[(3.0, 4.0)]["sst_fdist"] == 0
    assert got[(5.0, 9.0)]["sst_fdist"] == pytest.approx(6371 * math.radians(4))


def test_distances_are_flat(spark):
    got = fronts.nearest_km(np.array([0.0, 60.0]), np.array([0.0, 0.0]), np.array([0.0, 60.0]), np.array([1.0, 1.0]))
    assert got[0] == pytest.approx(got[1]) == pytest.approx(111.19, abs=0.01)


def test_eddies_on_a_grid(spark):
    obs = spark.createDataFrame(
        [(dt.datetime(2020, 1, 1, 5), 35.0, 350.0, 7, 3, 50000.0, 40000.0, 0.1, 0.5, "anticyclonic"), (dt.datetime(2020, 1, 1), 39.0, 358.0, 8, 9, 60000.0, 30000.0, 0.2, 0.6, "cyclonic")],
        "time timestamp, latitude double, longitude double, track int, observation_number int, effective_radius double, speed_radius double, amplitude double, speed_average double, kind string",
    )
    some = eddies.prepared(obs, BBox(-10, 30, 0, 40), DateRange("2020-01-01", "2020-01-02"))
    cells = spark.createDataFrame([(la, lo) for la in LATS for lo in LONS], "lat double, lon double")
    got = {(r["lat"], r["lon"]): r for r in eddies.both_kinds(some, cells).collect()}
    r = got[(35.0, -10.0)]
    assert r["ac_dist"] == pytest.approx(0) and r["ac_track"] == 7 and r["c_speedrad_km"] == 30.0 and len(got) == 9
    assert r["c_normdist"] == pytest.approx(r["c_dist"] / 60)


def test_polygons_touch_cells(spark):
    box = extract.box_wkb(-6, 34, -4, 41)
    shapes = spark.createDataFrame([(1, D(2020, 1, 1), bytearray(box)), (2, D(2020, 1, 5), bytearray(box)), (3, D(2020, 1, 1), None)], "row_id int, time date, geometry binary")
    df = cube(spark, [D(2020, 1, 1)])
    got = {r["row_id"]: (r["sst"], r["sst_std"]) for r in extract.extract_polygons(shapes, df, ["sst"], 5.0, std=True).collect()}
    assert got[1][0] == pytest.approx((4 + 7) / 2) and got[1][1] == pytest.approx(1.5) and got[2] == (None, None) and got[3] == (None, None)
    triangle = [[(0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]]
    assert extract.touches(triangle, (1, 1, 2, 2)) and extract.touches(triangle, (-5, -5, 9, 9)) and not extract.touches(triangle, (3, 3, 5, 5))


def test_polygons_on_cells_off_the_whole_steps(spark):
    rows = [(D(2020, 1, 1), 0.125 + 0.25 * i, 0.125 + 0.25 * j, float(10 * i + j)) for i in range(4) for j in range(4)]
    df = spark.createDataFrame(rows, "time date, lat double, lon double, sst double")
    boxes = [(0.05, 0.05, 0.2, 0.2), (0.3, 0.55, 0.45, 0.7), (0.2, 0.2, 0.3, 0.3), (-5, -5, -4, -4)]
    shapes = spark.createDataFrame([(i, D(2020, 1, 1), bytearray(extract.box_wkb(*b))) for i, b in enumerate(boxes)], "row_id int, time date, geometry binary")
    for origin in (None, (0.625, -0.375)):
        got = {r["row_id"]: r["sst"] for r in extract.extract_polygons(shapes, df, ["sst"], 0.25, origin=origin).collect()}
        assert got == {0: 0.0, 1: 21.0, 2: pytest.approx((0 + 1 + 10 + 11) / 4), 3: None}


def test_plateaus_are_extrema():
    field = np.zeros((9, 9))
    field[4, 4] = field[4, 5] = 5  # two equal peaks
    assert fronts.extrema(field, 5)[4, 4:6].all() and fronts.extrema(field, 3)[4, 4:6].all()
    rng = np.random.default_rng(3)
    for _ in range(20):
        field = rng.integers(0, 4, (8, 9)).astype(float)
        for size in (3, 5):
            r = size // 2
            want = np.zeros(field.shape, bool)
            for i in range(r, 8 - r):
                for j in range(r, 9 - r):
                    w = field[i - r : i + r + 1, j - r : j + r + 1]
                    want[i, j] = field[i, j] in (w.max(), w.min())
            assert np.array_equal(fronts.extrema(field, size), want)


def test_text_times(spark):
    df = spark.createDataFrame([("2020-01-01 10:00:00",), ("junk",)], "t string")
    assert [r[0] for r in df.select(parse_time(F.col("t"), "string")).collect()] == [D(2020, 1, 1), None]
    assert not has_time_of_day(df, "t")
    assert has_time_of_day(spark.createDataFrame([("2020-01-01 10:00:00",), ("2020-01-01 11:00:00",)], "t string"), "t")
    with pytest.raises(ValueError):
        parse_time(F.col("t"), "string", "hour")


def test_longitudes_and_the_moon(spark):
    got = spark.createDataFrame([(0.0,), (180.0,), (359.0,)], "x double").select(ph.wrap_longitude(F.col("x"))).collect()
    assert [r[0] for r in got] == [0.0, -180.0, -1.0]
    # full moon 2020-01-10, new moon 2020-01-24
    lit = spark.createDataFrame([(D(2020, 1, 11),), (D(2020, 1, 25),)], "t date").select(ph.moon_illumination(F.col("t"))).collect()
    assert lit[0][0] > 98 and lit[1][0] < 2


def test_cleaning(spark):
    days = [D(2020, 1, 1), D(2020, 1, 2)]
    df = cube(spark, days).withColumn("sst", F.when(F.col("time") == days[0], F.col("sst")).otherwise(float("nan")))
    assert ocean.clean_steps(df.unionByName(df), ["sst"]).count() == 9
    assert ocean.non_negative("sst")(cube(spark, days, lambda *x: -1)).first()["sst"] == 0
    assert ocean.lyapunov(spark.createDataFrame([(days[0], 0.0, 350.0, 1.0)], "time date, lat double, lon double, fsle_max double")).first()["lon"] == -10.0


def test_distance_on_a_grid_is_that_of_all_pairs():
    rng = np.random.default_rng(5)
    for shape, share in (((7, 12), 0.1), ((30, 25), 0.02), ((1, 9), 0.3), ((9, 1), 0.3)):
        lats, lons = np.sort(rng.uniform(-80, 80, shape[0])), np.sort(rng.uniform(-180, 180, shape[1]))
        marked = rng.random(shape) < share
        marked[0, 0] = True
        i, j = np.nonzero(marked)
        la, lo = (a.ravel() for a in np.meshgrid(lats, lons, indexing="ij"))
        want = fronts.nearest_km(la, lo, lats[i], lons[j]).reshape(shape)
        assert np.allclose(fronts.nearest_on_grid(marked, lats, lons), want, rtol=1e-12)
    assert np.isnan(fronts.nearest_on_grid(np.zeros((2, 3), bool), np.arange(2.0), np.arange(3.0))).all()


def test_land_has_no_front_distance_and_sea_without_a_value_has(spark):
    rows = [(D(2020, 1, 1), float(i), float(j), None if j == 9 else 20.0 if j < 5 else 10.0) for i in range(8) for j in range(10)]
    df = spark.createDataFrame(rows, "time date, lat double, lon double, sst double")
    sea = df.filter("lon > 1").select("lat", "lon")
    got = {(r["lat"], r["lon"]): r["sst_fdist"] for r in fronts.front_distance(df, "sst", sea=sea).collect()}
    assert got[(3.0, 0.0)] is None and got[(3.0, 9.0)] == 0 and got[(3.0, 2.0)] == pytest.approx(6371 * math.radians(2))
    with pytest.raises(ValueError):
        fronts.front_distance(df, "mld")


def test_nearest_steps_across_stretches(spark):
    rng = np.random.default_rng(3)
    left = [(i, "ab"[i % 2], D(2020, 1, 1) + dt.timedelta(days=int(rng.integers(0, 900)))) for i in range(200)] + [(900, "a", None), (901, "c", D(2020, 1, 1)), (902, None, D(2020, 5, 1))]
    right = [("ab"[i % 2], D(2020, 1, 1) + dt.timedelta(days=int(x)), float(i)) for i, x in enumerate(rng.choice(900, 24, replace=False))] + [("a", None, -1.0)]
    l, r = spark.createDataFrame(left, "id int, k string, at date"), spark.createDataFrame(right, "k string, time date, v double")
    want = {}
    for i, k, at in left:
        near = [(abs((t - at).days), -t.toordinal(), v) for kk, t, v in right if at and t and kk == k]
        want[i] = min(near)[2] if near else None
    for days in (7, 30, 5000):
        assert {x["id"]: x["v"] for x in join.nearest_in_time(l, r, ["k"], "at", "time", ["v"], days).collect()} == want


def test_long_axes_meet_targets_in_a_window(spark, monkeypatch):
    nodes = spark.createDataFrame([(float(x),) for x in (0, 2, 3, 7)], "lat double")
    targets = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 1.0, 2.4, 2.5, 6.0, 7.0, 9.0)], "lat double")
    short = sorted(map(tuple, grid.nearest_node(nodes, targets, "lat").collect()))
    monkeypatch.setattr(grid, "AXIS_NODES", 2)
    assert sorted(map(tuple, grid.nearest_node(nodes, targets, "lat").collect())) == short == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0), (2.4, 2.0), (2.5, 2.0), (6.0, 7.0), (7.0, 7.0), (9.0, 7.0)]


def test_groups_of_variables(spark):
    assert sorted(ocean.PROCESSORS) == ["atm-accum-avg", "atm-instante", "chl", "fsle", "mld", "radiation", "ssh", "sst", "waves"]
    hours = [(dt.datetime(2020, 1, d, h), 30.0, -10.0, 3.0, 4.0, 0.25 * h, 100000.0) for d in (1, 2) for h in range(3)]
    got = ocean.PROCESSORS["atm-instante"](spark.createDataFrame(hours, "time timestamp, lat double, lon double, u10 double, v10 double, tcc double, msl double")).orderBy("time").collect()
    assert len(got) == 2 and (got[0]["wind_speed"], got[0]["tcc"], got[0]["msl"]) == (5.0, 0.25, 1000.0)
    sst = ocean.PROCESSORS["sst"](cube(spark, [D(2020, 1, 1)], lambda t, i, j: 280.0 + 5 * j, "analysed_sst"), 30, -10, 5)
    assert {"sst", "sst_std", "sst_fdist"} <= set(sst.columns) and sst.count() == 9
    assert {"chl", "chl_fdist"} <= set(ocean.PROCESSORS["chl"](cube(spark, [D(2020, 1, 1)], name="CHL")).columns)


def test_accumulated_variables_start_with_full_windows(spark):
    stress = cube(spark, [D(2020, 1, d) for d in (8, 9)], lambda t, i, j: t + i * j, "tau_x").withColumns({"tau_y": F.col("lon") * 2, "tp": F.lit(0.001)})
    pump = ocean.ekman_pumping(stress, dlat=5, dlon=5)
    before = cube(spark, [D(2020, 1, d) for d in range(1, 9)], lambda *x: 1.0, "ekman_pumping")
    cells = before.select("lat", "lon").distinct()
    clim = cells.crossJoin(spark.range(1, 20).select(F.col("id").cast("int").alias("dayofyear"))).withColumn("ekman_pumping", F.lit(0.5))
    p90 = cells.withColumns({"month": F.lit(1), "ekman_pumping": F.lit(0.25)})
    sea = cells.filter("lat > 30")
    got = {(r["time"].day, r["lat"], r["lon"]): r for r in ocean.PROCESSORS["atm-accum-avg"](stress, clim, p90, before, sea, dlat=5, dlon=5).collect()}
    own = {(r["time"].day, r["lat"], r["lon"]): r["ekman_pumping"] for r in pump.collect()}
    assert len(got) == 18
    for (day, lat, lon), r in got.items():
        smooth = ((6 if day == 8 else 5) + sum(own[(x, lat, lon)] for x in range(8, day + 1))) / 7
        assert r["tp"] == pytest.approx(1.0) and r["ekman_pumping"] == own[(day, lat, lon)]
        if lat == 30:
            assert r["ekman_7d"] is None and r["n_upwell_events_3d"] is None
        else:
            assert r["ekman_7d"] == pytest.approx(smooth) and r["ekman_anom"] == pytest.approx(smooth - 0.5)
            assert r["ekman_anom_lag3"] == pytest.approx(0.5) and r["n_upwell_events_3d"] == (3 if day == 8 else 2)  # 6 / 7 and 5 / 7, less 0.5

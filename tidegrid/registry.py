"""Registered queries of the engine and the SQL that gives the same rows.

The driver's tables are projected onto cubes: `cube` has a cell for each (day, supplier mod 10, part
mod 10) of lineitem, `points` are orders, `obs` are events. Doubles are rounded to six places on
both sides, as sums of doubles depend on their order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions import physics as ph
from tidegrid.functions.time import season, season_code, season_code_date
from tidegrid.model import BBox, DateRange
from tidegrid.operators import aggregate, extract, fronts, grid, join, ocean, window
from tidegrid.plans import plots
from tidegrid.session import checkpoints
from tidegrid.sources import catalog, files

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

CUBE_SQL = """cube AS (
  SELECT CAST(l_shipdate AS DATE) AS time, CAST(l_suppkey % 10 AS DOUBLE) AS lat, CAST(l_partkey % 10 AS DOUBLE) AS lon,
         avg(l_quantity) AS v1, avg(l_discount) AS v2
  FROM lineitem GROUP BY 1, 2, 3)"""
OBS_SQL = "obs AS (SELECT ts AS time, CAST(user_id % 7 AS DOUBLE) AS lat, CAST(user_id % 11 AS DOUBLE) AS lon, user_id, event_id, event_type AS kind, value FROM events)"
POINTS_SQL = "points AS (SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS time, CAST(o_custkey % 10 AS DOUBLE) + 0.25 AS lat, CAST(o_custkey % 10 AS DOUBLE) + 0.25 AS lon FROM orders)"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem")
    return l.groupBy(F.to_date("l_shipdate").alias("time"), (F.col("l_suppkey") % 10).cast("double").alias("lat"), (F.col("l_partkey") % 10).cast("double").alias("lon")).agg(
        F.avg("l_quantity").alias("v1"), F.avg("l_discount").alias("v2")
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(F.col("ts").alias("time"), (F.col("user_id") % 7).cast("double").alias("lat"), (F.col("user_id") % 11).cast("double").alias("lon"), "user_id", "event_id", F.col("event_type").alias("kind"), "value")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = (F.col("o_custkey") % 10).cast("double") + 0.25
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.to_date("o_orderdate").alias("time"), c.alias("lat"), c.alias("lon"))


_STORES: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str):
    """A store of the cube, written once a session; it keeps floats."""
    import uuid

    from tidegrid.sources.store import CubeStore

    key = (spark.sparkContext.applicationId, sf_dir)
    store = CubeStore(spark, _STORES.get(key) or f"{checkpoints(spark)}/cube-{uuid.uuid4().hex}")
    if key not in _STORES:
        store.add_data(cube(spark, sf_dir))
        _STORES[key] = store.path
    return store


def doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n, t in df.dtypes if t == "float"})


def r6(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def rounded(x: Column, places: int) -> Column:
    """round() as the SQL has it: the product is rounded, half away from zero; Spark's rounds the shortest decimal of x."""
    y = x * 10.0**places
    whole = F.rint(y)
    whole = F.when((y > 0) & (y - whole == 0.5), whole + 1).when((y < 0) & (y - whole == -0.5), whole - 1).otherwise(whole)
    return F.when(F.abs(y) < float("inf"), whole / 10.0**places).otherwise(x)


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


# -- scans, filters, casts -------------------------------------------------------------------------


@query(f"WITH {CUBE_SQL} SELECT time, lat, lon, CAST(CAST(v1 AS FLOAT) AS DOUBLE) AS v1 FROM cube WHERE time BETWEEN DATE '1996-01-01' AND DATE '1997-06-30' AND lon BETWEEN 2 AND 6 AND lat BETWEEN 1 AND 4")
def scan_range(spark, d):
    return doubles(stored(spark, d).scan(("1996-01-01", "1997-06-30"), BBox(2, 1, 6, 4), ["v1"]))


@query(f"WITH {CUBE_SQL} SELECT time, lat, lon, CAST(CAST(v1 AS FLOAT) AS DOUBLE) AS v1 FROM cube WHERE time IN (DATE '1996-01-01', DATE '1996-02-29', DATE '2000-12-31')")
def scan_days(spark, d):
    return doubles(stored(spark, d).scan(["1996-01-01", "1996-02-29", "2000-12-31"], columns=["v1"]))


@query(f"WITH {CUBE_SQL} SELECT time, lat, lon, CAST(CAST(v2 AS FLOAT) AS DOUBLE) AS v2 FROM cube WHERE time = DATE '1998-03-05' AND lon BETWEEN 1 AND 7 AND lat BETWEEN 0 AND 5")
def scan_padded_box(spark, d):
    return doubles(stored(spark, d).scan(["1998-03-05"], BBox(2, 1, 6, 4), ["v2"], padding=1.0))


@query(f"WITH {CUBE_SQL} SELECT year(time) AS year, month(time) AS month, count(*) AS n, count(v1) AS n_v1 FROM cube GROUP BY 1, 2")
def partition_sizes(spark, d):
    return stored(spark, d).partition_sizes(["v1"])


@query("SELECT min(least(l_suppkey % 10, l_partkey % 10)) AS low, max(greatest(l_suppkey % 10, l_partkey % 10)) AS high, CAST(min(l_shipdate) AS DATE) AS start, CAST(max(l_shipdate) AS DATE) AS stop FROM lineitem")
def extent(spark, d):
    store = stored(spark, d)
    days, box = store.time_coverage(), store.geo_extent()
    return spark.createDataFrame([(int(min(box.xmin, box.ymin)), int(max(box.xmax, box.ymax)), days.start, days.end)], "low long, high long, start date, stop date")


# -- aggregates ------------------------------------------------------------------------------------


@query(f"WITH {CUBE_SQL} SELECT CAST(date_trunc('month', time) AS DATE) AS time_agg, round(avg(v1), 6) AS v1, round(avg(v2), 6) AS v2 FROM cube GROUP BY 1")
def agg_month(spark, d):
    return r6(aggregate.aggregate_by_time(cube(spark, d), ["v1", "v2"], "month"), "v1", "v2")


@query(f"WITH {CUBE_SQL} SELECT time AS time_agg, round(avg(v1), 6) AS v1 FROM cube GROUP BY 1")
def agg_day(spark, d):
    return r6(aggregate.aggregate_by_time(cube(spark, d), ["v1"], "day"), "v1")


@query(f"WITH {CUBE_SQL} SELECT CAST(date_trunc('year', time) AS DATE) AS time_agg, round(avg(v1), 6) AS v1 FROM cube GROUP BY 1")
def agg_year(spark, d):
    return r6(aggregate.aggregate_by_time(cube(spark, d), ["v1"], "year"), "v1")


@query(
    f"WITH {CUBE_SQL} SELECT CAST(date_trunc('week', time) AS DATE) AS time_agg, round(avg(v1), 6) AS mean, round(stddev_samp(v1), 6) AS std, min(v1) AS min, max(v1) AS max FROM cube GROUP BY 1"
)
def agg_week_stats(spark, d):
    return r6(aggregate.aggregate_by_time_stats(cube(spark, d), "v1", "week"), "mean", "std")


_CODE = "CAST((year(time) + CASE WHEN month(time) = 12 THEN 1 ELSE 0 END) * 10 + CASE WHEN month(time) IN (3, 4, 5) THEN 1 WHEN month(time) IN (6, 7, 8) THEN 2 WHEN month(time) IN (9, 10, 11) THEN 3 ELSE 4 END AS INTEGER)"
_SEASON = "CASE WHEN month(time) IN (12, 1, 2) THEN 'winter' WHEN month(time) IN (3, 4, 5) THEN 'spring' WHEN month(time) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"


@query(f"WITH {CUBE_SQL} SELECT {_CODE} AS time_agg, round(avg(v1), 6) AS v1 FROM cube GROUP BY 1")
def agg_season(spark, d):
    return r6(aggregate.aggregate_by_time(cube(spark, d), ["v1"], "season"), "v1")


@query(f"WITH {CUBE_SQL} SELECT lat, lon, CAST(month(time) AS INTEGER) AS month, round(avg(v1), 6) AS v1, count(*) AS n FROM cube GROUP BY 1, 2, 3")
def clim_month(spark, d):
    return r6(aggregate.aggregate_by_space_time(cube(spark, d), ["v1"], "month"), "v1")


@query(f"WITH {CUBE_SQL} SELECT lat, lon, {_SEASON} AS season, round(avg(v1), 6) AS v1, count(*) AS n FROM cube GROUP BY 1, 2, 3")
def clim_season(spark, d):
    return r6(aggregate.aggregate_by_space_time(cube(spark, d), ["v1"], "season"), "v1")


@query(f"WITH {CUBE_SQL} SELECT lat, lon, CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month, round(avg(v1), 6) AS v1, count(*) AS n FROM cube GROUP BY 1, 2, 3, 4")
def clim_month_year(spark, d):
    return r6(aggregate.aggregate_by_space_time(cube(spark, d), ["v1"], "month_year"), "v1")


@query(
    f"WITH {OBS_SQL} SELECT CAST(time AS DATE) AS time, lat, lon, round(avg(sqrt(value * value + 9)), 6) AS wind_speed, round(stddev_pop(sqrt(value * value + 9)), 6) AS wind_speed_std, "
    "round(max(sqrt(value * value + 9)), 6) AS wind_speed_max, round(avg(value), 6) AS u10, 3.0::DOUBLE AS v10 FROM obs GROUP BY 1, 2, 3"
)
def daily_wind(spark, d):
    o = obs(spark, d).withColumnRenamed("value", "u10").withColumn("v10", F.lit(3.0))
    return r6(ocean.daily_wind(o), "wind_speed", "wind_speed_std", "wind_speed_max", "u10")


@query(f"WITH {OBS_SQL} SELECT CAST(time AS DATE) AS time, lat, lon, round(coalesce(sum(CASE WHEN value > 20 THEN value * 1000 END), 0), 4) AS tp FROM obs GROUP BY 1, 2, 3")
def daily_rain(spark, d):
    o = obs(spark, d).withColumn("tp", F.when(F.col("value") > 20, F.col("value")))
    return ocean.daily_rain(o).withColumn("tp", F.round("tp", 4))


@query(f"WITH {OBS_SQL} SELECT CAST(time AS DATE) AS time, lat, lon, round(avg(value * 0.01), 10) AS msl FROM obs GROUP BY 1, 2, 3")
def daily_pressure(spark, d):
    return ocean.daily_pressure(obs(spark, d).withColumnRenamed("value", "msl")).withColumn("msl", F.round("msl", 10))


@query(f"WITH {OBS_SQL} SELECT CAST(time AS DATE) AS time, lat, lon, round(avg(value), 6) AS swh, round(avg(value * 2), 6) AS mwd FROM obs GROUP BY 1, 2, 3")
def daily_waves(spark, d):
    o = obs(spark, d).withColumnRenamed("value", "swh").withColumn("mwd", F.col("swh") * 2)
    return r6(ocean.daily_waves(o), "swh", "mwd")


@query(f"WITH {CUBE_SQL} SELECT CAST(month(time) AS INTEGER) AS month, lat, lon, round(quantile_cont(v1, 0.9), 6) AS v1 FROM cube GROUP BY 1, 2, 3")
def month_p90(spark, d):
    return r6(aggregate.monthly_quantile(cube(spark, d), "v1"), "v1")


@query(
    f"WITH {CUBE_SQL}, s AS (SELECT time, lat, lon, avg(v1) OVER (PARTITION BY lat, lon ORDER BY time ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s FROM cube WHERE year(time) BETWEEN 1996 AND 1999) "
    "SELECT CAST(dayofyear(time) AS INTEGER) AS dayofyear, lat, lon, round(avg(s), 6) AS v1 FROM s WHERE NOT (month(time) = 2 AND day(time) = 29) GROUP BY 1, 2, 3"
)
def doy_climatology(spark, d):
    return r6(aggregate.doy_climatology(cube(spark, d), "v1", 1996, 1999), "v1")


@query(
    f"WITH {CUBE_SQL}, m AS (SELECT time, CASE WHEN v1 > 25 THEN v1 END AS a, CASE WHEN time < DATE '1999-01-01' THEN v2 END AS b, CAST(NULL AS DOUBLE) AS c FROM cube) "
    "SELECT 'a' AS \"column\", min(time) AS first, max(time) AS last FROM m WHERE a IS NOT NULL UNION ALL SELECT 'b', min(time), max(time) FROM m WHERE b IS NOT NULL"
)
def var_coverage(spark, d):
    c = cube(spark, d).select("time", F.when(F.col("v1") > 25, F.col("v1")).alias("a"), F.when(F.col("time") < "1999-01-01", F.col("v2")).alias("b"), F.lit(None).cast("double").alias("c"))
    return aggregate.coverage(c, ["a", "b", "c"])


@query(
    f"WITH {CUBE_SQL}, m AS (SELECT CASE WHEN v1 > 25 THEN v1 END AS a, v2 AS b FROM cube) "
    "SELECT 'a' AS \"column\", count(*) AS rows, count(*) - count(a) AS nulls FROM m UNION ALL SELECT 'b', count(*), count(*) - count(b) FROM m"
)
def null_summary(spark, d):
    return aggregate.null_summary(cube(spark, d).select(F.when(F.col("v1") > 25, F.col("v1")).alias("a"), F.col("v2").alias("b")), ["a", "b"])


_HOLED = "h AS (SELECT time, CASE WHEN NOT (year(time) = 2001 AND month(time) IN (3, 8) AND day(time) = 5) AND year(time) > 1995 THEN v1 END AS x FROM cube)"


def _holed(spark, d) -> DataFrame:
    out = (F.year("time") == 2001) & F.month("time").isin(3, 8) & (F.dayofmonth("time") == 5)
    return cube(spark, d).select("time", "lat", "lon", F.when(~out & (F.year("time") > 1995), F.col("v1")).alias("x"))


@query(
    f"WITH {CUBE_SQL}, {_HOLED}, days AS (SELECT year(time) AS p, time, count(x) AS n FROM h GROUP BY 1, 2), parts AS (SELECT p, min(CASE WHEN n = 0 THEN time END) AS hole FROM days GROUP BY 1), "
    "run AS (SELECT *, max(CASE WHEN hole IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS closed FROM parts) SELECT 'x' AS \"column\", min(hole) AS start FROM run WHERE closed = 0"
)
def backfill_start(spark, d):
    return window.newest_covered(_holed(spark, d), ["x"], F.year("time"))


@query(f"WITH {CUBE_SQL}, {_HOLED} SELECT DISTINCT time AS day FROM cube WHERE v1 IS NOT NULL AND time NOT IN (SELECT time FROM h WHERE x IS NOT NULL)")
def fillable_holes(spark, d):
    return join.fillable_days(cube(spark, d).withColumnRenamed("v1", "x"), _holed(spark, d), "x")


# -- windows ---------------------------------------------------------------------------------------


@query(
    f"WITH {CUBE_SQL} SELECT time, lat, lon, round(avg(v1) OVER (PARTITION BY lat, lon ORDER BY time ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS v1_roll7, "
    "lag(v1, 3) OVER w AS v1_lag3, lag(v1, 7) OVER w AS v1_lag7, lag(v1, 14) OVER w AS v1_lag14 FROM cube WINDOW w AS (PARTITION BY lat, lon ORDER BY time)"
)
def roll7_lags(spark, d):
    return r6(window.lagged(window.rolling_mean(cube(spark, d), "v1"), "v1").drop("v1", "v2"), "v1_roll7")


@query(
    f"WITH {CUBE_SQL} SELECT time, lat, lon, sum(CASE WHEN v1 > 30 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS events_3, "
    "sum(CASE WHEN v1 > 30 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS events_7 FROM cube WINDOW w AS (PARTITION BY lat, lon ORDER BY time)".replace(
        "(w ROWS", "(PARTITION BY lat, lon ORDER BY time ROWS"
    ).replace(" WINDOW w AS (PARTITION BY lat, lon ORDER BY time)", "")
)
def event_counts(spark, d):
    return window.event_counts(cube(spark, d), F.col("v1") > 30, "events", (3, 7)).drop("v1", "v2")


@query(
    f"WITH {OBS_SQL}, s AS (SELECT user_id, time, max(value) AS value FROM obs GROUP BY 1, 2), r AS (SELECT user_id, time, (value - lag(value) OVER (PARTITION BY user_id ORDER BY time)) / "
    "((epoch_us(time) - lag(epoch_us(time)) OVER (PARTITION BY user_id ORDER BY time)) / 1000000.0) AS rate, lag(time) OVER (PARTITION BY user_id ORDER BY time) AS b FROM s) "
    "SELECT user_id, time, round(CASE WHEN rate >= -1e-6 THEN rate ELSE 0 END, 9) AS rate FROM r WHERE b IS NOT NULL"
)
def accumulated_rate(spark, d):
    o = obs(spark, d).groupBy("user_id", "time").agg(F.max("value").alias("value"))
    return window.rate(o, "value", keys=["user_id"]).select("user_id", "time", rounded(F.col("rate"), 9).alias("rate"))


@query(
    f"WITH {CUBE_SQL}, a AS (SELECT lat, lon, avg(v1) AS v FROM cube GROUP BY 1, 2), e AS (SELECT x.lat, x.lon, (n.v - p.v) / 2 AS dv FROM a x JOIN a n ON n.lat = x.lat AND n.lon = (x.lon + 1) % 10 JOIN a p ON p.lat = x.lat AND p.lon = (x.lon + 9) % 10) "
    "SELECT lat, lon, round(dv, 6) AS dv FROM e"
)
def centred_difference_wrapped(spark, d):
    a = cube(spark, d).groupBy("lat", "lon").agg(F.avg("v1").alias("v"))
    return r6(window.centred_difference(a, "v", "lon", ["lat"], "dv").drop("v"), "dv")


@query(
    f"WITH {CUBE_SQL}, t AS (SELECT time, lat + 30 AS lat, lon, v1 AS x, v2 AS y, row_number() OVER (PARTITION BY time, lat ORDER BY lon) AS k, count(*) OVER (PARTITION BY time, lat) AS n, "
    "row_number() OVER (PARTITION BY time, lon ORDER BY lat) AS kk, count(*) OVER (PARTITION BY time, lon) AS nn FROM cube), "
    "g AS (SELECT t.time, t.lat, t.lon, (a.y - b.y) / 2 AS dy, (c.x - e.x) / 2 AS dx FROM t JOIN t a ON a.time = t.time AND a.lat = t.lat AND a.k = t.k % t.n + 1 JOIN t b ON b.time = t.time AND b.lat = t.lat AND b.k = (t.k + t.n - 2) % t.n + 1 "
    "JOIN t c ON c.time = t.time AND c.lon = t.lon AND c.kk = t.kk % t.nn + 1 JOIN t e ON e.time = t.time AND e.lon = t.lon AND e.kk = (t.kk + t.nn - 2) % t.nn + 1), "
    "u AS (SELECT *, dy / (cos(radians(lat)) * radians(6371000.0)) - dx / radians(6371000.0) AS curl FROM g) "
    "SELECT time, lat, lon, round(curl * 1e6, 6) AS curl, round(curl / (1025.0 * 2 * 7.2921159e-5 * sin(radians(lat))) * 1e6, 4) AS ekman_pumping FROM u"
)
def ekman_pumping(spark, d):
    t = cube(spark, d).select("time", (F.col("lat") + 30).alias("lat"), "lon", F.col("v1").alias("tau_x"), F.col("v2").alias("tau_y"))
    out = ocean.ekman_pumping(t, dlat=1.0, dlon=1.0)
    return out.select("time", "lat", "lon", F.round(F.col("curl") * 1e6, 6).alias("curl"), F.round(F.col("ekman_pumping") * 1e6, 4).alias("ekman_pumping"))


_EKMAN = (
    f"WITH {CUBE_SQL}, s AS (SELECT *, avg(v1) OVER (PARTITION BY lat, lon ORDER BY time ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS smooth FROM cube), "
    "c AS (SELECT dayofyear(time) AS k, lat, lon, avg(smooth) AS clim FROM s WHERE NOT (month(time) = 2 AND day(time) = 29) GROUP BY 1, 2, 3), q AS (SELECT month(time) AS k, lat, lon, quantile_cont(v1, 0.9) - 25 AS p90 FROM cube GROUP BY 1, 2, 3), "
    "a AS (SELECT s.time, s.lat, s.lon, s.smooth, round(s.smooth - c.clim, 6) + 0.0 AS anomaly, s.smooth - c.clim > q.p90 AS over FROM s LEFT JOIN c ON c.k = dayofyear(s.time) AND c.lat = s.lat AND c.lon = s.lon LEFT JOIN q ON q.k = month(s.time) AND q.lat = s.lat AND q.lon = s.lon) "
)


@query(
    _EKMAN + "SELECT time, lat, lon, round(smooth, 6) AS smooth, anomaly, "
    + ", ".join(f"lag(anomaly, {n}) OVER (PARTITION BY lat, lon ORDER BY time) AS anomaly_lag{n}, CAST(sum(CASE WHEN over THEN 1 ELSE 0 END) OVER (PARTITION BY lat, lon ORDER BY time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS events_{n}" for n in (3, 7, 14))
    + " FROM a"
)
def ekman_features(spark, d):
    c = cube(spark, d)
    clim = aggregate.doy_climatology(c, "v1", 1900, 2100)
    p90 = aggregate.monthly_quantile(c, "v1").withColumn("v1", F.col("v1") - 25)
    out = ocean.ekman_features(c, clim, p90, "v1")
    return r6(out.drop("v1", "v2"), "smooth", "anomaly", *[f"anomaly_lag{n}" for n in (3, 7, 14)])


# -- joins -----------------------------------------------------------------------------------------

_HALVES = "o AS (SELECT time, lat, lon, v1, v2 FROM cube WHERE time < DATE '1999-01-01'), n AS (SELECT time, lat, lon, CASE WHEN v1 > 10 THEN v1 + 1 END AS v1, v2 AS v3 FROM cube WHERE time >= DATE '1998-06-01' AND lat < 5)"


def _halves(spark, d) -> tuple[DataFrame, DataFrame]:
    c = cube(spark, d)
    new = c.filter("time >= DATE '1998-06-01' AND lat < 5").select("time", "lat", "lon", F.when(F.col("v1") > 10, F.col("v1") + 1).alias("v1"), F.col("v2").alias("v3"))
    return c.filter("time < DATE '1999-01-01'"), new


@query(
    f"WITH {CUBE_SQL}, {_HALVES} SELECT time, lat, lon, CASE WHEN n.f THEN n.v1 ELSE o.v1 END AS v1, round(o.v2, 6) AS v2, round(n.v3, 6) AS v3 FROM o FULL JOIN (SELECT *, TRUE AS f FROM n) n USING (time, lat, lon)"
)
def upsert(spark, d):
    return r6(join.upsert(*_halves(spark, d)), "v2", "v3")


@query(
    f"WITH {CUBE_SQL}, {_HALVES}, s AS (SELECT min(time) AS a, max(time) AS b FROM n), f AS (SELECT time, lat, lon, v1, NULL AS v3 FROM o, s WHERE time NOT BETWEEN a AND b UNION ALL SELECT time, lat, lon, v1, v3 FROM n) "
    "SELECT time, lat, lon, f.v1, round(f.v3, 6) AS v3, round(o.v2, 6) AS v2 FROM f FULL JOIN (SELECT time, lat, lon, v2 FROM o) o USING (time, lat, lon)"
)
def replace_window(spark, d):
    return r6(join.replace_window(*_halves(spark, d)), "v2", "v3")


@query(f"WITH {CUBE_SQL} SELECT time, lat, lon, v1, round(v2, 6) AS v2 FROM (SELECT time, lat, lon, v1 FROM cube WHERE lat < 6) a FULL JOIN (SELECT time, lat, lon, v2 FROM cube WHERE lon > 3) b USING (time, lat, lon)")
def add_variables(spark, d):
    c = cube(spark, d)
    return r6(join.add_variables(c.filter("lat < 6").drop("v2"), c.filter("lon > 3").drop("v1")), "v2")


@query(
    f"WITH {CUBE_SQL} SELECT time, lat, lon, a.v1, round(b.v2, 6) AS v2, c.v3 FROM (SELECT time, lat, lon, v1 FROM cube WHERE lat < 6) a FULL JOIN (SELECT time, lat, lon, v2 FROM cube WHERE lon > 3) b USING (time, lat, lon) "
    "FULL JOIN (SELECT time, lat, lon, v1 * 2 AS v3 FROM cube WHERE year(time) = 1997) c USING (time, lat, lon)"
)
def compile_outer_merge(spark, d):
    c = cube(spark, d)
    parts = [c.filter("lat < 6").drop("v2"), c.filter("lon > 3").drop("v1"), c.filter("year(time) = 1997").select("time", "lat", "lon", (F.col("v1") * 2).alias("v3"))]
    return r6(join.outer_merge(parts), "v2")


@query(
    f"WITH {CUBE_SQL}, g AS (SELECT lat, lon, time, v1 FROM cube), p AS (SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS at, CAST(o_custkey % 10 AS DOUBLE) AS lat, CAST(o_custkey // 10 % 10 AS DOUBLE) AS lon FROM orders), "
    "b AS (SELECT p.*, g.time, g.v1 FROM p ASOF LEFT JOIN g ON p.lat = g.lat AND p.lon = g.lon AND p.at >= g.time), a AS (SELECT p.row_id, g.time, g.v1 FROM p ASOF LEFT JOIN g ON p.lat = g.lat AND p.lon = g.lon AND p.at <= g.time) "
    "SELECT b.row_id, CASE WHEN a.time IS NOT NULL AND (b.time IS NULL OR a.time - b.at <= b.at - b.time) THEN a.time ELSE b.time END AS matched, CASE WHEN a.time IS NOT NULL AND (b.time IS NULL OR a.time - b.at <= b.at - b.time) THEN a.v1 ELSE b.v1 END AS v1 FROM b JOIN a USING (row_id)"
)
def asof_nearest(spark, d):
    p = read(spark, d, "orders").select(F.col("o_orderkey").alias("row_id"), F.to_date("o_orderdate").alias("at"), (F.col("o_custkey") % 10).cast("double").alias("lat"), (F.expr("o_custkey div 10") % 10).cast("double").alias("lon"))
    out = join.nearest_in_time(p, cube(spark, d), ["lat", "lon"], "at", "time", ["v1"])
    return out.select("row_id", F.to_date("matched_time").alias("matched"), "v1")


@query(
    f"WITH {CUBE_SQL}, {POINTS_SQL}, g AS (SELECT * FROM cube WHERE lat % 2 = 0 AND lon % 3 = 0), e AS (SELECT min(time) AS a, max(time) AS b FROM g), t AS (SELECT DISTINCT time FROM g), "
    "n AS (SELECT p.time AS at, arg_min(t.time, abs(t.time - p.time) * 2 - CASE WHEN t.time > p.time THEN 1 ELSE 0 END) AS time FROM (SELECT DISTINCT time FROM points) p, t GROUP BY 1), "
    "x AS (SELECT p.*, CASE WHEN p.time BETWEEN e.a AND e.b AND p.lat <= 8 THEN n.time END AS gt, CASE WHEN p.lat < 1 THEN 0 WHEN p.lat <= 3 THEN 2 WHEN p.lat <= 5 THEN 4 WHEN p.lat <= 7 THEN 6 ELSE 8 END AS glat, "
    "CASE WHEN p.lon <= 1.5 THEN 0 WHEN p.lon <= 4.5 THEN 3 WHEN p.lon <= 7.5 THEN 6 ELSE 9 END AS glon FROM points p LEFT JOIN n ON n.at = p.time CROSS JOIN e) "
    "SELECT x.row_id, x.time, x.lat, x.lon, g.v1 FROM x LEFT JOIN g ON g.time = x.gt AND g.lat = x.glat AND g.lon = x.glon"
)
def extract_points(spark, d):
    g = cube(spark, d).filter("lat % 2 = 0 AND lon % 3 = 0")  # a coarser grid, so that points are not on it
    return extract.extract_points(points(spark, d), g, ["v1"])


@query(f"WITH {CUBE_SQL}, m AS (SELECT month(time) AS k, lat, lon, avg(v1) AS c FROM cube GROUP BY 1, 2, 3) SELECT time, lat, lon, round(v1 - c, 6) AS anomaly FROM cube JOIN m USING (lat, lon) WHERE m.k = month(time)")
def month_anomaly(spark, d):
    c = cube(spark, d)
    table = aggregate.aggregate_by_space_time(c, ["v1"], "month")
    return join.calendar_lookup(c, table, "month", "c", "v1").select("time", "lat", "lon", F.round(F.col("v1") - F.col("c"), 6).alias("anomaly"))


@query(
    "WITH f AS (SELECT o_orderkey AS k, 'f' || o_orderkey AS path, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_custkey % 5 AS INTEGER) AS e FROM orders), "
    "d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) SELECT d.date, min_by(f.path, {'s': f.s, 'p': f.path}) AS path FROM d LEFT JOIN f ON d.date BETWEEN f.s AND f.e GROUP BY 1"
)
def dates_to_files(spark, d):
    o = read(spark, d, "orders")  # a file list, made up of orders
    f = o.select(F.concat(F.lit("f"), "o_orderkey").alias("path"), F.to_date("o_orderdate").alias("start_date"), F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 5).cast("int")).alias("end_date"))
    return join.covering_file(cube(spark, d).select(F.col("time").alias("date")), f)


@query(
    f"WITH {OBS_SQL}, p AS (SELECT kind, event_id, time FROM obs WHERE event_id % 2 = 0 AND time < TIMESTAMP '2024-01-15'), o AS (SELECT kind, event_id, time FROM obs WHERE NOT (event_id % 2 = 0 AND time < TIMESTAMP '2024-01-15')), l AS (SELECT kind, max(time) AS t FROM p GROUP BY 1) "
    "SELECT * FROM p UNION ALL SELECT o.* FROM o LEFT JOIN l USING (kind) WHERE l.t IS NULL OR o.time > l.t"
)
def prefer_reprocessed(spark, d):
    o = obs(spark, d).select("kind", "event_id", "time")
    early = F.expr("event_id % 2 = 0 AND time < TIMESTAMP '2024-01-15'")  # each event is of one feed
    return join.prefer_first(o.filter(early), o.filter(~early), ["kind"])


@query(f"WITH {POINTS_SQL}, {CUBE_SQL} SELECT row_id, time, lat, lon, round(avg_v, 6) AS v FROM points LEFT JOIN (SELECT lat + 0.25 AS lat, avg(v1) AS avg_v FROM cube GROUP BY 1) USING (lat)")
def merge_back(spark, d):
    p = points(spark, d)
    v = cube(spark, d).groupBy((F.col("lat") + 0.25).alias("lat")).agg(F.avg("v1").alias("v"))
    return r6(join.merge_back(p, p.select("row_id", "lat").join(v, "lat").select("row_id", "v"), "row_id"), "v")


# -- grids -----------------------------------------------------------------------------------------


@query(
    f"WITH {CUBE_SQL}, a AS (SELECT lat, lon, avg(v1) AS v FROM cube GROUP BY 1, 2) SELECT x.lat, x.lon, round(stddev_pop(y.v), 6) AS v_std FROM a x JOIN a y ON abs(x.lat - y.lat) <= 1 AND abs(x.lon - y.lon) <= 1 GROUP BY 1, 2"
)
def std3x3(spark, d):
    a = cube(spark, d).groupBy("lat", "lon").agg(F.avg("v1").alias("v"))
    return r6(grid.neighbourhood_std(a, "v", F.col("lat"), F.col("lon"), keys=()).select("lat", "lon", "v_std"), "v_std")


@query(
    f"WITH {CUBE_SQL}, t AS (SELECT range * 0.25 + 0.125 AS x FROM range(36)), b AS (SELECT x, floor(x) AS lo, floor(x) + 1 AS hi, x - floor(x) AS w FROM t), "
    "g AS (SELECT date_trunc('month', time) AS m, lat, lon, avg(v1) AS v FROM cube GROUP BY 1, 2, 3) "
    "SELECT CAST(p.m AS DATE) AS time, i.x AS lat, j.x AS lon, round((1 - i.w) * ((1 - j.w) * p.v + j.w * q.v) + i.w * ((1 - j.w) * r.v + j.w * s.v), 10) AS v FROM b i, b j, g p, g q, g r, g s "
    "WHERE p.lat = i.lo AND p.lon = j.lo AND q.m = p.m AND q.lat = i.lo AND q.lon = j.hi AND r.m = p.m AND r.lat = i.hi AND r.lon = j.lo AND s.m = p.m AND s.lat = i.hi AND s.lon = j.hi"
)
def regrid_bilinear(spark, d):
    g = cube(spark, d).groupBy(F.to_date(F.date_trunc("month", "time")).alias("time"), "lat", "lon").agg(F.avg("v1").alias("v"))
    out = grid.regrid_linear(g, ["v"], grid.centres(spark, 0, 9, 0.25, "lat"), grid.centres(spark, 0, 9, 0.25, "lon"))
    return out.withColumn("v", F.round("v", 10)).filter("v IS NOT NULL")


@query(
    f"WITH {CUBE_SQL} SELECT time, avg(lat) AS lat, avg(lon) AS lon, round(avg(v1), 6) AS v1, round(stddev_pop(v1), 6) AS v1_std FROM cube GROUP BY time, floor(lat / 2), floor(lon / 5)"
)
def coarsen(spark, d):
    return r6(grid.coarsen(cube(spark, d), ["v1"], 2, 5, 0.0, 0.0, 1.0, 1.0, keys=("time",)), "v1", "v1_std")


@query(
    f"WITH {CUBE_SQL}, c AS (SELECT * FROM cube) SELECT t.time, a.lat, o.lon, c.v1 FROM (SELECT DISTINCT time FROM c) t CROSS JOIN (SELECT DISTINCT lat FROM c) a CROSS JOIN (SELECT DISTINCT lon FROM c) o LEFT JOIN c USING (time, lat, lon)"
)
def dense_grid(spark, d):
    return grid.dense(cube(spark, d), ["v1"])


@query(
    f"WITH {CUBE_SQL}, l AS (SELECT lat, time, max(CASE WHEN lon = 0 THEN v1 END) AS \"v1_0\", max(CASE WHEN lon = 4 THEN v1 END) AS \"v1_4.5\", max(CASE WHEN lon = 9 THEN v1 END) AS \"v1_100\" FROM cube WHERE lon IN (0, 4, 9) GROUP BY 1, 2) SELECT * FROM l"
)
def depth_columns(spark, d):
    c = cube(spark, d).select("time", "lat", F.col("lon").alias("depth"), "v1")
    return grid.depth_columns(c, "v1", [0, 4.5, 100], keys=("time", "lat"))


@query(f"WITH {CUBE_SQL} SELECT time, lat, lon, CASE WHEN (lat + lon) % 3 > 0 THEN v1 END AS v1 FROM cube")
def clip_land(spark, d):
    c = cube(spark, d)
    sea = c.select("lat", "lon").distinct().filter("(lat + lon) % 3 > 0")
    return grid.clip_land(c.drop("v2"), sea, ["v1"])


@query(f"WITH {CUBE_SQL}, m AS (SELECT lat, lon, avg(v1) AS v FROM cube GROUP BY 1, 2) SELECT lat, " + ", ".join(f'round(max(CASE WHEN lon = {i} THEN v END), 6) AS "{i}.0"' for i in range(10)) + " FROM m GROUP BY 1")
def cell_matrix(spark, d):
    m = cube(spark, d).groupBy("lat", "lon").agg(F.avg("v1").alias("v"))
    return r6(grid.matrix(m, "v").withColumnsRenamed({f"{i}.0": f"c{i}" for i in range(10)}), *[f"c{i}" for i in range(10)]).withColumnsRenamed({f"c{i}": f"{i}.0" for i in range(10)})


# -- domain ----------------------------------------------------------------------------------------


@query(
    f"WITH {CUBE_SQL}, a AS (SELECT time, lat, lon, v1 FROM cube WHERE v1 > 45), c AS (SELECT DISTINCT time, lat, lon FROM cube) "
    "SELECT c.time, c.lat, c.lon, round(min(sqrt(power(radians(c.lat) - radians(a.lat), 2) + power(radians(c.lon) - radians(a.lon), 2)) * 6371.0), 4) AS km FROM c JOIN a USING (time) GROUP BY 1, 2, 3".replace("USING (time)", "ON a.time = c.time")
)
def nearest_km(spark, d):
    """Distance from each cell to the nearest marked cell of its day."""
    return fronts.marked_distance(cube(spark, d), F.col("v1") > 45).filter("km IS NOT NULL").withColumn("km", F.round("km", 4))


@query()
def front_distance(spark, d):
    """Fronts of monthly fields; compared with brute force in tests, as median filters have no short SQL."""
    m = cube(spark, d).groupBy(F.to_date(F.date_trunc("month", "time")).alias("time"), "lat", "lon").agg(F.avg("v1").alias("sst"))
    return r6(fronts.front_distance(m, "sst", 6.0), "sst_fdist")


@query(
    f"WITH {CUBE_SQL}, s AS (SELECT range AS row_id, DATE '1997-01-01' + CAST(range * 7 AS INTEGER) AS time, range % 5 + 0.6 AS x0, range % 4 + 0.7 AS y0, range % 5 + 3.4 AS x1, range % 4 + 2.2 AS y1 FROM range(40)) "
    "SELECT s.row_id, s.time, round(avg(c.v1), 6) AS v1 FROM s LEFT JOIN cube c ON c.time = s.time AND c.lon + 0.5 >= x0 AND c.lon - 0.5 <= x1 AND c.lat + 0.5 >= y0 AND c.lat - 0.5 <= y1 GROUP BY 1, 2"
)
def extract_boxes(spark, d):
    shapes = [(i, dt.date(1997, 1, 1) + dt.timedelta(days=7 * i), bytearray(extract.box_wkb(i % 5 + 0.6, i % 4 + 0.7, i % 5 + 3.4, i % 4 + 2.2))) for i in range(40)]
    s = spark.createDataFrame(shapes, "row_id long, time date, geometry binary")
    return r6(extract.extract_polygons(s, cube(spark, d), ["v1"], 1.0).drop("geometry"), "v1")


@query(
    f"WITH {CUBE_SQL}, g AS (SELECT time, lat * 0.25 + 0.125 AS lat, lon * 0.25 + 0.125 AS lon, v1 FROM cube), s AS (SELECT range AS row_id, DATE '1997-01-01' + CAST(range * 7 AS INTEGER) AS time, range % 5 * 0.3 + 0.03 AS x0, range % 4 * 0.4 + 0.06 AS y0, range % 5 * 0.3 + 0.5 AS x1, range % 4 * 0.4 + 0.2 AS y1 FROM range(40)) "
    "SELECT s.row_id, s.time, round(avg(c.v1), 6) AS v1 FROM s LEFT JOIN g c ON c.time = s.time AND c.lon + 0.125 >= x0 AND c.lon - 0.125 <= x1 AND c.lat + 0.125 >= y0 AND c.lat - 0.125 <= y1 GROUP BY 1, 2"
)
def extract_boxes_of_centred_cells(spark, d):
    """Cells of a quarter degree whose centres are half a step off the whole steps."""
    shapes = [(i, dt.date(1997, 1, 1) + dt.timedelta(days=7 * i), bytearray(extract.box_wkb(i % 5 * 0.3 + 0.03, i % 4 * 0.4 + 0.06, i % 5 * 0.3 + 0.5, i % 4 * 0.4 + 0.2))) for i in range(40)]
    s = spark.createDataFrame(shapes, "row_id long, time date, geometry binary")
    g = cube(spark, d).withColumn("lat", F.col("lat") * 0.25 + 0.125).withColumn("lon", F.col("lon") * 0.25 + 0.125)
    return r6(extract.extract_polygons(s, g, ["v1"], 0.25).drop("geometry"), "v1")


_T = "((datediff('day', DATE '2000-01-01', time) - 0.5) / 36525.0)"


def _moon_sql() -> str:
    d, m, a = f"radians(297.8501921 + 445267.1114034 * {_T})", f"radians(357.5291092 + 35999.0502909 * {_T})", f"radians(134.9633964 + 477198.8675055 * {_T})"
    phase = f"pi() - {d} - radians(6.289) * sin({a}) + radians(2.100) * sin({m}) - radians(1.274) * sin(2 * {d} - {a}) - radians(0.658) * sin(2 * {d}) - radians(0.214) * sin(2 * {a}) - radians(0.110) * sin({d})"
    return f"WITH {CUBE_SQL} SELECT DISTINCT time, round((1 + cos({phase})) * 50.0, 5) AS moon FROM cube"


@query(_moon_sql())
def moon(spark, d):
    return cube(spark, d).select("time").distinct().select("time", F.round(ph.moon_illumination(F.col("time")), 5).alias("moon"))


@query(f"WITH {CUBE_SQL} SELECT time, (lat * 40 + 180) % 360 - 180 AS lon, round(v1 - 273.15, 6) AS celsius, round(sqrt(v1 * v1 + lat * lat), 6) AS speed, round((v1 * v1 + lat * lat) * 0.5, 4) AS gke, {_SEASON} AS season, make_date({_CODE} // 10, [3, 6, 9, 12][{_CODE} % 10], 1) AS season_date FROM cube")
def scalar_functions(spark, d):
    v1, v2, t = F.col("v1"), F.col("lat"), F.col("time")
    return cube(spark, d).select(
        "time", ph.wrap_longitude(F.col("lat") * 40).alias("lon"), F.round(ph.kelvin_to_celsius(v1), 6).alias("celsius"), F.round(ph.speed(v1, v2), 6).alias("speed"),
        F.round(ph.kinetic_energy(v1, v2), 4).alias("gke"), season(t).alias("season"), season_code_date(season_code(t)).alias("season_date"),
    )


@query(f"WITH {OBS_SQL}, s AS (SELECT DISTINCT date_trunc('day', time) AS time FROM obs), b AS (SELECT date_trunc('month', time) AS m, count(*) AS n FROM s GROUP BY 1 ORDER BY n DESC, m LIMIT 1) SELECT event_id FROM obs, b WHERE date_trunc('month', obs.time) = b.m")
def most_frequent_month(spark, d):
    o = obs(spark, d).withColumn("time", F.date_trunc("day", "time"))
    return ocean.most_frequent_month(o).select("event_id")


@query(f"WITH {CUBE_SQL}, l AS (SELECT * FROM cube WHERE time = (SELECT max(time) FROM cube)) SELECT 'v1' AS variable, count(DISTINCT v1) = 1 AS constant FROM l UNION ALL SELECT 'lat', count(DISTINCT lat) = 1 FROM l")
def last_step_constant(spark, d):
    return ocean.last_step_is_constant(cube(spark, d), ["v1", "lat"])


@query(f"WITH {CUBE_SQL} SELECT time, lat, lon, CASE WHEN v1 > 20 THEN v1 END AS a, CASE WHEN v1 < 15 THEN v1 END AS b FROM cube WHERE v1 > 20 OR v1 < 15")
def drop_empty_rows(spark, d):
    nan = F.lit(float("nan"))
    c = cube(spark, d).select("time", "lat", "lon", F.when(F.col("v1") > 20, F.col("v1")).otherwise(nan).alias("a"), F.when(F.col("v1") < 15, F.col("v1")).alias("b"))
    return files.drop_empty_rows(c)


# -- catalogue and plots ---------------------------------------------------------------------------


@query("SELECT event_type AS dataset_id, props AS dataset_type, CAST(min(ts) AS DATE) AS start_date, CAST(max(ts) AS DATE) AS end_date FROM events GROUP BY 1, 2")
def merge_provenance(spark, d):
    e = read(spark, d, "events").select(F.col("event_type").alias("dataset_id"), F.col("props").alias("dataset_type"), F.to_date("ts").alias("start_date"), F.to_date("ts").alias("end_date"))
    return catalog.merge_provenance(e)


@query("SELECT event_type AS dataset, CAST(min(ts) AS DATE) AS start_date, CAST(max(ts) AS DATE) AS end_date, CAST(sum(user_id) AS BIGINT) AS num_timesteps, count(DISTINCT user_id) AS files FROM events GROUP BY 1")
def catalog_summary(spark, d):
    e = read(spark, d, "events").select(F.col("event_type").alias("dataset"), F.to_date("ts").alias("start_date"), F.to_date("ts").alias("end_date"), F.col("user_id").alias("num_timesteps"), F.col("user_id").alias("path"))
    return catalog.summary(e)


@query(f"WITH {CUBE_SQL} SELECT {_CODE} AS time_agg, round(avg(v1), 6) AS v1, round(avg(v2), 6) AS v2, make_date({_CODE} // 10, [3, 6, 9, 12][{_CODE} % 10], 1) AS date FROM cube WHERE lon BETWEEN 1 AND 5 AND lat BETWEEN 2 AND 8 GROUP BY 1, 4")
def time_series_box(spark, d):
    return r6(plots.time_series(cube(spark, d), ["v1", "v2"], (1, 2, 5, 8), "season"), "v1", "v2")


@query(f"WITH {CUBE_SQL} SELECT CAST(date_trunc('month', time) AS DATE) AS time_agg, round(avg(v1), 6) AS v1, CAST(date_trunc('month', time) AS DATE) AS date FROM cube WHERE lon = 3 AND lat = 7 GROUP BY 1, 3")
def time_series_point(spark, d):
    return r6(plots.time_series(cube(spark, d), ["v1"], (3.2, 6.9), "month"), "v1")


@query(f"WITH {CUBE_SQL} SELECT strftime(time, '%Y-%m') AS key, count(*) AS n, round(sum(v1), 4) AS v1 FROM cube WHERE time BETWEEN DATE '1997-02-01' AND DATE '1998-03-31' GROUP BY 1")
def store_roundtrip(spark, d):
    """Written to a store in two overlapping parts, and scanned back."""
    import uuid

    from tidegrid.sources.store import CubeStore

    store = CubeStore(spark, f"{checkpoints(spark)}/store-{uuid.uuid4().hex}")
    c = cube(spark, d).drop("v2")
    store.add_data(c.filter("time < DATE '1998-01-01'"))
    store.add_data(c.filter("time >= DATE '1997-12-01'"))
    out = store.scan(("1997-02-01", "1998-03-31"), columns=["v1"])
    return out.groupBy(F.date_format("time", "yyyy-MM").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("v1").cast("double")), 4).alias("v1"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)



"""Variables of sea and air: winds, rain, radiation, waves, Ekman pumping, sea level and temperature.

The registry at the end maps a variable key to a DataFrame -> DataFrame transform.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions import physics as ph
from tidegrid.model import BBox
from tidegrid.operators.aggregate import daily
from tidegrid.operators.fronts import with_front_distance
from tidegrid.operators.grid import clip_land, grid_step, neighbourhood_std
from tidegrid.operators.join import calendar_lookup, outer_merge
from tidegrid.operators.window import centred_difference, event_counts, lagged, rate, rolling_mean

CELL = ("lat", "lon")


def daily_wind(df: DataFrame, u: str = "u10", v: str = "v10") -> DataFrame:
    """Daily mean, population deviation and maximum of the speed, and mean components."""
    s = ph.speed(F.col(u), F.col(v))
    return daily(df, CELL, {"wind_speed": F.avg(s), "wind_speed_std": F.stddev_pop(s), "wind_speed_max": F.max(s), u: F.avg(u), v: F.avg(v)})


def daily_pressure(df: DataFrame, variable: str = "msl") -> DataFrame:
    return daily(df, CELL, {variable: F.avg(ph.pascal_to_hectopascal(F.col(variable)))})


def daily_cloud(df: DataFrame, variable: str = "tcc") -> DataFrame:
    """Mean share of the sky."""
    return daily(df, CELL, {variable: F.avg(variable)})


def daily_rain(df: DataFrame, variable: str = "tp") -> DataFrame:
    """Millimetres a day; a day of missing values has none."""
    return daily(df, CELL, {variable: F.coalesce(F.sum(ph.metre_to_millimetre(F.col(variable))), F.lit(0.0))})


def daily_radiation(df: DataFrame, variables: Sequence[str] = ("ssr",)) -> DataFrame:
    """Mean power from accumulated energy."""
    out = None
    for v in variables:
        one = daily(rate(df.select("time", *CELL, v), v, name="__rate"), CELL, {v: F.avg("__rate")})
        out = one if out is None else out.join(one, ["time", *CELL], "full")
    return out


def daily_waves(df: DataFrame, height: str = "swh", direction: str = "mwd") -> DataFrame:
    """Mean height, and the arithmetic mean of directions."""
    return daily(df, CELL, {height: F.avg(height), direction: F.avg(direction)})


def ekman_pumping(df: DataFrame, tau_x: str = "tau_x", tau_y: str = "tau_y", dlat: float = 0.25, dlon: float = 0.25, periodic: bool = True) -> DataFrame:
    """Daily wind-stress curl and Ekman pumping velocity; null within 2 degrees of the equator.

    Neighbours wrap at the edges of the domain as periodic says.
    """
    out = centred_difference(df, tau_y, "lon", ("time", "lat"), "__dy", periodic)
    out = centred_difference(out, tau_x, "lat", ("time", "lon"), "__dx", periodic)
    metres = F.radians(F.lit(1.0)) * ph.EARTH_M
    curl = F.col("__dy") / (F.cos(F.radians("lat")) * dlon * metres) - F.col("__dx") / (dlat * metres)
    pump = F.when(F.abs("lat") >= 2, F.col("__curl") / (ph.SEA_DENSITY * ph.coriolis(F.col("lat"))))
    out = out.withColumn("__curl", curl).withColumn("__pump", pump)
    return daily(out, CELL, {"curl": F.avg(F.when(F.abs("lat") >= 2, F.col("__curl"))), "ekman_pumping": F.avg("__pump")})


def ekman_features(df: DataFrame, climatology: DataFrame, p90: DataFrame, variable: str = "ekman_pumping") -> DataFrame:
    """Smoothed value, anomaly from the day's climatology, its lags, and counts of days above the month's 90th percentile."""
    out = rolling_mean(df, variable, 7, name="smooth")
    out = calendar_lookup(out, climatology, "dayofyear", "__clim", variable)
    out = out.withColumn("anomaly", F.col("smooth") - F.col("__clim"))
    out = lagged(out, "anomaly", (3, 7, 14))
    out = calendar_lookup(out, p90, "month", "__p90", variable)
    out = event_counts(out, F.col("anomaly") > F.col("__p90"), "events", (3, 7, 14))
    return out.drop("__clim", "__p90")


def grid_index(axis: str, first: float, step: float) -> Column:
    return F.round((F.col(axis) - first) / step)


def _grid(df: DataFrame, lat0: float | None, lon0: float | None, step: float | None) -> tuple[float, float, float]:
    """First cell and step, from the axes where they aren't given."""
    if lat0 is None or lon0 is None:
        low = df.agg(F.min("lat"), F.min("lon")).first()
        if low[0] is None:
            return 0.0, 0.0, 1.0
        lat0, lon0 = (float(given if given is not None else found) for given, found in zip((lat0, lon0), low, strict=True))
    return lat0, lon0, grid_step(df, "lat") if step is None else step


def sea_level(df: DataFrame, lat0: float | None = None, lon0: float | None = None, step: float | None = None) -> DataFrame:
    """Adds 3 x 3 deviations of adt and sla and the geostrophic kinetic energy."""
    lat0, lon0, step = _grid(df, lat0, lon0, step)
    i, j = grid_index("lat", lat0, step), grid_index("lon", lon0, step)
    out = df.withColumn("gke", ph.kinetic_energy(F.col("ugos"), F.col("vgos")))
    for v in ("adt", "sla"):
        out = out.join(neighbourhood_std(df, v, i, j).select("time", *CELL, f"{v}_std"), ["time", *CELL], "left")
    return out


def sea_temperature(df: DataFrame, lat0: float | None = None, lon0: float | None = None, step: float | None = None) -> DataFrame:
    """analysed_sst in kelvin to sst in degrees, with its 3 x 3 deviation."""
    lat0, lon0, step = _grid(df, lat0, lon0, step)
    out = df.withColumnRenamed("analysed_sst", "sst").withColumn("sst", ph.kelvin_to_celsius(F.col("sst")))
    std = neighbourhood_std(out, "sst", grid_index("lat", lat0, step), grid_index("lon", lon0, step))
    return out.join(std.select("time", *CELL, "sst_std"), ["time", *CELL], "left")


def renamed(**names: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumnsRenamed(names)


def lyapunov(df: DataFrame, bbox: BBox | None = None) -> DataFrame:
    """fsle_max on longitudes of -180 .. 180, in a box."""
    low = df.agg(F.min("lon")).first()[0]
    out = df.select("time", *CELL, "fsle_max")
    if low is not None and low >= 0:
        out = out.withColumn("lon", ph.wrap_longitude(F.col("lon")))
    return out.filter(bbox.predicate()) if bbox else out


def non_negative(variable: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn(variable, F.when(F.col(variable).isNotNull(), F.greatest(F.col(variable), F.lit(0.0))))


def clean_steps(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Without null times, repeated coordinates, and steps in which no variable has a finite value."""
    df = df.filter(F.col("time").isNotNull()).dropDuplicates(["time", *CELL])
    finite = F.lit(False)
    for v in variables:
        finite = finite | F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    good = df.filter(finite).select("time").distinct()
    return df.join(good, "time", "left_semi")


def most_frequent_month(df: DataFrame) -> DataFrame:
    """Rows of the month that has most steps; the earliest on a tie."""
    steps = df.select("time").distinct().groupBy(F.date_trunc("month", "time").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    best = steps.agg(F.min_by("m", F.struct((-F.col("n")).alias("n"), F.col("m"))).alias("m"))
    return df.withColumn("m", F.date_trunc("month", "time")).join(best, "m", "left_semi").drop("m")


def last_step_is_constant(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Per variable whether the last step has a single distinct value: a sign of a broken file."""
    last = df.select(F.max("time").alias("time"))
    counts = df.join(last, "time", "left_semi").agg(*[F.count_distinct(v).alias(f"n{i}") for i, v in enumerate(variables)])
    parts = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), (F.col(f"n{i}") == 1).alias("constant")) for i, v in enumerate(variables)]))
    return counts.select(parts.alias("p")).select("p.*")


# -- groups: all variables of a key --------------------------------------------------------------


def temperature_group(df: DataFrame, lat0: float | None = None, lon0: float | None = None, step: float | None = None, sea: DataFrame | None = None) -> DataFrame:
    """sst, its 3 x 3 deviation and the distance to its fronts."""
    return with_front_distance(sea_temperature(df, lat0, lon0, step), "sst", sea=sea)


def chlorophyll_group(df: DataFrame, sea: DataFrame | None = None) -> DataFrame:
    """chl and the distance to its fronts."""
    return with_front_distance(df.withColumnRenamed("CHL", "chl"), "chl", sea=sea)


def instant_group(df: DataFrame) -> DataFrame:
    """Daily wind, cloud cover and pressure, on the days and cells that any has."""
    return outer_merge([daily_wind(df), daily_cloud(df), daily_pressure(df)], ("time", *CELL))


def accumulated_group(df: DataFrame, climatology: DataFrame, p90: DataFrame, previous: DataFrame | None = None, sea: DataFrame | None = None, tau_x: str = "tau_x", tau_y: str = "tau_y", rain: str = "tp", **grid) -> DataFrame:
    """Daily curl, pumping and its features, and rain.

    previous: days (time, lat, lon, ekman_pumping) before the first of df, so that running windows begin full;
    they aren't in the result. Features are null on land where sea is given.
    """
    pump = ekman_pumping(df, tau_x, tau_y, **grid)
    first = pump.agg(F.min("time")).first()[0]
    series = pump.select("time", *CELL, "ekman_pumping")
    if previous is not None:
        series = series.unionByName(previous.select("time", *CELL, "ekman_pumping").filter(F.col("time") < F.lit(first)))
    made = ekman_features(series, climatology, p90).drop("ekman_pumping").withColumnsRenamed({"smooth": "ekman_7d", "anomaly": "ekman_anom"})
    made = made.withColumnsRenamed({f"anomaly_lag{n}": f"ekman_anom_lag{n}" for n in (3, 7, 14)} | {f"events_{n}": f"n_upwell_events_{n}d" for n in (3, 7, 14)})
    if first is not None:
        made = made.filter(F.col("time") >= F.lit(first))
    if sea is not None:
        made = clip_land(made, sea, [c for c in made.columns if c not in ("time", *CELL)])
    return outer_merge([pump, made, daily_rain(df, rain)], ("time", *CELL))


def radiation_group(df: DataFrame) -> DataFrame:
    """Every variable of the table."""
    return daily_radiation(df, [c for c in df.columns if c not in ("time", *CELL)])


PROCESSORS: dict[str, Callable[..., DataFrame]] = {
    "atm-instante": instant_group,
    "atm-accum-avg": accumulated_group,
    "radiation": radiation_group,
    "waves": daily_waves,
    "chl": chlorophyll_group,
    "sst": temperature_group,
    "mld": renamed(mlotst="mld"),
    "ssh": sea_level,
    "fsle": lyapunov,
}

"""Means and statistics over time buckets, climatologies and days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.time import bucket, season, season_rank
from tidegrid.model import require_columns


def aggregate_by_time(df: DataFrame, variables: Sequence[str], agg_by: str = "month", time: str = "time") -> DataFrame:
    """Mean of each variable over all cells in each day, week, month, year or season, in order of time."""
    require_columns(df, [time, *variables])
    return df.groupBy(bucket(F.col(time), agg_by).alias("time_agg")).agg(*[F.avg(v).alias(v) for v in variables]).orderBy("time_agg")


def aggregate_by_time_stats(df: DataFrame, variable: str, agg_by: str = "month", time: str = "time") -> DataFrame:
    """Mean, sample deviation (null of one row), least and largest value in each bucket."""
    require_columns(df, [time, variable])
    v = F.col(variable)
    return (
        df.groupBy(bucket(F.col(time), agg_by).alias("time_agg"))
        .agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
        .orderBy("time_agg")
    )


def aggregate_by_space_time(df: DataFrame, variables: Sequence[str], agg_by: str = "month", time: str = "time") -> DataFrame:
    """Climatology: means by cell and calendar month, season, or month and year; n counts rows, nulls too."""
    require_columns(df, [time, "lat", "lon", *variables])
    t = F.col(time)
    keys: dict[str, list[Column]] = {
        "month": [F.month(t).alias("month")],
        "season": [season(t).alias("season")],
        "month_year": [F.year(t).alias("year"), F.month(t).alias("month")],
    }
    if agg_by not in keys:
        raise ValueError(f"no such climatology: {agg_by}")
    out = df.groupBy("lat", "lon", *keys[agg_by]).agg(*[F.avg(v).alias(v) for v in variables], F.count(F.lit(1)).alias("n"))
    order = [season_rank(F.col("season"))] if agg_by == "season" else [F.col(c) for c in ("year", "month") if c in out.columns]
    return out.orderBy(*order, "lat", "lon")


def daily(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column], time: str = "time") -> DataFrame:
    """Aggregates of a sub-daily table by day and keys."""
    return df.groupBy(F.to_date(time).alias("time"), *keys).agg(*[c.alias(name) for name, c in aggregates.items()])


def daily_mean(df: DataFrame, variables: Sequence[str], keys: Sequence[str] = ("lat", "lon"), time: str = "time") -> DataFrame:
    return daily(df, keys, {v: F.avg(v) for v in variables}, time)


def doy_climatology(df: DataFrame, variable: str, first_year: int, last_year: int, steps: int = 7, time: str = "time") -> DataFrame:
    """Mean by day of the year and cell of the running mean of `steps` rows; 29 February is left out."""
    from tidegrid.operators.window import rolling_mean

    some = df.filter(F.year(time).between(first_year, last_year))
    smooth = rolling_mean(some, variable, steps, time=time, name="smooth").filter(~((F.month(time) == 2) & (F.dayofmonth(time) == 29)))
    return smooth.groupBy(F.dayofyear(time).alias("dayofyear"), "lat", "lon").agg(F.avg("smooth").alias(variable))


def monthly_quantile(df: DataFrame, variable: str, q: float = 0.9, keys: Sequence[str] = ("lat", "lon"), time: str = "time") -> DataFrame:
    """Exact quantile, with linear interpolation, by calendar month and keys."""
    return df.groupBy(F.month(time).alias("month"), *keys).agg(F.percentile(variable, q).alias(variable))


def null_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and nulls of each column, one row a column."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]))
    return counts.select("rows", pairs.alias("p")).select(F.col("p.column").alias("column"), "rows", F.col("p.nulls").alias("nulls"))


def coverage(df: DataFrame, columns: Sequence[str], time: str = "time") -> DataFrame:
    """First and last day on which each column has a value; columns without any are left out. One scan."""
    parts = [F.struct(F.lit(c).alias("column"), F.min(F.when(F.col(c).isNotNull(), F.col(time))).alias("first"), F.max(F.when(F.col(c).isNotNull(), F.col(time))).alias("last")) for c in columns]
    return df.agg(F.array(*parts).alias("all")).select(F.explode("all").alias("p")).select("p.*").filter(F.col("first").isNotNull())

"""Joins on coordinates: upserts, merges of variables, nearest cells and steps, lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.operators.grid import nearest_node

CUBE = ("time", "lat", "lon")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str] = CUBE) -> DataFrame:
    """Rows of both. Where new has a row, its columns win, nulls too; columns and rows that only old has stay.

    One full outer join on the keys. Add partition columns to the keys where the store has them, so
    that each partition's rows meet in few tasks.
    """
    mine = [c for c in old.columns if c not in keys]
    theirs = [c for c in new.columns if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in mine])
    n = new.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in theirs], F.lit(True).alias("__new"))

    def value(c: str) -> Column:
        if c not in theirs:
            return F.col(f"__o_{c}").alias(c)
        if c not in mine:
            return F.col(f"__n_{c}").alias(c)
        return F.when(F.col("__new"), F.col(f"__n_{c}")).otherwise(F.col(f"__o_{c}")).alias(c)

    return o.join(n, list(keys), "full").select(*keys, *[value(c) for c in dict.fromkeys([*mine, *theirs])])


def add_variables(old: DataFrame, new: DataFrame, keys: Sequence[str] = CUBE) -> DataFrame:
    """Disjoint variables on the union of coordinates."""
    both = (set(old.columns) & set(new.columns)) - set(keys)
    if both:
        raise ValueError(f"variables in both tables: {', '.join(sorted(both))}")
    return old.join(new, list(keys), "full")


def replace_window(old: DataFrame, new: DataFrame, keys: Sequence[str] = CUBE, time: str = "time") -> DataFrame:
    """Appending by window: for new's variables, everything from its first to its last day is new's.

    Days inside that new lacks are gone for these variables; variables that new lacks keep all days.
    """
    theirs = [c for c in new.columns if c not in keys]
    mine = [c for c in old.columns if c not in keys]
    span = new.agg(F.min(time).alias("__a"), F.max(time).alias("__b"))
    shared = [c for c in mine if c in theirs]
    outside = old.select(*keys, *shared).crossJoin(F.broadcast(span)).filter(~F.col(time).between(F.col("__a"), F.col("__b")) | F.col("__a").isNull()).drop("__a", "__b")  # span is one row
    fresh = outside.unionByName(new, allowMissingColumns=True)
    kept = [c for c in mine if c not in theirs]
    return fresh.join(old.select(*keys, *kept), list(keys), "full") if kept else fresh


def outer_merge(tables: Sequence[DataFrame], keys: Sequence[str] = CUBE) -> DataFrame:
    """Many tables of different variables on the union of coordinates: one union and one grouping, not a chain of joins."""
    if not tables:
        raise ValueError("nothing to merge")
    names = list(dict.fromkeys(c for t in tables for c in t.columns if c not in keys))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return every.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])


def nearest_in_time(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, values: Sequence[str], days: int = 30) -> DataFrame:
    """Each left row with the values of right's row nearest in time among equal `by`; a tie goes to the later.

    Both sides are put in ordered streams, one for each key and stretch of `days`, where the last and next right rows are
    looked up: linear work, unlike a join on all pairs of a key. What a stretch lacks at its ends comes from a
    table of the stretches' first and last right rows, so a hot key is as many tasks as it has stretches. A
    null time matches nothing.
    """
    clock = F.unix_micros(F.to_timestamp(F.col("__t")))
    row = F.struct(clock.alias("t"), F.col("__t").alias("at"), *[F.col(v) for v in values])
    l = left.withColumn("__t", F.to_timestamp(left_time)).withColumn("__left", F.struct(*[F.col(f"`{c}`") for c in left.columns])).withColumn("__row", F.lit(None))
    r = right.select(*by, F.to_timestamp(right_time).alias("__t"), *values).filter("__t IS NOT NULL").withColumn("__row", row)
    kind = r.schema["__row"].dataType
    l = l.select(*by, "__t", "__left", F.col("__row").cast(kind).alias("__row"))
    both = l.unionByName(r.select(*by, "__t", F.lit(None).cast(l.schema["__left"].dataType).alias("__left"), "__row"))
    stretch = F.floor(clock / (days * 86_400_000_000)).alias("__s")
    both = both.select("*", stretch)
    ends = both.groupBy(*by, "__s").agg(F.min_by("__row", F.when(F.col("__row").isNotNull(), F.col("__t"))).alias("__f"), F.max_by("__row", F.when(F.col("__row").isNotNull(), F.col("__t"))).alias("__l"))
    along = Window.partitionBy(*by).orderBy("__s")  # a row for each stretch, not for each time
    ends = ends.select(
        *[F.col(b).alias(f"__k{i}") for i, b in enumerate(by)], F.col("__s").alias("__s2"),
        F.last("__l", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("__p0"),
        F.first("__f", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("__n0"),
    )
    w = Window.partitionBy(*by, "__s").orderBy("__t")
    before = F.last("__row", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("__row", ignorenulls=True).over(w.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    met = both.withColumn("__b", before).withColumn("__a", after).filter(F.col("__left").isNotNull())
    same = reduce(lambda a, b: a & b, [F.col("__s2").eqNullSafe(F.col("__s")), *[F.col(f"__k{i}").eqNullSafe(F.col(b)) for i, b in enumerate(by)]])
    met = met.join(ends, same, "left").withColumn("__b", F.when(F.col("__t").isNotNull(), F.coalesce("__b", "__p0"))).withColumn("__a", F.when(F.col("__t").isNotNull(), F.coalesce("__a", "__n0")))
    later = F.col("__b").isNull() | ((F.col("__a.t") - clock) <= (clock - F.col("__b.t")))
    pick = F.when(later & F.col("__a").isNotNull(), F.col("__a")).otherwise(F.col("__b"))
    return met.withColumn("__p", pick).select("__left.*", F.col("__p.at").alias("matched_time"), *[F.col(f"__p.{v}").alias(v) for v in values])


def nearest_cell(points: DataFrame, cube: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Each point (lat, lon, time) with the values of the nearest cell and time step; the later step and lower cell on ties.

    Axes are looked up one by one from distinct coordinates, then points meet the cube in one
    equi-join; points with a null coordinate keep null values.
    """
    out = points
    day = cube.select(F.unix_date(F.to_date("time")).cast("double").alias("time")).distinct()
    axes = {"lat": cube.select(F.col("lat").cast("double").alias("lat")).distinct(), "lon": cube.select(F.col("lon").cast("double").alias("lon")).distinct(), "time": day}
    out = out.withColumn("__lat", F.col("lat").cast("double")).withColumn("__lon", F.col("lon").cast("double")).withColumn("__time", F.unix_date(F.to_date("time")).cast("double"))
    for name, nodes in axes.items():
        found = nearest_node(nodes, out.select(F.col(f"__{name}").alias(name)), name, tie_to_higher=name == "time")
        out = out.join(found.select(F.col("x").alias(f"__{name}"), F.col("node").alias(f"__n_{name}")), f"__{name}", "left")
    grid = cube.select(F.col("lat").cast("double").alias("__n_lat"), F.col("lon").cast("double").alias("__n_lon"), F.unix_date(F.to_date("time")).cast("double").alias("__n_time"), *variables)
    out = out.join(grid, ["__n_lat", "__n_lon", "__n_time"], "left")
    return out.select(*points.columns, *variables)


def calendar_lookup(df: DataFrame, table: DataFrame, part: str, name: str, value: str, time: str = "time", keys: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """The value of a climatology for each row's day of the year or month."""
    calendar = {"dayofyear": F.dayofyear, "month": F.month}[part]
    return df.withColumn(part, calendar(time)).join(table.select(part, *keys, F.col(value).alias(name)), [part, *keys], "left").drop(part)


def merge_back(left: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Results joined to the rows they are for; of repeated keys the first in order of their values stays."""
    rest = [c for c in results.columns if c != key]
    once = results.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(*rest))).filter("__k = 1").drop("__k")
    return left.drop(*rest).join(once, key, "left")


def covering_file(dates: DataFrame, files: DataFrame, date: str = "date") -> DataFrame:
    """For each date the path of the first file (by start, then path) whose span covers it; dates without one are null.

    Files are exploded to their days, so that the join has an equality; the days of all files are
    what a catalogue lists.
    """
    days = files.select("path", "start_date", F.explode(F.sequence("start_date", "end_date")).alias(date))
    first = days.groupBy(date).agg(F.min(F.struct("start_date", "path")).alias("f")).select(date, F.col("f.path").alias("path"))
    return dates.select(date).distinct().join(first, date, "left")


def first_containing(items: DataFrame, spans: DataFrame, at: str, keep: Sequence[str]) -> DataFrame:
    """Each item with the earliest span (start, end) that contains its day."""
    days = spans.select(*keep, "start", F.explode(F.sequence("start", "end")).alias(at))
    first = days.groupBy(at).agg(F.min(F.struct("start", *keep)).alias("s"))
    return items.join(first, at, "left").select(*items.columns, *[F.col(f"s.{c}").alias(c) for c in keep])


def fillable_days(source: DataFrame, store: DataFrame, variable: str, time: str = "time") -> DataFrame:
    """Days on which the source has a value and the store has none."""
    def days(df: DataFrame) -> DataFrame:
        return df.filter(F.col(variable).isNotNull()).select(F.to_date(time).alias("day")).distinct()

    return days(source).join(days(store), "day", "left_anti")


def prefer_first(preferred: DataFrame, other: DataFrame, by: Sequence[str] = (), time: str = "time") -> DataFrame:
    """preferred whole, and of other only what is later than preferred's last day (of equal `by`)."""
    if by:
        last = preferred.groupBy(*by).agg(F.max(time).alias("__last"))
        rest = other.join(last, list(by), "left")
    else:
        rest = other.crossJoin(F.broadcast(preferred.agg(F.max(time).alias("__last"))))  # one row
    return preferred.unionByName(rest.filter(F.col("__last").isNull() | (F.col(time) > F.col("__last"))).drop("__last"))

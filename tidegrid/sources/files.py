"""Raw files: discovery, dates in names, patterns, staging and clean-up; CSV in and out."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.physics import missing_to_null
from tidegrid.model import DateRange, require_columns
from tidegrid.sources.store import COORDINATES, to_float


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, length and time of the files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime")


def keep_names(files: DataFrame, pattern: str | None) -> DataFrame:
    return files.filter(F.regexp_extract("path", r"([^/]+)$", 1).rlike(pattern)) if pattern else files


def file_days(files: DataFrame, pattern: str, fmt: str = "yyyyMMdd") -> DataFrame:
    """(path, day) of every day in a file's name: a pattern of one group is a day, of two a closed range."""
    groups = re.compile(pattern).groups
    if groups not in (1, 2):
        raise ValueError("the pattern needs one or two groups")
    name = F.regexp_extract("path", r"([^/]+)$", 1)

    def day(i: int):
        return F.to_date(F.try_to_timestamp(F.nullif(F.regexp_extract(name, pattern, i), F.lit("")), F.lit(fmt)))

    spans = files.select("path", day(1).alias("a"), day(groups).alias("b")).filter("a IS NOT NULL AND b >= a")
    return spans.select("path", F.explode(F.sequence("a", "b")).alias("day"))


def group_files(days: DataFrame, by: str) -> DataFrame:
    """The files of each year, or year and month."""
    keys = [F.year("day").alias("year")] + ([F.month("day").alias("month")] if by == "month" else [])
    return days.groupBy(*keys).agg(F.sort_array(F.collect_set("path")).alias("paths"), F.min("day").alias("start"), F.max("day").alias("end"))


def date_patterns(dates: DateRange) -> list[str]:
    """Few globs for YYYY/MM/..YYYYMMDD paths: whole years, whole months, else classes of day digits."""
    out: list[str] = []
    for year in dates.split(by=_resolution("year")):
        if year.days() >= 365 and (year.start.month, year.start.day, year.end.month, year.end.day) == (1, 1, 12, 31):
            out.append(f"*/{year.start:%Y}/*")
            continue
        for month in year.split(by=_resolution("month")):
            last = (month.start.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
            if month.start.day == 1 and month.end == last:
                out.append(f"*/{month.start:%Y}/{month.start:%m}/*")
                continue
            tens: dict[int, list[int]] = {}
            for d in range(month.start.day, month.end.day + 1):
                tens.setdefault(d // 10, []).append(d % 10)
            for t, ones in tens.items():
                digits = str(ones[0]) if len(ones) == 1 else f"[{ones[0]}-{ones[-1]}]"
                out.append(f"*/{month.start:%Y}/{month.start:%m}/*{month.start:%Y%m}{t}{digits}*")
    return out


def _resolution(name: str):
    from tidegrid.model import TimeResolution

    return TimeResolution(name)


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for p in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Within one file system; the target's folder is made."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(Path(target).getParent())
    if not fs.rename(Path(source), Path(target)):
        raise OSError(f"could not move {source} to {target}")


def sweep(spark: SparkSession, folder: str, suffix: str = ".bak") -> list[str]:
    """Crash recovery of multi-step moves: a backup without its original is put back, others go."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    restored = []
    for s in fs.listStatus(Path(folder)) if fs.exists(Path(folder)) else []:
        name = s.getPath().toString()
        if name.endswith(suffix):
            original = name[: -len(suffix)]
            if fs.exists(Path(original)):
                fs.delete(s.getPath(), True)
            else:
                fs.rename(s.getPath(), Path(original))
                restored.append(original)
    return restored


def prune_empty(spark: SparkSession, folder: str) -> int:
    """Remove empty folders below a folder, from the deepest up; how many went."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def prune(at, top: bool) -> tuple[int, bool]:
        gone, left = 0, False
        for s in fs.listStatus(at):
            below, held = prune(s.getPath(), False) if s.isDirectory() else (0, True)
            gone, left = gone + below, left or held
        if not left and not top:
            fs.delete(at, False)
            gone += 1
        return gone, left

    return prune(Path(folder), True)[0] if fs.exists(Path(folder)) else 0


def copy_store(spark: SparkSession, source: str, target: str, partitions: Sequence[str] = ("year", "month")) -> None:
    df = spark.read.parquet(source)
    df.write.mode("overwrite").partitionBy(*[p for p in partitions if p in df.columns]).parquet(target)


def read_points(spark: SparkSession, source, index: str | None = None) -> DataFrame:
    """Points from a CSV path or a DataFrame, with a unique key column."""
    if isinstance(source, str):
        if not source.lower().endswith(".csv"):
            raise ValueError(f"points come from CSV files or DataFrames, not {source}")
        source = spark.read.option("header", "true").option("inferSchema", "true").csv(source)
    return with_key(source, index)


def with_key(df: DataFrame, index: str | None = None, name: str = "row_id") -> DataFrame:
    """df if its key column is unique (ValueError if not); without one, rows are numbered densely."""
    key = index or (name if name in df.columns else None)
    if key is not None:
        require_columns(df, [key], "points")
        n, distinct = df.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
        if n != distinct:
            raise ValueError(f"{key} has {n - distinct} repeated or null values")
        return df
    # a row's place in its partition, after the rows of those before; written first, so that both reads agree
    placed = df.withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__id", 33)
    counts = sorted(map(tuple, placed.groupBy(part.alias("p")).count().collect()))  # a row for each partition
    starts, n = [], 0
    for p, count in counts:
        starts.append((p, n))
        n += count
    table = df.sparkSession.createDataFrame(starts, "__p long, __start long")
    out = placed.join(table, part == F.col("__p"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__start") + F.col("__id").bitwiseAND((1 << 33) - 1)).alias(name))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Rows with a value other than coordinates; NaN is none. A table of coordinates alone stays whole."""
    values = [c for c in df.columns if c not in COORDINATES and c != "depth"]
    floats = {n for n, t in df.dtypes if t in ("float", "double")}
    df = df.withColumns({c: missing_to_null(F.col(c)) for c in values if c in floats})
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in values])) if values else df


def export_csv(df: DataFrame, folder: str, dates: DateRange | None = None, freq: str = "month") -> DataFrame:
    """CSV files by day, month or year below YYYY folders; returns (key, path) of what was written."""
    formats = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
    if freq not in formats:
        raise ValueError(f"no such frequency: {freq}")
    if dates is not None:
        df = df.filter(dates.predicate())
    df = drop_empty_rows(to_float(df.withColumn("time", F.to_date("time")).drop("year", "month", "day")))
    out = df.withColumn("yyyy", F.date_format("time", "yyyy")).withColumn("key", F.date_format("time", formats[freq]))
    out.repartition("key").sortWithinPartitions("key", *COORDINATES).write.mode("overwrite").partitionBy("yyyy", "key").option("header", "true").csv(folder)
    spark = df.sparkSession
    files = list_files(spark, folder, "*.csv").select(F.regexp_extract("path", r"key=([^/]+)", 1).alias("key"), "path")
    return files


def rename_csv(spark: SparkSession, files: DataFrame, folder: str, prefix: str) -> list[str]:
    """Each key's file as folder/YYYY/prefix_key.csv."""
    out = []
    for r in files.orderBy("key", "path").collect():  # one row for each file
        target = f"{folder}/{r['key'][:4]}/{prefix}_{r['key']}.csv"
        move(spark, r["path"], target)
        out.append(target)
    return out


def save_results(spark: SparkSession, results: DataFrame, path: str, key: str) -> None:
    """Results joined to those saved before; new columns replace old ones of the same name."""
    from tidegrid.operators.join import merge_back

    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    results = results.drop("geometry")
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        before = spark.read.option("header", "true").option("inferSchema", "true").csv(path)
        results = merge_back(before, results, key).checkpoint()
    results.write.mode("overwrite").option("header", "true").csv(path)

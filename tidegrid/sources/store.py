"""A cube store: Parquet partitioned by date parts, with an evolving schema, upserts and coverage.

The physical schema is the union of what was written; the first write of a column fixes its type.
Partition columns are derived from time and never trusted from input. Spark's commit protocol makes
one write atomic; an upsert overwrites only the partitions it touches, in dynamic mode, and rows for
it are read from the same partitions.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.time import parse_time
from tidegrid.model import BBox, DateRange, require_columns, to_day
from tidegrid.operators.aggregate import coverage
from tidegrid.operators.join import upsert
from tidegrid.operators.window import newest_covered

log = logging.getLogger(__name__)

COORDINATES = ("time", "lon", "lat")
DERIVED = {"year": F.year, "month": F.month, "day": F.dayofmonth}
#: Rows of a file, for about 256 MB of float columns.
FILE_MB = 256


def to_float(df: DataFrame) -> DataFrame:
    """Doubles, coordinates too, as floats."""
    return df.withColumns({n: F.col(n).cast("float") for n, t in df.dtypes if t == "double"})


class CubeStore:
    def __init__(self, spark: SparkSession, path: str, partitions: Sequence[str] = ("year", "month"), time_mode: str = "date"):
        self.spark, self.path, self.partitions, self.time_mode = spark, path, tuple(partitions), time_mode
        self._warned: set[tuple[str, tuple[str, ...]]] = set()

    # -- reading ---------------------------------------------------------------------------------

    def _fs(self):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self) -> bool:
        fs, where = self._fs()
        return fs.exists(where) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(where))

    def schema(self) -> T.StructType:
        """Union of the schemas of one file a partition, the newest: whatever add_data writes has all columns known by then."""
        if not self.exists():
            raise RuntimeError(f"no data in {self.path}")
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.path)
        newest = files.groupBy(F.regexp_replace("path", "/[^/]*$", "")).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
        paths = sorted(r["path"] for r in newest.select("path").collect())  # one for each partition
        return self.spark.read.option("mergeSchema", "true").option("basePath", self.path).parquet(*paths).schema

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        return self.spark.read.schema(schema or self.schema()).parquet(self.path)

    def months(self, dates: DateRange | Sequence) -> Column | None:
        """The partitions that hold dates. Catalyst does not derive this from a filter on time."""
        if self.partitions[:1] != ("year",):
            return None
        by_month = "month" in self.partitions
        number = F.col("year") * 100 + F.col("month") if by_month else F.col("year")
        if isinstance(dates, DateRange):
            a, b = dates.start, dates.end
            return number.between(a.year * 100 + a.month, b.year * 100 + b.month) if by_month else number.between(a.year, b.year)
        return number.isin(sorted({d.year * 100 + d.month if by_month else d.year for d in dates}))

    def scan(self, dates: tuple | list | DateRange | None = None, bbox: BBox | None = None, columns: Sequence[str] | None = None, padding: float | None = None) -> DataFrame:
        """Rows of a closed date range (a pair) or of single days (a list), in a closed box.

        Coordinates are always among the columns; unknown names are passed over. time is a day. A day
        that can't be read is logged and left out; if none is left, all days are read.
        """
        df = self.read()
        if isinstance(dates, tuple):
            if len(dates) != 2:
                raise ValueError("a range has a start and an end")
            dates = DateRange(*dates)
        if isinstance(dates, DateRange):
            if (months := self.months(dates)) is not None:
                df = df.filter(months)
            # on the stored column, not on a cast of it, so that it reaches the Parquet reader
            df = df.filter((F.col("time") >= F.lit(dates.start)) & (F.col("time") < F.lit(dates.end + dt.timedelta(days=1))))
        elif isinstance(dates, list):
            days = []
            for d in dates:
                try:
                    days.append(to_day(d))
                except ValueError:
                    log.warning("not a date: %r", d)
            if days:
                if (months := self.months(days)) is not None:
                    df = df.filter(months)
                df = df.filter(F.to_date("time").isin(sorted(set(days))))
        elif dates is not None:
            raise ValueError("dates are a pair, a list or a range")
        if bbox is not None:
            df = df.filter((bbox.padded(padding) if padding else bbox).predicate())
        if columns is not None:
            wanted = [*COORDINATES, *[c for c in columns if c in df.columns and c not in COORDINATES]]
            df = df.select(*wanted)
        return df.withColumn("time", F.to_date("time"))

    # -- writing ---------------------------------------------------------------------------------

    def prepared(self, df: DataFrame, fmt: str | None = None) -> DataFrame:
        require_columns(df, COORDINATES, "input")
        df = df.withColumn("time", parse_time(F.col("time"), dict(df.dtypes)["time"], self.time_mode, fmt))
        custom = [p for p in self.partitions if p not in DERIVED]
        require_columns(df, custom, "input")
        df = df.withColumns({p: DERIVED[p]("time").cast("int") for p in self.partitions if p in DERIVED})
        return to_float(df)

    def aligned(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """Columns of the schema in its order: absent ones null, types the stored ones; others are refused."""
        extra = [c for c in df.columns if c not in schema.names]
        if extra:
            raise RuntimeError(f"columns that the store doesn't have: {', '.join(extra)}")
        missing = tuple(c for c in schema.names if c not in df.columns)
        if missing and (self.path, missing) not in self._warned:
            self._warned.add((self.path, missing))
            log.warning("input lacks stored columns: %s", ", ".join(missing))
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    def _write(self, df: DataFrame, mode: str) -> None:
        width = max(1, sum(4 if t in ("float", "int", "date") else 8 for _, t in df.dtypes))
        # a partition's rows are sorted together and shared out among tasks, so that months of any size write alike
        out = df.repartition(*self.partitions, F.pmod(F.xxhash64("lat"), F.lit(8))).sortWithinPartitions(*self.partitions, *COORDINATES)
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_MB * 1_000_000 // width).partitionBy(*self.partitions).parquet(self.path)

    def add_data(self, df: DataFrame, fmt: str | None = None) -> str:
        """Create, append or upsert; returns which. Rows meet stored ones if the date ranges meet.

        Boxes that are apart from the stored one are refused in an upsert.
        """
        df = self.prepared(df, fmt)
        if not self.exists():
            self._write(df, "overwrite")
            return "created"
        # bounds and partitions of the input, in one pass
        parts = df.groupBy(*self.partitions).agg(*[f(c).alias(f"{k}_{c}") for c in COORDINATES for k, f in (("low", F.min), ("high", F.max))]).collect()
        if not parts:
            raise ValueError("no rows to add")
        low, high = ({c: pick(x for r in parts if (x := r[f"{k}_{c}"]) is not None) for c in COORDINATES} for k, pick in (("low", min), ("high", max)))
        schema = self.schema()
        fields = {f.name: f for f in schema} | {f.name: f for f in df.schema if f.name not in schema.names}
        wide = T.StructType(list(fields.values()))
        if not self.time_coverage().overlaps(DateRange(low["time"], high["time"])):
            self._write(self.aligned(df, wide), "append")
            return "appended"
        if not self.geo_extent().overlaps(BBox(low["lon"], low["lat"], high["lon"], high["lat"])):
            raise ValueError("the box of the input doesn't meet the store's")
        # the touched partitions, as a predicate that prunes folders
        touched = [tuple(r[p] for p in self.partitions) for r in parts]
        if len(self.partitions) == 1:
            mine = F.col(self.partitions[0]).isin([t[0] for t in touched])
        else:
            mine = F.struct(*self.partitions).isin([F.struct(*map(F.lit, t)) for t in touched])
            mine = mine & F.col(self.partitions[0]).isin(sorted({t[0] for t in touched}))
        old = self.read(wide).filter(mine)
        keys = [*COORDINATES, *self.partitions]
        merged = upsert(old, df, keys)
        # the rows are cut from the files they replace before these go
        self._write(self.aligned(merged, wide).checkpoint(), "overwrite")
        return "merged"

    # -- coverage --------------------------------------------------------------------------------

    def time_coverage(self) -> DateRange:
        if not self.exists():
            raise RuntimeError(f"no data in {self.path}")
        df = self.read()
        ends = self._end_partitions()
        return DateRange.of((df.filter(ends) if ends is not None else df).withColumn("time", F.to_date("time")))

    def _end_partitions(self) -> Column | None:
        """The first and last partitions in time, by the names of folders; the others can't hold the first or last day."""
        if self.partitions[:1] != ("year",):
            return None
        fs, _ = self._fs()
        Path = self.spark._jvm.org.apache.hadoop.fs.Path

        def values(folder: str, name: str) -> list[int]:
            found = (s.getPath().getName().partition("=") for s in fs.listStatus(Path(folder)))
            return sorted(int(v) for k, _, v in found if k == name and v.lstrip("-").isdigit())

        years = values(self.path, "year")
        if not years:
            return None
        parts = []
        for year, at in ((years[0], 0), (years[-1], -1)):
            part = F.col("year") == year
            if self.partitions[1:2] == ("month",) and (months := values(f"{self.path}/year={year}", "month")):
                part = part & (F.col("month") == months[at])
            parts.append(part)
        return parts[0] | parts[1]

    def partition_sizes(self, columns: Sequence[str] = ()) -> DataFrame:
        """Rows of each partition, and how many have a value in columns."""
        return self.read().groupBy(*self.partitions).agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"n_{c}") for c in columns])

    def geo_extent(self) -> BBox:
        if not self.exists():
            raise RuntimeError(f"no data in {self.path}")
        return BBox.of(self.read())

    def variables(self) -> list[str]:
        return [c for c in self.schema().names if c not in COORDINATES and c not in self.partitions]

    def var_coverage(self, columns: Sequence[str] | None = None) -> DataFrame:
        return coverage(self.read().withColumn("time", F.to_date("time")), list(columns or self.variables()))

    def var_coverage_end(self, columns: Sequence[str]) -> dict[str, dt.date]:
        """Last day with a value, looked for from the newest partition back and no further than needed."""
        df, left, found = self.read().withColumn("time", F.to_date("time")), list(columns), {}
        if "year" not in self.partitions:
            return {r["column"]: r["last"] for r in coverage(df, left).collect()}
        for (year,) in sorted(df.select("year").distinct().collect(), reverse=True):  # years: a few dozen
            if not left:
                break
            for r in coverage(df.filter(F.col("year") == year), left).collect():
                found[r["column"]] = r["last"]
            left = [c for c in left if c not in found]
        return found

    def backfill_start(self, columns: Sequence[str], not_before: dict[str, dt.date] | None = None) -> dict[str, dt.date]:
        """Per column the earliest day without a value, back to the newest partition that has none such."""
        df = self.read()
        number = F.concat_ws("-", *[F.lpad(F.col(p).cast("string"), 4, "0") for p in self.partitions])
        out = {}
        for c in columns:
            part = df.filter(F.to_date("time") >= F.lit(not_before[c])) if not_before and c in not_before else df
            for r in newest_covered(part, [c], number).collect():
                out[c] = r["start"]
        return out

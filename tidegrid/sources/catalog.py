"""Metadata of files and where their data came from."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.model import DateRange
from tidegrid.sources.zarr import ZarrStore, group_attributes, set_attributes

SPAN = "dataset_id string, dataset_type string, start_date date, end_date date"


def scan_files(df: DataFrame) -> DataFrame:
    """One row for each file of a cube read from files: bounds, days, steps, variables with values. One pass."""
    names = [c for c in df.columns if c not in ("time", "lat", "lon", "depth", "year", "month", "day")]
    found = [F.max(F.when(F.col(c).isNotNull(), F.lit(c))) for c in names]
    out = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.min("lon").alias("xmin"), F.min("lat").alias("ymin"), F.max("lon").alias("xmax"), F.max("lat").alias("ymax"),
        F.min(F.to_date("time")).alias("start_date"), F.max(F.to_date("time")).alias("end_date"), F.count_distinct("time").alias("num_timesteps"),
        F.array_compact(F.array(*found)).alias("variables"), F.max("_metadata.file_modification_time").alias("file_mtime"),
    )
    return out.withColumn("filename", F.regexp_extract("path", r"([^/]+)$", 1)).withColumn("scanned_at", F.current_timestamp())


STORES = "path string, dataset string, start_date date, end_date date, num_timesteps long, xmin double, ymin double, xmax double, ymax double, variables array<string>, source_datasets string"


def scan_stores(spark: SparkSession, paths: Sequence[str], dataset: str | None = None) -> DataFrame:
    """One row for each Zarr store, from metadata and axes alone."""
    rows = []
    for p in paths:
        s = ZarrStore(spark, p)
        days = s.axis("time").astype("datetime64[us]").astype("datetime64[D]").tolist() if "time" in s.arrays else []
        lats, lons = (s.axis(d) if d in s.arrays else None for d in ("lat", "lon"))
        box = [None] * 4 if lats is None or lons is None else [float(x) for x in (lons.min(), lats.min(), lons.max(), lats.max())]
        rows.append((p, dataset, min(days, default=None), max(days, default=None), len(days), *box, sorted(s.variables()), group_attributes(spark, p).get("source_datasets")))
    return spark.createDataFrame(rows, STORES)


def save_catalog(catalog: DataFrame, path: str) -> None:
    """A catalogue as one small Parquet table; it may have been read from there."""
    catalog.coalesce(1).checkpoint().write.mode("overwrite").parquet(path)


def load_catalog(spark: SparkSession, path: str, schema: str = STORES) -> DataFrame:
    """A saved catalogue; an empty one if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def write_provenance(spark: SparkSession, path: str, manifest: Sequence[dict], start, end) -> list[dict]:
    """Say on a store which datasets its days from start to end come from, besides what it says already."""
    days = DateRange(start, end)
    spans = [*json.loads(group_attributes(spark, path).get("source_datasets") or "[]")]
    for task in manifest:
        if part := DateRange(task["start"], task["end"]).intersection(days):
            spans.append({"dataset_id": task["dataset_id"], "dataset_type": task["dataset_type"], "start_date": str(part.start), "end_date": str(part.end)})
    merged: dict[tuple, dict] = {}
    for s in spans:
        k = (s["dataset_id"], s["dataset_type"])
        old = merged.get(k, s)
        merged[k] = {**s, "start_date": min(old["start_date"], s["start_date"]), "end_date": max(old["end_date"], s["end_date"])}
    out = [merged[k] for k in sorted(merged)]
    if out:
        set_attributes(spark, path, {"source_datasets": json.dumps(out)})
    return out


def changed_files(before: DataFrame, now: DataFrame) -> DataFrame:
    """Paths that are new or have another modification time."""
    return now.select("path", "file_mtime").exceptAll(before.select("path", "file_mtime")).select("path")


def summary(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("dataset").agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"), F.sum("num_timesteps").alias("num_timesteps"), F.count_distinct("path").alias("files")
    )


def with_variable(catalog: DataFrame, name: str) -> DataFrame:
    return catalog.filter(F.array_contains("variables", name))


def all_variables(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.explode("variables").alias("variable")).distinct()


def in_range(catalog: DataFrame, start, end) -> DataFrame:
    return catalog.filter((F.col("start_date") <= F.lit(end)) & (F.col("end_date") >= F.lit(start)))


def provenance(json_column, name: str = "p"):
    """A column of JSON lists of spans as an array of structs."""
    return F.from_json(json_column, f"array<struct<{', '.join(f.replace(' ', ':', 1) for f in SPAN.split(', '))}>>").alias(name)


def merge_provenance(spans: DataFrame) -> DataFrame:
    """One widened span for each dataset."""
    return spans.groupBy("dataset_id", "dataset_type").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))


def window_provenance(manifest: DataFrame, start, end) -> DataFrame:
    """The manifest's tasks cut to a window; those outside are left out."""
    out = manifest.withColumn("start_date", F.greatest("start_date", F.lit(start).cast("date"))).withColumn("end_date", F.least("end_date", F.lit(end).cast("date")))
    return out.filter("start_date <= end_date")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tasks of a JSON list; none if the file is absent or not JSON."""
    empty = spark.createDataFrame([], "dataset_id string, dataset_type string, start string, end string")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return empty
    raw = spark.read.text(path, wholetext=True).first()
    try:
        tasks = json.loads(raw[0]) if raw else []
    except ValueError:
        return empty
    return spark.createDataFrame([tuple(t.get(k) for k in empty.columns) for t in tasks], empty.schema) if tasks else empty


def manifest_json(tasks: Sequence[dict]) -> str:
    return json.dumps(list(tasks), indent=2, default=str)

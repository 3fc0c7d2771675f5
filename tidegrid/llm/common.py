"""What the operators share: shared folders, shipping code, words, row ids, prefix sums."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word, as every contract of this package has it: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Names of this package's own columns start so, and clash with no input column.
OWN = "__tg_"

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make checkpoint() work and the package importable in Python workers; safe to call often.

    The checkpoint folder is the session's spark.checkpoint.dir. Only a local master without
    that setting gets a temporary one, since driver and executors are then one process.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidegrid-checkpoints-")
        sc.setCheckpointDir(folder)
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        if os.path.isdir(package):
            target = os.path.join(tempfile.mkdtemp(prefix="tidegrid-ship-"), "tidegrid_code.zip")
            with zipfile.ZipFile(target, "w") as z:
                for top, _, names in os.walk(package):
                    for name in names:
                        if name.endswith(".py"):
                            path = os.path.join(top, name)
                            z.write(path, os.path.join("tidegrid", os.path.relpath(path, package)))
            sc.addPyFile(target)
        _shipped.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that a worker never holds the Python objects of a whole Arrow batch of texts."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a compressed table in a shared folder, read back; remove() it when nothing lazy reads it any more."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def n_words(text: Column) -> Column:
    """Words of a text; null has none. JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_row_id(df: DataFrame, name: str = OWN + "row") -> DataFrame:
    """A number for each row: its Parquet file, as leading bits of a hash of the path, and its place in that file.

    It does not depend on how files are split among tasks, so decisions on rows can be joined back to
    rows in any later read, even where ids are null or repeat and executors have come or gone. The hash
    bits are so many that no two of the files agree in them, which is checked. What is not read from
    files is numbered once and kept in the checkpoint folder: go on with the frame that is returned.
    """
    files = set(df.inputFiles())
    if files:
        try:
            meta = df.metadataColumn("_metadata")
            path, place = meta["file_path"], meta["row_index"]
            df.select(path, place)
        except AnalysisException:  # a union or an aggregate of files, or files of another kind
            files = set()
    if not files:
        prepare(df.sparkSession)
        return df.withColumn(name, F.monotonically_increasing_id()).checkpoint()
    prints = [xxhash.xxh64_intdigest(f.replace("file:///", "file:/", 1), 42) for f in files]  # as Spark's xxhash64 has it
    bits = min(40, 20 + 2 * len(files).bit_length())
    while len({x >> (64 - bits) for x in prints}) < len(files):
        bits += 1
    leading = F.shiftleft(F.shiftrightunsigned(F.xxhash64(path), 64 - bits), 63 - bits)
    number = F.when(place < 1 << (63 - bits), leading.bitwiseOR(place)).otherwise(F.raise_error(F.lit("a file has too many rows to number")))
    # never null, and known not to be: else each inner join filters its side, and no two joins share an exchange
    return df.withColumn(name, F.coalesce(number, F.lit(-1).cast("long")))


def in_ranges(df: DataFrame, order: list[Column], rows: int, name: str) -> DataFrame:
    """df sorted globally to ranges of about so many rows, and the number of each row's range; written, so that it stays.

    The order must tell all rows apart: then no range grows with a key that many rows share.
    """
    ranges = max(1, -(-df.count() // rows))
    return df.repartitionByRange(ranges, *order).withColumn(name, F.spark_partition_id()).checkpoint()


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Running sum of value within keys along (bucket, order), without a task that holds a whole key.

    Rows are summed by (keys, bucket) with map-side combine; the few sums are accumulated to an
    offset for each bucket; only the rows of one bucket meet in a window. `bucket` must not
    decrease along the order, and the caller chooses so many buckets that one fits a task.
    """
    parts = df.groupBy(*keys, bucket).agg(F.sum(value).alias(OWN + "part"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(k).alias(OWN + "k_" + k) for k in keys],
        F.col(bucket).alias(OWN + "b"),
        F.coalesce(F.sum(OWN + "part").over(before), F.lit(0)).alias(OWN + "before"),
    )
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col(bucket) == F.col(OWN + "b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(OWN + "k_" + k))
    out = df.withColumn(OWN + "within", F.sum(value).over(within)).join(parts, same)
    return out.withColumn(name, F.col(OWN + "before") + F.col(OWN + "within")).drop(
        OWN + "before", OWN + "within", OWN + "b", *[OWN + "k_" + k for k in keys]
    )

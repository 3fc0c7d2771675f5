"""Sharding by jump consistent hashing.

The shard of a row follows from its doc_id and the number of shards alone; no table of a ring is
kept. With one more shard, a row either stays or moves to the new shard. Only doc_ids go through
the vectorised hash; texts stay in the JVM, and what is shuffled is a few numbers a row.

Slots number a shard's rows without gaps, in order of doc_id (null first), checksum, size and place in
the input. Rows are sorted globally to ranges of about `range_rows`; the ranges' counts, summed before
the shuffle, are accumulated to offsets (common.running_total).

Defined results: a null text has no bytes and the checksum of none; a null doc_id counts as -1; rows
that repeat share a shard and have slots of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import OWN, in_ranges, prepare, read, running_total, with_row_id

SHARDS = 40
ROW_BYTES = 16
RANGE_ROWS = 20_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of 64-bit keys to 0 .. shards - 1 (Lamping and Veach, 2014)."""
    # sequential ids are mixed first, as the generator below is linear in the key
    k = keys.astype(np.uint64)
    k = (k ^ (k >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    k = (k ^ (k >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    k ^= k >> np.uint64(31)
    at = np.zeros(len(k), np.int64)
    to = np.zeros(len(k), np.int64)
    live = np.arange(len(k))
    while len(live):
        at[live] = to[live]
        k[live] = k[live] * np.uint64(2862933555777941757) + np.uint64(1)
        to[live] = ((at[live] + 1) * (float(1 << 31) / ((k[live] >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        live = live[to[live] < shards]
    return at


def _jumped(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(jump(ids, shards), pa.int32()), pa.array(jump(ids, shards + 1), pa.int32())],
                names=["row", "doc_id", "size", "text_crc32", "shard", "grown_shard"],
            )

    return run


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", row: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """row, doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    if shards < 1:
        raise ValueError("shards must be positive")
    prepare(docs.sparkSession)
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    raw = F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))
    d = docs.select(
        F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(raw).cast("long") + ROW_BYTES).alias("size"), F.crc32(raw).alias("text_crc32"),
    )
    d = d.mapInArrow(_jumped(shards), "row long, doc_id long, size long, text_crc32 long, shard int, grown_shard int").checkpoint()
    own = [F.col("doc_id"), F.col("text_crc32"), F.col("size"), F.col("row")]
    d = in_ranges(d, [F.col("shard"), *own], range_rows, "b").withColumn("one", F.lit(1).cast("long"))
    d = running_total(d, ["shard"], "b", own, F.col("one"), "place")
    return d.select("row", "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("place") - 1).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id") -> None:
    """The rows of docs, whole, as Parquet under path, one folder a shard; a shard is written by many tasks."""
    placed = with_row_id(docs)
    where = shard(placed, shards, text, doc_id, OWN + "row").select(F.col("row").alias(OWN + "to"), "shard")
    placed.join(where, F.col(OWN + "row") == F.col(OWN + "to")).drop(OWN + "row", OWN + "to").write.partitionBy("shard").parquet(path)


def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents")).drop("row")


def _crc_step() -> str:
    """SQL that takes a byte y into a CRC-32 x: the table's entry of a byte is the sum of those of its bits."""
    step = "x >> 8"
    for k in range(8):
        entry = 1 << k
        for _ in range(8):
            entry = (entry >> 1) ^ (0xEDB88320 if entry & 1 else 0)
        step = f"xor({step}, ((xor(x, y) >> {k}) & 1) * {entry})"
    return step


#: Products are split at 32 bits, as SQL's numbers of 128 bits have a sign.
OP5_SQL = f"""
WITH RECURSIVE k0 AS (
  SELECT DISTINCT doc_id, CAST(coalesce(doc_id, -1) AS HUGEINT) + CASE WHEN coalesce(doc_id, -1) < 0 THEN 18446744073709551616 ELSE 0 END AS k FROM documents
), k1 AS (
  SELECT doc_id, xor(k, k >> 30) AS k FROM k0
), k2 AS (
  SELECT doc_id, (k * {0xBF58476D1CE4E5B9 % (1 << 32)} + ((k * {0xBF58476D1CE4E5B9 >> 32}) % 4294967296) * 4294967296) % 18446744073709551616 AS k FROM k1
), k3 AS (
  SELECT doc_id, xor(k, k >> 27) AS k FROM k2
), k4 AS (
  SELECT doc_id, (k * {0x94D049BB133111EB % (1 << 32)} + ((k * {0x94D049BB133111EB >> 32}) % 4294967296) * 4294967296) % 18446744073709551616 AS k FROM k3
), jumps AS (
  SELECT doc_id, xor(k, k >> 31) AS k, CAST(0 AS BIGINT) AS j FROM k4
  UNION ALL
  SELECT doc_id, n, CAST(floor((j + 1) * (CAST(2147483648 AS DOUBLE) / CAST((n >> 33) + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT doc_id, (k * 2862933555777941757 + 1) % 18446744073709551616 AS n, j FROM jumps WHERE j < {SHARDS + 1})
), shards AS (
  SELECT doc_id, CAST(max(j) FILTER (j < {SHARDS}) AS INTEGER) AS shard, CAST(max(j) FILTER (j < {SHARDS + 1}) AS INTEGER) AS grown_shard FROM jumps GROUP BY doc_id
), d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + {ROW_BYTES} AS size,
         xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: CAST('0x' || b AS BIGINT))), lambda x, y: {_crc_step()}), 4294967295) AS text_crc32
  FROM documents
)
SELECT d.doc_id, d.size, d.text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM d JOIN shards s ON d.doc_id IS NOT DISTINCT FROM s.doc_id
"""

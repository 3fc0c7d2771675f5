"""SimHash near-dedup with deletion-variant signatures.

A fingerprint is cut into two segments of 32 bits. Of two fingerprints at most two bits apart, one
segment differs by at most one bit, so they share a variant of it with that one bit left out. Each
distinct fingerprint is indexed under its 64 one-wildcard variants; equal variants are joined and
the full distance is verified. Of a bucket only pairs are taken that differ in the bit left out, or
those of bit 0 that agree in the segment: each link is made at most twice.

Buckets of more than `bucket` fingerprints (thousands of near copies share a segment) give no
pairs. Their members are indexed under the 65 values at most one bit from them; two fingerprints
share such a value if and only if they are at most two bits apart, so this is exact, and linear.

Copies collapse to one fingerprint before the index. Links go through graph.components.

Defined results: a null or empty text, or one without words, has fingerprint zero, which is linked
like any other; a component's id is its smallest doc_id that isn't null; rows that repeat are
copies; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import OWN, prepare, read, with_row_id
from tidegrid.llm.graph import components

SHINGLE = 3
SEED = 42
BUCKET = 32
_STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # on bytes, lower() and split() know ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), _STEP):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[i : i + _STEP], ends[i : i + _STEP], strict=True)], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(bits.view(np.int64)[0])


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t or b"", shingle) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.int64())], names=["row", "doc_id", "print"])

    return run


def near_links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between distinct prints whose components are those of all links at most two bits long."""
    segment = F.when(F.col("w") < 32, F.col("print").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("print", 32))
    cleared = segment.bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, w % 32)")))
    # each print becomes 64 rows, so few prints are still dealt to many tasks (by a hash, or the plan drops this step)
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = prints.repartition(tasks, F.xxhash64("print")).select("print", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("w"))
    index = index.select("print", F.expr("shiftleft(CAST(w AS BIGINT), 32)").bitwiseOR(cleared).alias("key"))
    sizes = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("u"), F.max("print").alias("v")).filter("n > 1").checkpoint()
    # of w = key >> 32: the bit left out is w, as segments lie in the print
    here = "bit_count(u ^ v) <= 2 AND ((key >> 32) % 32 = 0 OR shiftright(u ^ v, CAST(key >> 32 AS INT)) & 1 = 1)"
    twos = sizes.filter("n = 2").filter(here).select("u", "v")
    members = index.join(sizes.filter("n > 2").select("key", "n"), "key").checkpoint()
    few = members.filter(F.col("n") <= bucket).groupBy("key").agg(F.collect_list("print").alias("all"))
    few = few.select("key", "all", F.explode("all").alias("u")).select("u", F.explode(F.expr(f"filter(all, v -> v > u AND {here})")).alias("v"))
    hot = members.filter(F.col("n") > bucket).select("print").distinct()
    ball = hot.select("print", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("w"))
    ball = ball.select("print", F.expr("CASE WHEN w = 64 THEN print ELSE print ^ shiftleft(1L, w) END").alias("point"))
    meet = ball.groupBy("point").agg(F.min("print").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    many = ball.join(meet, "point").filter("print <> v").select(F.col("print").alias("u"), "v")
    return twos.union(few).union(many)


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """row, doc_id, fingerprint, component_id, kept of every row; of each component the row of the least doc_id stays."""
    prepare(docs.sparkSession)
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    raw = F.col(text).cast("string").cast("binary")
    d = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), raw.alias("text"))
    d = d.mapInArrow(_prints(shingle), "row long, doc_id long, print long").checkpoint()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")))
    prints = d.groupBy("print").agg(first.alias("first"))
    roots = components(near_links(prints.select("print"), bucket))
    prints = prints.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print")).checkpoint()
    firsts = prints.groupBy("root").agg(F.min("first").alias("first"))
    where = prints.select("print", "root").join(firsts, "root").select("print", "first")
    return d.join(where, "print").select(
        "row", "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"), (F.col("row") == F.col("first.row")).alias("kept")
    )


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")

"""Exact dedup by deterministic block naming.

A text is cut into fixed-size blocks. Distinct blocks are sorted and numbered: a block's number is
its name. Adjacent names are paired, distinct pairs are sorted and numbered in their turn, and so
on until one name is left of each text. Two texts of the same length get the same last name if and
only if all their bytes are equal: names stand for bytes, not for hashes of them.

A 128-bit fingerprint shortens the join that takes a block's name back to its documents. It is only
trusted after the distinct blocks, compared byte by byte, have shown one block to each
fingerprint in this input; otherwise the join is on the bytes themselves.

Blocks are made distinct with map-side combine, so a text that a third of all rows share costs one
block for each map task. Levels: log2 of the longest text's blocks.

Defined results: a null text is the empty text; an empty text has one empty block. Rows that repeat
whole are copies of each other, and exactly one stays. A null doc_id is below all others. An empty
table gives no rows. Columns besides `doc_id` and `text` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import OWN, prepare, read, sliced, with_row_id

BLOCK_BYTES = 4096

_NARROW = "row long, doc_id long, n_bytes long, text_sha256 string, prints array<binary>"
_BLOCKS = "print binary, block binary"


def _blocks(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)] or [b""]


def _narrow(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [(t or b"").lower() for t in batch.column(2).to_pylist()]  # bytes.lower: A-Z only
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    pa.array([[xxhash.xxh3_128_digest(b) for b in _blocks(t, size)] for t in texts], pa.list_(pa.binary())),
                ],
                names=["row", "doc_id", "n_bytes", "text_sha256", "prints"],
            )

    return run


def _content(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for t in batch.column(0).to_pylist():
                blocks = _blocks((t or b"").lower(), size)
                for i in range(0, len(blocks), 4096):  # a very long text leaves in parts
                    part = blocks[i : i + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([xxhash.xxh3_128_digest(b) for b in part], pa.binary()), pa.array(part, pa.binary())], names=["print", "block"]
                    )

    return run


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """A number for each row of distinct keys, in sorted order within each hash partition."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def exact_identity(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row, doc_id, n_bytes, text_sha256 and name of every row; equal (n_bytes, name): equal texts."""
    prepare(docs.sparkSession)
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    raw = F.col(text).cast("string").cast("binary")
    narrow = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), raw.alias("text")).mapInArrow(_narrow(block_bytes), _NARROW).checkpoint()
    blocks = docs.select(raw.alias("text")).mapInArrow(_content(block_bytes), _BLOCKS).distinct()
    names = _named(blocks.groupBy("print").agg(F.count(F.lit(1)).alias("variants")), ["print"]).checkpoint()
    cut = narrow.select("row", F.posexplode("prints").alias("at", "print"))
    clash = names.filter("variants > 1").select("print").limit(1).count()
    if clash:  # pragma: no cover - two blocks with one 128-bit print; then bytes are compared
        cut = (
            docs.select(F.col(row).alias("row"), raw.alias("text"))
            .mapInArrow(_content_at(block_bytes), "row long, at int, block binary")
            .join(_named(blocks.select("block").distinct(), ["block"]).checkpoint(), "block")
            .select("row", "at", "name")
        )
    else:
        cut = cut.join(names.select("print", "name"), "print").select("row", "at", "name")
    most = narrow.agg(F.max(F.size("prints"))).first()[0] or 1
    counts = narrow.select("row", F.size("prints").alias("left"))
    done = None
    if most > 1:
        cut = cut.join(counts, "row").checkpoint()
        while most > 1:
            one = cut.filter("left = 1").select("row", "name")
            done = one if done is None else done.unionByName(one)
            pairs = (
                cut.filter("left > 1")
                .groupBy("row", F.expr("at div 2").cast("int").alias("at"))
                .agg(
                    F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("a"),
                    F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
                    F.max(F.expr("(left + 1) div 2")).alias("left"),
                )
            )
            pairs = pairs.checkpoint()
            cut = pairs.join(_named(pairs.select("a", "b").distinct(), ["a", "b"]), ["a", "b"]).select("row", "at", "name", "left").checkpoint()
            most = (most + 1) // 2
            # names of different levels may be equal numbers; n_bytes keeps levels apart
        done = done.unionByName(cut.select("row", "name"))
    else:
        done = cut.select("row", "name")
    return narrow.select("row", "doc_id", "n_bytes", "text_sha256").join(done, "row")


def _content_at(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for row, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks = _blocks((t or b"").lower(), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], names=["row", "at", "block"]
                )

    return run


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept, text_sha256 of every row; of equal texts the largest doc_id stays."""
    ident = exact_identity(docs, text, doc_id, row, block_bytes).checkpoint()
    groups = ident.groupBy("n_bytes", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("top"), F.count(F.lit(1)).alias("group_size")
    ).checkpoint()  # so that both sides of the join are dealt anew, and a large group can be split
    return ident.join(groups, ["n_bytes", "name"]).select(
        "row",
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("top.row")).alias("kept"),
        "text_sha256",
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents")).drop("row")


OP8_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""

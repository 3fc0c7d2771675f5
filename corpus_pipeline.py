"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), docs being what the stage before it wrote, and returns a
DataFrame; all but the last return the columns of docs. Decisions are made by row number, the place
in the Parquet files of docs (common.with_row_id), so null and repeated doc_ids lose nothing, and a
lost executor between a decision and the read that applies it changes nothing.

Defined results, of all stages: an empty table stays empty; columns beyond doc_id, text, lang and
source are carried along, whatever their names; a null or empty text has no words, so the quality
stage rejects it; rows that repeat are copies of each other, of which the exact stage keeps one. Of
equal doc_ids the row number decides. Texts of any length are judged whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import OWN, prepare, read, with_row_id
from tidegrid.llm.exact import exact_dedup
from tidegrid.llm.mixing import mix
from tidegrid.llm.packing import pack_documents
from tidegrid.llm.quality import quality
from tidegrid.llm.similar import similar_dedup

ROW = OWN + "row"


def _kept(docs: DataFrame, judge: Callable[..., DataFrame]) -> DataFrame:
    """The rows of docs that judge keeps, with their columns."""
    rows = with_row_id(docs, ROW)
    keep = judge(rows, row=ROW).filter("kept").select(F.col("row").alias(ROW))
    return rows.join(keep, ROW, "left_semi").drop(ROW)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the counted rules and the perplexity bands of its language keep; a null language is one of its own."""
    return _kept(docs, quality)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z the row of the largest doc_id; a null doc_id is below all others."""
    return _kept(docs, exact_dedup)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 or more the row of the least doc_id; a null doc_id is above all others."""
    return _kept(docs, similar_dedup)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; texts without words are not taken, and a null source is one of its own."""
    rows = with_row_id(docs, ROW)
    taken = mix(rows, row=ROW).filter("taken > 0").select(F.col("row").alias(ROW), F.expr("taken div size").cast("int").alias(OWN + "times"))
    out = rows.join(taken, ROW)
    return out.withColumn(OWN + "turn", F.explode(F.sequence(F.lit(1), F.col(OWN + "times")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each sequence: its ids, and the documents in it with their places."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules),
    ("exact", exact),
    ("near", near),
    ("mixing", mixture),
    ("packing", packing),
]

#: Perplexities have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

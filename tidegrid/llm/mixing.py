"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Each source's documents queue in a shuffled order that a seed and the doc_id decide. A document's
virtual finish time is the cumulative size of its source's queue, itself included, divided by the
source's target; a source short of words queues up to three times over. All queues' entries are
sorted by finish time and taken until the running total reaches the budget, the total of all sizes.
So every source reaches its target at about virtual time 1.

Targets: sources in code-point order, null last, weigh 1, 2, 3, 1, ... and share the budget by
weight; a target stops at three times the source's size and the excess is shared again by weight.
That fixed point is found by sorting sources by size / weight and accumulating.

Scale: the queues, and then all entries by finish time, are sorted globally to ranges of about
`range_rows` rows, and running totals are taken over the ranges (common.running_total). The orders end
in the row number, so neither a source nor a doc_id that many rows share, null included, makes a
range or a task longer. One task meets the table of sources, a row for each, and one that of ranges.

Defined results: a null text has size 0; a null source is a source of its own; documents of size 0
take nothing and don't queue; a source without words has target 0; rows that repeat whole queue separately. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.llm.common import OWN, in_ranges, n_words, prepare, read, running_total, with_row_id

MOST_REPEATS = 3
SEED = "mix"
#: Rows that one range of a running total has on average.
RANGE_ROWS = 20_000


def source_targets(sizes: DataFrame, repeats: int = MOST_REPEATS) -> DataFrame:
    """From (source, source_size): also weight and target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select("source", "source_size", F.row_number().over(by_name).alias("place"))
    ranked = ranked.withColumn("weight", (F.col("place") - 1) % 3 + 1).withColumn("cap", F.col("source_size") * repeats)
    by_ratio = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "place")
    every = Window.partitionBy(F.lit(1))
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        ranked.withColumn("num", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
        .withColumn("den", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn("open", F.col("cap").cast("double") / F.col("weight") > F.col("num").cast("double") / F.col("den"))
    )
    first_open = F.min(F.when(F.col("open"), F.struct("place_by_ratio", "num", "den"))).over(every)
    out = level.withColumn("place_by_ratio", F.row_number().over(by_ratio)).withColumn("cut", first_open)
    share = F.col("weight") * F.col("cut.num").cast("double") / F.col("cut.den")
    cap = F.col("cap").cast("double")
    return out.select("source", "source_size", "weight", F.when(share.isNull() | (cap < share), cap).otherwise(share).alias("target"))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", row: str | None = None, repeats: int = MOST_REPEATS, seed: str = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """row, doc_id, size, source, source_size, target, taken of every row; taken / size is the number of copies."""
    prepare(docs.sparkSession)
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    d = docs.select(
        F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"),
        (F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)).alias("u"),
    ).checkpoint()
    targets = source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), repeats).withColumnRenamed("source", OWN + "source").checkpoint()
    of_source = F.col("source").eqNullSafe(F.col(OWN + "source"))
    own = [F.col("u"), F.col("doc_id"), F.col("size"), F.col("row")]
    queue = in_ranges(d.filter("size > 0"), [F.col("source").asc_nulls_last(), *own], range_rows, "b")
    queue = running_total(queue, ["source"], "b", own, F.col("size"), "ahead").join(targets, of_source)
    turns = queue.withColumn("turn", F.explode(F.expr(f"sequence(0, {repeats - 1})"))).filter("turn = 0 OR turn * source_size < target")
    turns = turns.withColumn("finish", (F.col("turn") * F.col("source_size") + F.col("ahead")).cast("double") / F.col("target"))
    turns = turns.select("row", "doc_id", "size", "source", "turn", "u", "finish")
    by_finish = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("turn"), *own]
    turns = running_total(in_ranges(turns, by_finish, range_rows, "b"), [], "b", by_finish, F.col("size"), "total")
    budget = d.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    taken = turns.filter(F.col("total") <= budget).groupBy(F.col("row").alias(OWN + "to")).agg(F.sum("size").alias("taken"))
    out = d.join(taken, F.col("row") == F.col(OWN + "to"), "left").join(targets, of_source)
    return out.select("row", "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source
), w AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s
), r AS (
  SELECT *, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, place) AS k,
         CAST(sum(source_size) OVER () AS BIGINT) - coalesce(CAST(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS num,
         CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS den
  FROM w
), cut AS (
  SELECT num, den FROM r WHERE CAST(cap AS DOUBLE) / weight > CAST(num AS DOUBLE) / den ORDER BY k LIMIT 1
), t AS (
  SELECT w.source, w.source_size,
         coalesce(least(CAST(cap AS DOUBLE), weight * CAST((SELECT num FROM cut) AS DOUBLE) / (SELECT den FROM cut)), CAST(cap AS DOUBLE)) AS target
  FROM w
), q AS (
  SELECT d.doc_id, d.size, d.source, d.u, t.source_size, t.target,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT q.*, g.turn, coalesce(CAST(g.turn * source_size + ahead AS DOUBLE) / nullif(target, 0), 0) AS finish
  FROM q, (SELECT unnest([0, 1, 2]) AS turn) g WHERE g.turn = 0 OR g.turn * source_size < target
), f AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, turn, u, doc_id ROWS UNBOUNDED PRECEDING) AS total FROM e
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(sum(CASE WHEN total <= (SELECT sum(size) FROM d) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM f GROUP BY doc_id, size, source_size, target
"""

"""Connected components of an edge list, without collecting it.

Each partition first contracts its own edges by union-find (at most `chunk` edges at a time). If few
edges are left, one task ends the work; else
large-star and small-star rounds (Kiveris et al., 2014) alternate until nothing changes. Every
round is checkpointed, so a lost executor costs one round. Rounds grow with the logarithm of the
largest component. A node's neighbours are dealt to as many shares as there are tasks; a share has
its own row of the node's least neighbour to join with, so a hub is never one task's.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_EDGE = "u long, v long"
#: A forest of so few edges, counted first, is one task's: rounds over all partitions would cost more.
FEW = 10_000


def _contract(chunk: int):
    """The edges of a forest with the components of each `chunk` edges of a partition; every edge leads to a root, the smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        seen = 0

        def find(x: int) -> int:
            root = x
            while (up := parent.get(root, root)) != root:
                root = up
            while x != root:
                parent[x], x = root, parent.get(x, x)
            return root

        def out() -> pa.RecordBatch:
            pairs = [(x, r) for x in parent if (r := find(x)) != x]
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(u), find(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    parent.setdefault(min(a, b), min(a, b))
            seen += batch.num_rows
            if seen >= chunk and parent:
                yield out()
                parent.clear()
                seen = 0
        if parent:
            yield out()

    return run


def _shared(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with s: the share of u's neighbours that v is in."""
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(tasks)))


def _least(shared: DataFrame) -> DataFrame:
    """(u, s, m): for each share of u's neighbours the least of all of them."""
    own = shared.groupBy("u", "s").agg(F.min("v").alias("m"))
    return own.withColumn("m", F.min("m").over(Window.partitionBy("u")))


def components(edges: DataFrame, chunk: int = 1_000_000, few: int = FEW) -> DataFrame:
    """(node, root) of every node of edges (u, v) that isn't its component's smallest; root is the smallest."""
    e = edges.select("u", "v").filter("u <> v").mapInArrow(_contract(chunk), _EDGE).distinct().checkpoint()
    if e.count() <= few:
        return e.coalesce(1).mapInArrow(_contract(few + 1), _EDGE).select(F.col("u").alias("node"), F.col("v").alias("root")).checkpoint()
    before = None
    while True:
        # large-star: what is above a node hangs on the least of the node's neighbourhood
        both = _shared(e.union(e.select("v", "u").toDF("u", "v")))
        least = _least(both).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, ["u", "s"]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small-star: a node and what is below it hang on the least of them
        down = _shared(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).checkpoint())
        least = _least(down)
        small = down.join(least, ["u", "s"])
        e = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct().checkpoint()
        after = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after

"""SimHash near-dedup by similarity: deletion-variant signatures of wider fingerprints, made whole by an exact join.

simhash.near_dedup links 64-bit fingerprints at most two bits apart, which catches only copies that
are all but whole. Here two texts are linked if the Jaccard similarity of their sets of five-word
shingles is 0.8 or more.

By the method of simhash.py, a fingerprint of a text's two-word shingles (single edits change these
less) is cut into SEGMENTS segments, each indexed under its one-wildcard variants, and equal variants
are joined. Two texts meet if a segment differs by at most one bit: at 0.8 by scattered edits 85 in
100 are expected to, at 0.9 97. The distance of 256-bit sketches of the five-word shingles is
verified, then the similarity itself by the shingles of both texts.

What signatures and their crowded buckets leave open is found exactly, and verified with the others.
Shingles have one order for all texts; of two sets that alike, the first fifth of either and one (the
prefix) have a shingle in common. So texts meet in the lists of their prefixes' shingles, and no pair
is missed. Any order is right; the one in use has shingles that a sample of texts repeats last, so
that common passages make few long lists. A pair that meets is a candidate unless its sizes, what
follows the place in either order, or the sketches exclude a similarity of 0.8.

Buckets and lists of more than `pivots` texts first compare each with that many, and verified links
are contracted; then all members of lists whose components differ are compared, in pairs of blocks of PART.

Defined results: null and empty texts and those without words have no shingles and are alike; a text
of fewer than five words is one shingle; a component's id is its smallest doc_id that isn't null;
rows that repeat are copies; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.llm.common import OWN, prepare, remove, sliced, with_row_id, written
from tidegrid.llm.graph import components
from tidegrid.llm.substring import _mixed as mixed
from tidegrid.llm.substring import _words, grams

_STEP = 1 << 16

SIMILAR_SHINGLE = 5
#: Sketches of texts 0.8 alike are 39 bits apart, with a standard error of 6; up to this they are candidates.
SIMILAR_BITS = 76
#: Sets smaller than this have sketches too coarse to exclude anything.
LEAST_SKETCHED = 32
#: Signatures: segments of a fingerprint of two-word shingles, of WIDER bits more than the rows' number has.
SIGNED_SHINGLE = 2
SEGMENTS = 5
WIDER = 6
PIVOTS = 32
PART = 4096
#: Texts in the sample, and shingles it may call common; these set the order only.
SAMPLE = 4000
COMMON = 100_000


_LANES = np.random.default_rng(8).integers(0, 1 << 64, 16, np.uint64)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """The set of shingles of a text, in ascending order."""
    h = _words.of((text or b"").lower().split())
    return np.unique(grams(h, min(size, len(h)))) if len(h) else h


def _bits(g: np.ndarray, lanes: int) -> np.ndarray:
    """Majority bits, 64 for each lane, of a set of shingles."""
    counts = np.zeros(64 * lanes, np.int64)
    for i in range(0, len(g), _STEP):
        part = g[i : i + _STEP]
        for lane in range(lanes):
            x = mixed(part + _LANES[lane])
            counts[64 * lane : 64 * lane + 64] += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return 2 * counts > len(g)


def _sampled(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for t in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t, shingle).view(np.int64))], names=["g"])

    return run


def segment_width(rows: int) -> int:
    """Bits of a segment, so that texts that aren't alike seldom share a variant."""
    return min(32, max(16, rows.bit_length() + WIDER))


def segments(text: bytes | None, width: int) -> np.ndarray:
    """The fingerprint of a text in segments of `width` bits."""
    bits = _bits(shingles(text, SIGNED_SHINGLE), -(-SEGMENTS * width // 64))[: SEGMENTS * width]
    return (bits.reshape(SEGMENTS, width) * (1 << np.arange(width))).sum(axis=1)


def signatures(texts: DataFrame, width: int) -> DataFrame:
    """(id, place, key, before) of texts (id, segments): a key for each segment and bit of it left out; place is -1."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # each text becomes some 100 rows, so few texts are still dealt to many tasks (by a hash, or the plan drops this step)
    index = texts.select("id", "segments").repartition(tasks, F.xxhash64("id")).select("id", F.posexplode("segments").alias("s", "value"))
    index = index.select("id", "s", "value", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("w"))
    key = F.expr(f"shiftleft(CAST(s * {width} + w AS BIGINT), 32) | (value & ~shiftleft(1L, w))")
    return index.select("id", F.lit(-1).cast("long").alias("place"), key.alias("key"), F.lit(0).cast("long").alias("before"))


def prefixes(texts: DataFrame) -> DataFrame:
    """(id, place, key, before) of texts (id, prefix): a key for each shingle of the prefix, its place and the shingle before."""
    index = texts.select("id", "prefix", F.posexplode("prefix").alias("place", "key"))
    return index.select("id", F.col("place").cast("long").alias("place"), "key", F.coalesce(F.get("prefix", F.col("place") - 1), F.lit(0).cast("long")).alias("before"))


def _sketches(shingle: int, width: int, common):
    """Sketch, a 128-bit hash of the set, its size and its prefix in order, and the fingerprint's segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, times = common.value
        for batch in sliced(batches):
            prints, same, sizes, prefixes, parts = [], [], [], [], []
            for t in batch.column(2).to_pylist():
                g = shingles(t, shingle)
                parts.append(segments(t, width))
                prints.append(np.packbits(_bits(g, 4), bitorder="little").view(np.int64))
                same.append(np.array([mixed(g + _LANES[i]).sum(dtype=np.uint64) for i in (4, 5)], np.uint64).view(np.int64))
                sizes.append(len(g))
                if len(often) and len(g):
                    at = np.minimum(np.searchsorted(often, g), len(often) - 1)
                    g = g[np.argsort(np.where(often[at] == g, times[at], 0), kind="stable")]
                prefixes.append(g[: len(g) - (4 * len(g) + 4) // 5 + 1].view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, longs), pa.array(same, longs), pa.array(sizes, pa.int64()), pa.array(prefixes, longs), pa.array(parts, longs)],
                names=["row", "doc_id", "print", "same", "size", "prefix", "segments"],
            )

    return run


def _candidates(most: int, pivots: int, whole: bool):
    """Of rows sorted by list (key, low, high): candidate pairs (u, v).

    A list of up to `pivots` members gives all of them. Of a larger one, each member is compared with
    the first `pivots` and gives its first candidate; if `whole`, with all members of other roots. Two
    members whose prefixes have the same shingle before this one are left to that one's list: alike
    texts share runs of their prefixes, and meet once for each run. The list where a run begins has
    them whole, in this pass or, if crowded, in the one that compares it whole.
    """

    def near(a: tuple, b: tuple) -> np.ndarray:
        (sizes, places, prints, roots, before), (sizes2, places2, prints2, roots2, before2) = [(x[4][:, None], x[5][:, None], x[6], x[7][:, None], x[9][:, None]) for x in (a, b)]
        n, m = sizes, sizes2.T
        shared = np.minimum(n - places, m - places2.T)  # at most, if this is the first in common
        out = (9 * shared >= 4 * (n + m)) & (5 * np.minimum(n, m) >= 4 * np.maximum(n, m)) & (roots != roots2.T)
        out &= (before != before2.T) | (places <= 0) | (places2.T <= 0)  # else they met in the list of the shingle before
        i, j = np.nonzero(out)
        for at in range(0, len(i), _STEP):
            x, y = i[at : at + _STEP], j[at : at + _STEP]
            apart = np.bitwise_count(prints[x] ^ prints2[y]).sum(axis=1, dtype=np.int64)
            out[x, y] = (apart <= most) | (np.minimum(n[x, 0], m[0, y]) < LEAST_SKETCHED)
        return out

    def pairs(rows: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ids = rows[3]
        few = rows[8][0] <= pivots
        step = max(1, 2 * _STEP // (len(ids) if few or whole else pivots))  # so that what is compared at once stays small
        if few or whole:
            for i in range(0, len(ids), step):
                some = tuple(c[i : i + step] for c in rows)
                rest = tuple(c[i:] for c in rows)
                u, v = np.nonzero(near(some, rest))
                yield some[3][u], rest[3][v]
        else:
            first = tuple(c[:pivots] for c in rows)
            for i in range(0, len(ids), step):
                some = tuple(c[i : i + step] for c in rows)
                close = near(some, first)
                lead = close.argmax(axis=1)
                has = close[np.arange(len(lead)), lead]
                yield some[3][has], first[3][lead[has]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(rows: tuple) -> Iterator[pa.RecordBatch]:
            new = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1])
            edge = np.flatnonzero(np.concatenate(([True], new, [True])))
            us, vs, n = [], [], 0
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                for u, v in pairs(tuple(c[a:b] for c in rows)):
                    us.append(u)
                    vs.append(v)
                    n += len(u)
                    if n > _STEP:
                        yield told(us, vs)
                        us, vs, n = [], [], 0
            if n:
                yield told(us, vs)

        def told(us: list, vs: list) -> pa.RecordBatch:
            u, v = np.concatenate(us), np.concatenate(vs)
            once = np.unique(np.column_stack((np.maximum(u, v), np.minimum(u, v))), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(once[:, i].copy()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(6)]
            prints = batch.column(6).flatten().to_numpy().view(np.uint64).reshape(-1, 4)
            rows = (*cols, prints, *[batch.column(i).to_numpy() for i in (7, 8, 9)])
            if held:
                rows = tuple(np.concatenate((h, x)) for h, x in zip(held.pop(), rows, strict=True))
            # the last list may go on in the next batch
            other = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]) | (rows[2] != rows[2][-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from out(tuple(c[:cut] for c in rows))
            held.append(tuple(c[cut:] for c in rows))
        if held:
            yield from out(held.pop())

    return run


def _verified(shingle: int):
    """Of (u, v, text, text2): the pairs whose sets are 0.8 alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            alike = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = shingles(a, shingle), shingles(b, shingle)
                both = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(5 * both >= 4 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(alike, pa.bool_()))

    return run


def similar_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None, shingle: int = SIMILAR_SHINGLE, most: int = SIMILAR_BITS, pivots: int = PIVOTS, part: int = PART) -> DataFrame:
    """row, doc_id, component_id, kept of every row, linking texts whose sets of `shingle`-word shingles are 0.8 alike."""
    spark = docs.sparkSession
    prepare(spark)
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    raw = F.col(text).cast("string").cast("binary")
    source = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), raw.alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = source.count()
    every, width = max(1, n // SAMPLE), segment_width(n)
    sample = source.filter(F.pmod(F.xxhash64("row"), F.lit(every)) == 0).select("text").mapInArrow(_sampled(shingle), "g long")
    often = sample.groupBy("g").count().filter("count > 2").orderBy(F.desc("count"), "g").limit(COMMON).toArrow()  # COMMON rows at most
    g, times = often.column("g").to_numpy().view(np.uint64), often.column("count").to_numpy()
    order = np.argsort(g)
    common = spark.sparkContext.broadcast((g[order], times[order]))

    base = f"{spark.sparkContext.getCheckpointDir()}/near-{uuid.uuid4().hex}"
    d = written(source.mapInArrow(_sketches(shingle, width, common), "row long, doc_id long, print array<long>, same array<long>, size long, prefix array<long>, segments array<long>"), f"{base}/sketches")
    common.destroy()  # workers let go of it
    rows = d.select("row", "doc_id", "same").checkpoint()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")))
    texts = d.groupBy("same").agg(F.min("row").alias("id"), first.alias("first")).checkpoint()
    ones = d.join(texts.select(F.col("id").alias("row")), "row", "left_semi").select(F.col("row").alias("id"), "size", "prefix", "segments")
    index = signatures(ones.filter("size > 0"), width).union(prefixes(ones))
    shared = index.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1")
    shared = shared.withColumn("blocks", F.expr(f"(n - 1) div {part} + 1")).withColumn("own", F.pmod(F.xxhash64("id", "key"), F.col("blocks")))
    # of a crowded bucket of signatures no pairs of blocks: prefixes bring its texts together exactly
    shared = shared.withColumn("other", F.explode(F.when(F.col("place") < 0, F.array("own")).otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    shared = shared.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    met = shared.join(d.select(F.col("row").alias("id"), "print", "size"), "id")
    met = written(met.select("key", "low", "high", "id", "size", "place", "print", "n", "before"), f"{base}/met")

    def verified(met, whole):
        met = met.select("key", "low", "high", "id", "size", "place", "print", "root", "n", "before")
        met = met.repartition(tasks, "key", "low", "high").sortWithinPartitions("key", "low", "high", "id")
        pairs = met.mapInArrow(_candidates(most, pivots, whole), "u long, v long").distinct().checkpoint()
        nodes = pairs.select(F.col("u").alias("row")).union(pairs.select("v")).distinct()
        t = written(source.select("row", "text").join(nodes, "row", "left_semi"), f"{base}/texts-{whole}")
        both = pairs.join(t.select(F.col("row").alias("u"), "text"), "u").join(t.select(F.col("row").alias("v"), F.col("text").alias("text2")), "v")
        return both.select("u", "v", "text", "text2").mapInArrow(_verified(shingle), "u long, v long").checkpoint()

    links = verified(met.withColumn("root", F.col("id")), False)
    # a table has a size; for a checkpoint, whose size is unknown, Spark puts Bloom filters of megabytes into the tasks' code
    roots = written(components(links), f"{base}/roots")
    crowded = met.filter((F.col("n") > pivots) & (F.col("place") >= 0)).join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    # lists whose members are of one component already are done; a list has some 2 * PART members at most
    members = Window.partitionBy("key", "low", "high")
    crowded = crowded.withColumn("a", F.min("root").over(members)).withColumn("b", F.max("root").over(members)).filter("a <> b").drop("a", "b")
    crowded = written(crowded, f"{base}/crowded")
    if not crowded.isEmpty():
        roots = components(links.union(verified(crowded, True)))
    texts = texts.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")).checkpoint()
    remove(spark, base)
    firsts = texts.groupBy("root").agg(F.min("first").alias("best")).checkpoint()
    where = texts.join(firsts, "root").select("same", "best").checkpoint()
    return rows.join(where, "same").select("row", "doc_id", F.col("best.doc_id").alias("component_id"), (F.col("row") == F.col("best.row")).alias("kept"))

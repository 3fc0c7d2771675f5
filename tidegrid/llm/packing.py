"""Best-fit packing with several permitted sequence lengths.

A document's token ids (tokenids.WordIds, with an end mark) are cut to pieces of at most the longest
permitted length, and pieces are packed to bins. Within a group, longest first, a piece goes to the
open bin that it fills best; where none has room, a new bin of the least net cost is opened: its cost
less what its free room is worth to the pieces still to come. The group is also packed with each
permitted length alone; the cheapest packing stays. Finally each bin shrinks to the shortest permitted
length that holds its contents, and its sequence of ids is put together.

Groups have a bounded expected number of pieces and pack by themselves on the executors: the ids are
shuffled once, as 16-bit numbers. Within a group a task holds at most `chunk` pieces, so repeated
rows or endless texts lengthen a task's stream but not its memory.

Defined results: a null or empty text has one token, its end mark; rows that repeat are packed each;
an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import OWN, prepare, read, with_row_id
from tidegrid.llm.tokenids import END, forget, loaded

LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a bin besides its length, in tokens.
OVERHEAD = 32
GROUP_PIECES = 20_000
CHUNK = 60_000
#: The same where the pieces' ids are held, of up to twice the longest length in bytes each.
GROUP_TEXTS = 5_000
CHUNK_TEXTS = 15_000

_OUT = "row long, doc_id long, piece long, start long, length long, bin_id string, bin_length int, bin_offset int, bin_used int"


def _pack(sizes: Sequence[int], permitted: Sequence[int], cost, opens: Sequence[int]) -> tuple[float, list[int], list[int]]:
    """Best fit of sizes (descending), opening bins of the lengths `opens`: final cost, each piece's bin, each bin's use."""
    worth = min(cost(c) / c for c in opens)
    ahead = sum(sizes)
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    by_room: dict[int, list[int]] = {}
    used: list[int] = []
    where: list[int] = []
    for size in sizes:
        ahead -= size
        i = bisect_left(rooms, size)
        if i < len(rooms):
            room = rooms[i]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(i)
        else:
            room = min((c for c in opens if c >= size), key=lambda c: (cost(c) - worth * min(c - size, ahead), c))
            b = len(used)
            used.append(0)
        used[b] += size
        where.append(b)
        if room > size:
            if room - size not in by_room:
                insort(rooms, room - size)
                by_room[room - size] = []
            by_room[room - size].append(b)
    total = sum(cost(next(c for c in permitted if c >= u)) for u in used)
    return total, where, used


def best_packing(sizes: Sequence[int], permitted: Sequence[int] = LENGTHS, overhead: int = OVERHEAD) -> tuple[float, list[int], list[int], list[int]]:
    """Cost, each piece's bin, each bin's use and final length, for sizes in descending order."""
    permitted = sorted(permitted)

    def cost(c: int) -> float:
        return c + overhead

    longest = sizes[0] if sizes else 0
    policies = [permitted, *([c] for c in permitted if c >= longest)]
    total, where, used = min((_pack(sizes, permitted, cost, p) for p in policies), key=lambda x: x[0])
    return total, where, used, [next(c for c in permitted if c >= u) for u in used]


def _packer(permitted: Sequence[int], overhead: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins, held = None, 0, []

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal bins, held
            held.sort(key=lambda x: -x[5])
            _, where, used, lengths = best_packing([x[5] for x in held], permitted, overhead)
            offsets = [0] * len(used)
            out = []
            for (_, row, doc_id, piece, start, length), b in zip(held, where, strict=True):
                out.append((row, doc_id, piece, start, length, f"{group}-{bins + b}", lengths[b], offsets[b], used[b]))
                offsets[b] += length
            bins += len(used)
            held = []
            types = [pa.int64()] * 5 + [pa.string()] + [pa.int32()] * 3
            names = [x.split()[0] for x in _OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if item[0] != group or len(held) >= chunk:
                    if held:
                        yield from packed()
                    if item[0] != group:
                        group, bins = item[0], 0
                held.append(item)
        if held:
            yield from packed()

    return run


def pack(docs: DataFrame, length: str, doc_id: str = "doc_id", row: str | None = None, permitted: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, group_pieces: int = GROUP_PIECES, chunk: int = CHUNK) -> DataFrame:
    """One row for each piece: its document, place in it, bin, and place in the bin; bin_length is permitted."""
    if not permitted or min(permitted) < 1:
        raise ValueError("permitted lengths must be positive")
    prepare(docs.sparkSession)
    groups = max(1, -(-docs.count() // group_pieces))
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    most = max(permitted)
    d = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.greatest(F.col(length).cast("long"), F.lit(1)).alias("all"))
    d = d.withColumn("piece", F.explode(F.expr(f"sequence(0L, (all - 1) div {most})"))).withColumn("start", F.col("piece") * most)
    d = d.select(
        F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("grp"), "row", "doc_id", "piece", "start", F.least(F.col("all") - F.col("start"), F.lit(most)).alias("length")
    )
    d = d.repartition("grp").sortWithinPartitions("grp", F.desc("length"), "doc_id", "row", "piece")
    return d.mapInArrow(_packer(tuple(permitted), overhead, chunk), _OUT)


_CUT = "row long, doc_id long, piece long, start long, length int, ids binary"


def _cut(path: str, definition: str, end: int, most: int):
    """Pieces of each document's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tail = loaded(path, definition), np.array([end], np.uint16)
        names = [x.split()[0] for x in _CUT.split(", ")]
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                every = [np.concatenate((x, tail)) for x in words.ids([t or b"" for t in part.column(2).to_pylist()])]
                size = np.array([len(x) for x in every], np.int64)
                pieces = -(-size // most)
                of = np.repeat(np.arange(len(size)), pieces)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * most
                raw = [every[k][a : a + most].astype("<u2").tobytes() for k, a in zip(of.tolist(), start.tolist(), strict=True)]
                length = np.minimum(size[of] - start, most).astype(np.int32)
                at = pa.array(of)
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(nth), pa.array(start), pa.array(length), pa.array(raw, pa.binary())], names=names)
        forget(path)

    return run


_SEQUENCE = (
    "bin_id string, bin_length int, bin_used int, doc_ids array<long>, ids array<int>, "
    "pieces array<struct<row: long, doc_id: long, piece: long, start: long, offset: int, length: int>>"
)


def _sequences(permitted: Sequence[int], overhead: int, chunk: int):
    """Bins with their ids, of pieces that come sorted by group and length, longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins, held = None, 0, []

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal bins, held
            held.sort(key=lambda x: -x[1])
            _, where, used, lengths = best_packing([x[1] for x in held], permitted, overhead)
            order = np.argsort(np.array(where, np.int64), kind="stable")
            some = [held[k] for k in order.tolist()]
            count = np.bincount(where, minlength=len(used))
            upto = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
            length = np.array([x[1] for x in some], np.int32)
            begins = np.cumsum(length) - length
            first = begins[upto[:-1]]
            offset = (begins - np.repeat(first, count)).astype(np.int32)
            fields = [pa.array([x[i] for x in some], pa.int64()) for i in (2, 3, 4, 5)] + [pa.array(offset), pa.array(length)]
            pieces = pa.StructArray.from_arrays(fields, names=["row", "doc_id", "piece", "start", "offset", "length"])
            ids = np.frombuffer(b"".join([x[6] for x in some]), "<u2").astype(np.int32)
            ends = np.concatenate((first, [len(ids)])).astype(np.int32)
            columns = [
                pa.array([f"{group}-{bins + k}" for k in range(len(used))]), pa.array(lengths, pa.int32()), pa.array(used, pa.int32()),
                pa.ListArray.from_arrays(pa.array(upto), fields[1]), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), pa.ListArray.from_arrays(pa.array(upto), pieces),
            ]
            bins += len(used)
            held = []
            whole = pa.RecordBatch.from_arrays(columns, names=["bin_id", "bin_length", "bin_used", "doc_ids", "ids", "pieces"])
            for i in range(0, whole.num_rows, 1024):
                yield whole.slice(i, 1024)

        for batch in batches:
            for item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if item[0] != group or len(held) >= chunk:
                    if held:
                        yield from packed()
                    if item[0] != group:
                        group, bins = item[0], 0
                held.append(item)
        if held:
            yield from packed()

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id", row: str | None = None, permitted: Sequence[int] = LENGTHS,
    overhead: int = OVERHEAD, end: int = END, group_pieces: int = GROUP_TEXTS, chunk: int = CHUNK_TEXTS,
) -> DataFrame:
    """One row for each bin: its length, the ids in it, and the documents' pieces with their places."""
    if not permitted or min(permitted) < 1:
        raise ValueError("permitted lengths must be positive")
    prepare(docs.sparkSession)
    groups = max(1, -(-docs.count() // group_pieces))
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    d = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    d = d.mapInArrow(_cut(tokenizer_path, definition, end, max(permitted)), _CUT)
    d = d.select(F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("grp"), "length", "row", "doc_id", "piece", "start", "ids")
    d = d.repartition("grp").sortWithinPartitions("grp", F.desc("length"), "doc_id", "row", "piece")
    return d.mapInArrow(_sequences(tuple(permitted), overhead, chunk), _SEQUENCE)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

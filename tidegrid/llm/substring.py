"""Substring dedup with a log-structured fingerprint index.

Every window of `window` words holds a smallest short print (the hash of `gram` words, leftmost on a
tie); equal windows hold the same one at the same offset. These prints, about one for 14 words, are
the index: immutable runs, one for each batch of documents. A run has its postings (print, row, at),
sorted by print, and the table of its distinct prints, bucketed and sorted by print: a new batch's table
is merge-joined with those of earlier runs, without an exchange of either. `fanout` runs of a level are
compacted to one of the next. Only windows whose smallest print has two postings can repeat. Those
windows are verified: the hashes of all their words, 95 bits of two polynomials, are compared, and both
places are marked. Marked windows cover the words that go.

A RunIndex is kept in a folder, with a manifest that names its runs, and is opened again by any later
session: `add_documents` judges a new batch against itself and all earlier ones, whose texts are kept
beside the runs. `substring_dedup` judges a whole table at once: all its batches are in the index before
windows are verified, on the texts as they came in, so the order of batches does not matter.

Skew: postings are counted with map-side combine and joined on a side that can be split; a task sends
each distinct window at most once and marks further places itself; copies of a whole text send their
windows once. Runs are Parquet tables in a shared folder and outlive executors; a run is in the
manifest only when it is whole.

Defined results: null and empty texts have no words; rows that repeat lose all their words if they
have `window` words or more; shorter texts stay whole; an empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.llm.common import OWN, prepare, read, with_row_id

WINDOW = 35
GRAM = 8
_CACHE = 200_000
_STEP = 1 << 18
_M1, _M2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


class _WordHash(dict):
    """Hash of a word, remembered; bounded by forget()."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _CACHE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_words = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """Print of each `size` words in a row, of words' hashes."""
    n = len(h) - size + 1
    out = h[:n].copy()
    for j in range(1, size):
        out = out * np.uint64(_M1) + h[j : j + n]
    return _mixed(out)


def smallest(g: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest of each `width` prints in a row."""
    n = len(g) - width + 1
    out = np.empty(n, np.int64)
    for i in range(0, n, _STEP):
        part = g[i : min(n, i + _STEP) + width - 1]
        view = np.lib.stride_tricks.sliding_window_view(part, width)
        out[i : i + len(view)] = view.argmin(axis=1) + np.arange(i, i + len(view))
    return out


def _polynomials(h: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """Hash of each `size` words in a row, from sums weighted by powers (all modulo 2^64)."""
    inverse = np.full(len(h), pow(multiplier, -1, 1 << 64), np.uint64)
    power = np.full(len(h), multiplier, np.uint64)
    inverse[0] = power[0] = 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * np.multiply.accumulate(inverse), dtype=np.uint64)))
    n = len(h) - size + 1
    return _mixed((sums[size:] - sums[:n]) * np.multiply.accumulate(power)[:n])


def _postings(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, rows, ats = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or b"").split()
                if len(words) < window:
                    continue
                g = grams(_words.of(words), gram)
                at = np.unique(smallest(g, window - gram + 1))
                prints.append(g[at].view(np.int64))
                rows.append(np.full(len(at), row, np.int64))
                ats.append(at.astype(np.int32))
            if prints:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (prints, rows, ats)], names=["print", "row", "at"])

    return run


def _windows(window: int, gram: int):
    """Windows that may repeat, h1, tail, row: one row for each distinct one of a task's stretch, and marks for its other places.

    tail holds 31 more bits of the hash, whether the window is known to repeat, and the place. A
    known window's row serves as a partner for other tasks' rows; row is null where a whole text
    goes anyhow. Marks are known, and carry a hash of their place instead, so that they spread.
    """

    def sent(parts: list) -> pa.RecordBatch:
        h1, h2, row, at, known = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((h2, h1))
        h1, h2, row, at, known = (x[order] for x in (h1, h2, row, at, known))
        new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        group = np.cumsum(new) - 1
        many = ((np.bincount(group) > 1) | (np.bincount(group, known) > 0))[group]
        keep = new | (many & ~known)  # a whole text's copies are known to go: their places need no marks
        h1 = np.where(new, h1, _mixed(row.view(np.uint64) * np.uint64(_M2) + at.astype(np.uint64)))
        tail = (h2 << np.uint64(33)) | (many.astype(np.uint64) << np.uint64(32)) | at.astype(np.uint64)
        some = np.flatnonzero(keep)
        some = some[np.lexsort((row[some], known[some]))]  # equal neighbours compress well in the shuffle
        return pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)[some]), pa.array(tail.view(np.int64)[some]), pa.array(row[some], mask=known[some])], names=["h1", "tail", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for row, _, text, copied, ats in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = _words.of((text or b"").split())
                g = grams(h, gram)
                repeats = np.zeros(len(g), bool)
                repeats[np.array(ats, np.int64)] = True
                at = np.flatnonzero(repeats[smallest(g, window - gram + 1)])
                if len(at):
                    h1, h2 = _polynomials(h, window, _M1)[at], _polynomials(_mixed(h), window, _M2)[at] >> np.uint64(33)  # 64 and 31 bits
                    parts.append((h1, h2, np.full(len(at), row, np.int64), at, np.full(len(at), copied)))
                    held += len(at)
                if held >= _STEP:
                    yield sent(parts)
                    parts, held = [], 0
        if parts:
            yield sent(parts)

    return run


def _judged(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha, spans = [], [], [], []
            for text, copied, ats in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                words = (text or b"").split()
                n = len(words)
                edge = np.zeros(n + 1, np.int32)
                if copied and n >= window:
                    edge[0], edge[n] = 1, -1
                elif ats:
                    at = np.unique(np.array(ats, np.int64))
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                flips = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).tolist()
                kept, last = [], 0
                for a, b in zip(flips[::2], flips[1::2], strict=True):
                    kept += words[last:a]
                    last = b
                kept += words[last:]
                n_words.append(n)
                n_removed.append(int(gone.sum()))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                spans.append([{"start": a, "stop": b} for a, b in zip(flips[::2], flips[1::2], strict=True)])
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, span)],
                names=["row", "doc_id", "n_words", "n_removed", "kept_sha256", "removed"],
            )

    return run


_POSTING = "print long, row long, at int"
_TEXT = "row long, doc_id long, text binary"
#: A batch's rows are numbered from its number times this on.
_BATCH_ROWS = 1 << 53


class RunIndex:
    """Immutable runs of postings, sorted by print, in levels of a folder; opened again if the folder has a manifest."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 2):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = [[]]
        self.buckets: dict[str, int] = {}
        self.batches: list[str] = []
        self.version = 0
        known = self._files("manifest-*.json")
        if known:
            self.version = max(int(name[9:-5]) for name in known)
            kept = json.loads(spark.read.text(f"{folder}/manifest-{self.version}.json", wholetext=True).first()[0])
            self.levels, self.buckets, self.batches = kept["levels"], kept["buckets"], kept["batches"]

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _files(self, pattern: str) -> list[str]:
        path, fs = self._path(pattern)
        return [x.getPath().getName() for x in fs.globStatus(path) or []]

    def _delete(self, names: list[str]) -> None:
        for name in names:
            path, fs = self._path(name)
            fs.delete(path, True)

    def _save(self) -> None:
        """The state as a new manifest, which is there whole or not at all; then older ones go."""
        old = self._files("manifest-*.json")
        part, fs = self._path(f"_part-{uuid.uuid4().hex}")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps({"levels": self.levels, "buckets": self.buckets, "batches": self.batches}).encode()))
        out.close()
        self.version += 1
        fs.rename(part, self._path(f"manifest-{self.version}.json")[0])
        self._delete(old)

    def _write(self, postings: DataFrame, level: int) -> str:
        name = f"level-{level}-{uuid.uuid4().hex}"
        postings.sortWithinPartitions("print").write.option("compression", "zstd").parquet(f"{self.folder}/{name}/postings")
        self._bucketed(name, self._postings([name]).groupBy("print").agg(F.count(F.lit(1)).alias("n")))
        return name

    def _bucketed(self, name: str, distinct: DataFrame) -> None:
        self.buckets[name] = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        out = distinct.write.format("parquet").bucketBy(self.buckets[name], "print").sortBy("print").option("compression", "zstd")
        out.option("path", f"{self.folder}/{name}/prints").saveAsTable(self._table(name))

    def _compacted(self, names: list[str], level: int) -> str:
        """One run of several: postings sorted anew in fewer, longer files, prints merged as they lie."""
        name = f"level-{level}-{uuid.uuid4().hex}"
        # files are read by size, several to a task: no exchange, and a frequent print stays where it was
        self._postings(names).sortWithinPartitions("print").write.option("compression", "zstd").parquet(f"{self.folder}/{name}/postings")

        def both(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.withColumnRenamed("n", "m")
            return a.join(b, "print", "full").select("print", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

        self._bucketed(name, reduce(both, [self.prints(x) for x in names]))
        return name

    def _table(self, name: str) -> str:
        return "tidegrid_" + name.replace("-", "_")

    def prints(self, name: str) -> DataFrame:
        """(print, n) of a run, bucketed and sorted by print."""
        if not self.spark.catalog.tableExists(self._table(name)):  # written by an earlier session
            place = f"{self.folder}/{name}/prints".replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {self._table(name)} (print BIGINT, n BIGINT) USING parquet CLUSTERED BY (print) SORTED BY (print) INTO {self.buckets[name]} BUCKETS LOCATION '{place}'"
            )
        return self.spark.table(self._table(name))

    def runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def _postings(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(_POSTING).parquet(*[f"{self.folder}/{name}/postings" for name in names])

    def postings(self) -> DataFrame | None:
        return self._postings(self.runs()) if self.runs() else None

    def add(self, postings: DataFrame) -> DataFrame:
        """Write a batch's postings as a new run; returns its prints that repeat, in it or in earlier runs.

        The new run is merge-joined with each run there is. Full levels are compacted afterwards, and
        only when the longer run is in the manifest do its parts go.
        """
        earlier = self.runs()
        name = self._write(postings, 0)
        new = self.prints(name)
        met = [new.filter("n > 1").select("print"), *[new.join(self.prints(r), "print", "left_semi").select("print") for r in earlier]]
        met = reduce(DataFrame.union, met).distinct().checkpoint()
        self.levels[0].append(name)
        self._save()
        level, gone = 0, []
        while len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._compacted(old, level + 1))
            self.levels[level] = []
            gone += old
            level += 1
        if gone:
            self._save()
            self._drop(gone)
        return met

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            self.buckets.pop(name, None)
        self._delete(names)

    def drop(self) -> None:
        self._drop(self.runs())
        self._delete([*self.batches, *self._files("manifest-*.json")])
        self.levels, self.batches = [[]], []

    def places(self, prints: DataFrame) -> DataFrame:
        """(row, ats): where some prints stand."""
        return self.postings().join(prints, "print").groupBy("row").agg(F.collect_list("at").alias("ats"))

    def add_documents(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
        """Judge a new batch against itself and all earlier ones, and put it into the index: as substring_dedup returns it.

        What earlier batches were told stays: of a passage that comes again the first batch keeps its
        words. The texts of rows with a repeated print are read again from the folder.
        """
        prepare(self.spark)
        if len(self.batches) >= (1 << 10) - 1:
            raise ValueError("an index holds 1023 batches")
        name, first = f"texts-{uuid.uuid4().hex}", len(self.batches) * _BATCH_ROWS
        raw = F.col(text).cast("string").cast("binary")
        numbered = docs.select((F.monotonically_increasing_id() + F.lit(first)).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), raw.alias("text"))
        numbered.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        batch = self.spark.read.schema(_TEXT).parquet(f"{self.folder}/{name}")
        self.batches.append(name)  # in the manifest with its run
        met = self.add(batch.select("row", "text").mapInArrow(_postings(window, gram), _POSTING))
        every = self.spark.read.schema(_TEXT).parquet(*[f"{self.folder}/{x}" for x in self.batches])
        repeated = self.places(met).checkpoint()
        some = every.join(repeated.select("row"), "row", "left_semi")
        return _decided(some, batch, repeated, window, gram)


def _decided(some: DataFrame, docs: DataFrame, repeated: DataFrame, window: int, gram: int) -> DataFrame:
    """Of every row of docs: what goes, judged by the windows of `some` rows at the places `repeated`."""
    # whole copies, by 128 bits: the first row of a text speaks for all
    whole = some.select("row", F.unhex(F.md5("text")).alias("same")).filter("same IS NOT NULL").checkpoint()
    copies = whole.groupBy("same").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("same", "first").checkpoint()
    copied = whole.join(copies, "same").select("row", (F.col("row") == F.col("first")).alias("speaks"))
    states = repeated.join(copied, "row", "full").select("row", "ats", F.coalesce("speaks", F.lit(True)).alias("speaks"), F.col("speaks").isNotNull().alias("copied")).checkpoint()
    speakers = states.filter("speaks AND ats IS NOT NULL").select("row", "ats", "copied")
    # doc_id comes along so that both joins with texts read one exchange
    found = some.join(speakers, "row").select("row", "doc_id", "text", "copied", "ats").mapInArrow(_windows(window, gram), "h1 long, tail long, row long")
    same = Window.partitionBy("h1", F.shiftrightunsigned("tail", 33))
    meet = found.withColumn("n", F.count(F.lit(1)).over(same)).filter("row IS NOT NULL AND (n > 1 OR shiftrightunsigned(tail, 32) & 1 = 1)")
    marks = meet.groupBy("row").agg(F.collect_list(F.col("tail").bitwiseAND((1 << 32) - 1).cast("int")).alias("marks"))
    told = states.filter("copied").select("row", "copied")
    marks = marks.join(told, "row", "full").select("row", F.coalesce("copied", F.lit(False)).alias("copied"), "marks")
    out = docs.join(marks, "row", "left").select("row", "doc_id", "text", "copied", "marks")
    return out.mapInArrow(_judged(window), "row long, doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start: long, stop: long>>")


def substring_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None, window: int = WINDOW, gram: int = GRAM, batches: int = 2, fanout: int = 2) -> DataFrame:
    """row, doc_id, n_words, n_removed, kept_sha256 and the removed word spans of every row.

    docs go into an index of their own in `batches`; its runs are dropped once repeated prints are known.
    """
    if not 1 <= gram <= window:
        raise ValueError("a print is of 1 to `window` words")
    spark = docs.sparkSession
    prepare(spark)
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    d = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    base = spark.sparkContext.getCheckpointDir()
    index = RunIndex(spark, f"{base}/runs-{uuid.uuid4().hex}", fanout)
    met = []
    for i in range(batches):
        batch = d.filter(F.pmod(F.xxhash64("row"), F.lit(batches)) == i) if batches > 1 else d
        met.append(index.add(batch.select("row", "text").mapInArrow(_postings(window, gram), _POSTING)))
    out = _decided(d, d, index.places(reduce(DataFrame.union, met).distinct().checkpoint()), window, gram)
    index.drop()  # what is still to run reads checkpoints
    return out


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")

"""Quality rules with an n-gram language model's perplexity bands.

Counted rules come first: too few words, or too many words in repeated three-word windows. The rest
is judged by a modified Kneser-Ney model of characters for each language. Texts are dealt to two folds
by their hash, and each is judged by the model of the other fold: a model that has counted a text's
own gibberish would find it usual. Highest-order counts are taken over all texts, summed in the tasks and then by Spark; lower orders count distinct
continuations; discounts follow from the counts of counts of each language and order. The model is
kept as arrays of 64-bit hashes, sorted, beside arrays of log probabilities. A document's perplexity
that lies beyond its language's band, on either side, rejects it: gibberish and symbols above, what
is all too usual below.

A mean over n symbols strays from that of its language by about 1 / sqrt(n), so the band is as narrow
for a document of n symbols: from the median of log perplexity LOW_WIDTH deviations down and
HIGH_WIDTH up, a deviation being the median, over the language's documents, of the distance to that
median times sqrt(n) (LEAST_DEVIATION at least), divided by sqrt(n). The widths were chosen on one half
of the labelled rows of a sample. A given `width` goes that many deviations to both sides instead.
Medians come from exact histograms.

An n-gram is of `ORDER` symbols: lower-cased letters in 16 bits each (code points beyond share one),
any digit, one space for any white space, three start marks. Four symbols pack into 64 bits, and
the hash is a bijection of them, so there are no collisions.

Size: the number of n-grams is checked, and the arrays are broadcast up to `model_rows` rows; beyond,
documents' own n-gram counts are joined with the model in Spark instead. Both give the same result.

Defined results: null and empty texts have no words and fail; a null language is a language of its
own; rows that repeat are judged alike; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.llm.common import OWN, prepare, read, sliced, with_row_id

ORDER = 4
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
LOW_WIDTH = 5.0
HIGH_WIDTH = 5.0
LEAST_DEVIATION = 0.25
MODEL_ROWS = 4_000_000
#: Bins of a histogram for each unit, and the most that it tells apart.
_BIN = 10_000
_FAR = 100
_CHUNK = 1 << 18
#: n-grams of one language and fold that a task holds before it sums them.
_HELD = 1 << 18

_SPACES = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_NOT_CHARS = _SPACES + bytes(range(0x80, 0xC0))
_START = 1
_SYMBOLS_IN_ALL = 1 << 16
_UNIFORM = math.log(_SYMBOLS_IN_ALL)
_DIGITS = {ord(c): "0" for c in "123456789"}


class _Numbers(dict):
    """Consecutive numbers for words."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def base_counts(text: bytes, numbers: _Numbers) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    n = len(words)
    chars = len(text.translate(None, _NOT_CHARS))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if n > 3:
        if len(numbers) > 150_000:
            numbers.clear()
        w = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
        if n > 1 << 20 or len(numbers) > 1 << 21:  # keep three numbers within 64 bits
            w = np.unique(w, return_inverse=True)[1]
            pairs = np.unique(w[:-1] * (int(w.max()) + 1) + w[1:], return_inverse=True)[1]
            windows = pairs[:-1] * (int(w.max()) + 1) + w[2:]
        else:
            windows = (w[:-2] << 42) | (w[1:-1] << 21) | w[2:]
        order = np.argsort(windows, kind="stable")
        same = np.flatnonzero(windows[order][1:] == windows[order][:-1])
        if len(same):
            at = np.unique(np.concatenate((order[same], order[same + 1])))
            covered = np.zeros(n, bool)
            covered[at] = covered[at + 1] = covered[at + 2] = True
            repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def packed(text: bytes) -> np.ndarray:
    """The four-symbol windows that end in each symbol of a text."""
    plain = b" ".join(text.split()).decode("utf-8", "replace").lower().translate(_DIGITS)
    points = np.frombuffer(plain.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    s = np.concatenate((np.full(ORDER - 1, _START, np.uint64), np.minimum(points, np.uint64(0xFFFF))))
    return (s[:-3] << np.uint64(48)) | (s[1:-2] << np.uint64(32)) | (s[2:-1] << np.uint64(16)) | s[3:]


def hashed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


Part = tuple[str | None, int]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of a task's texts, by language and fold."""
    held: dict[Part, list[np.ndarray]] = {}
    sizes: dict[Part, int] = {}
    sums: dict[Part, tuple[np.ndarray, np.ndarray]] = {}

    def summed(lang: Part) -> None:
        keys = [x for x in held.pop(lang)]
        every = np.sort(np.concatenate(keys))
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        new, n = every[first], np.diff(np.concatenate((first, [len(every)])))
        if lang in sums:
            old, m = sums[lang]
            both, where = np.unique(np.concatenate((old, new)), return_inverse=True)
            total = np.bincount(where, np.concatenate((m, n)), len(both)).astype(np.int64)
            new, n = both, total
        sums[lang] = new, n
        sizes[lang] = 0

    def out(lang: Part) -> Iterator[pa.RecordBatch]:
        keys, n = sums.pop(lang)
        for i in range(0, len(keys), 1 << 20):
            part = keys[i : i + (1 << 20)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang[0]] * len(part), pa.string()), pa.array([lang[1]] * len(part), pa.int32()), pa.array(part.view(np.int64)), pa.array(n[i : i + (1 << 20)].astype(np.int64))],
                names=["lang", "fold", "gram", "n"],
            )

    for batch in sliced(batches):
        for *lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text:
                lang = tuple(lang)
                held.setdefault(lang, []).append(packed(text))
                sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
                if sizes[lang] >= _HELD:
                    summed(lang)
                    if len(sums[lang][0]) > _HELD:  # unlike any language; pass on what there is
                        yield from out(lang)
    for lang in [*held]:
        summed(lang)
    for lang in [*sums]:
        yield from out(lang)


def kneser_ney(grams: DataFrame) -> DataFrame:
    """(lang, fold, order, kind, gram, value) of an interpolated modified Kneser-Ney model of each language and fold.

    grams: (lang, fold, gram, n), distinct. kind p: log probability of a gram's last symbol after those
    before it; kind spare: log of what a context leaves to the next lower order.
    """
    part = ["lang", "fold"]
    tables = {ORDER: grams.select(*part, "gram", F.col("n").cast("double").alias("n"))}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = tables[k + 1].groupBy(*part, F.col("gram").bitwiseAND(F.lit(_mask(k))).alias("gram")).agg(F.count(F.lit(1)).cast("double").alias("n")).checkpoint()
    lower, out = None, []
    for k in range(1, ORDER + 1):
        t = tables[k]
        some = t.groupBy(*part).agg(*[F.sum((F.col("n") == j).cast("double")).alias(f"n{j}") for j in (1, 2, 3, 4)])
        y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.0))

        def discount(j: int, y=y):
            d = j - (j + 1) * y * F.try_divide(F.col(f"n{j + 1}"), F.col(f"n{j}"))
            return F.greatest(F.least(F.coalesce(d, F.lit(0.5)), F.lit(j - 0.05)), F.lit(0.05))  # small corpora give none

        some = some.select(*part, *[discount(j).alias(f"d{j}") for j in (1, 2, 3)])
        t = t.withColumn("context", F.shiftrightunsigned("gram", 16))
        c = t.groupBy(*part, "context").agg(F.sum("n").alias("total"), *[F.sum((F.col("n") == j).cast("double")).alias(f"c{j}") for j in (1, 2)], F.sum((F.col("n") >= 3).cast("double")).alias("c3"))
        c = _same(c, some, part).withColumn("spare", (F.col("d1") * F.col("c1") + F.col("d2") * F.col("c2") + F.col("d3") * F.col("c3")) / F.col("total")).checkpoint()
        t = _same(t, c, [*part, "context"])
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = F.greatest(F.col("n") - off, F.lit(0.0)) / F.col("total")
        if lower is None:
            t = t.withColumn("p", own + F.col("spare") / float(_SYMBOLS_IN_ALL))
        else:
            t = t.withColumn("below", F.col("gram").bitwiseAND(F.lit(_mask(k - 1))))
            t = _same(t, lower.withColumnRenamed("gram", "below").withColumnRenamed("p", "q"), [*part, "below"]).withColumn("p", own + F.col("spare") * F.col("q"))
        lower = t.select(*part, "gram", "p").checkpoint()
        named = [F.lit(k).alias("order"), F.lit("p").alias("kind")]
        out.append(lower.select(*part, *named, "gram", F.log("p").cast("float").alias("value")))
        out.append(c.select(*part, F.lit(k).alias("order"), F.lit("spare").alias("kind"), F.col("context").alias("gram"), F.log("spare").cast("float").alias("value")))
    return reduce(DataFrame.union, out)


def _mask(k: int) -> int:
    """The last k symbols of a gram."""
    return (1 << (16 * k)) - 1 if k < 4 else -1


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys, null equal to null."""
    for k in keys:
        right = right.withColumnRenamed(k, OWN + k)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(OWN + k)) for k in keys])
    return left.join(right, on, how).drop(*[OWN + k for k in keys])


class HashTable:
    """64-bit hashes in ascending order and a value for each, with an index by the top bits."""

    def __init__(self, grams: np.ndarray, values: np.ndarray):
        h = hashed(grams)
        order = np.argsort(h)
        self.hashes = np.concatenate((h[order], np.full(1, (1 << 64) - 1, np.uint64)))  # so that probes end
        self.values = np.concatenate((values[order].astype(np.float32), np.zeros(1, np.float32)))
        self.shift = 64 - max(4, len(h).bit_length())
        self.begins = np.searchsorted(self.hashes, np.arange(1 << (64 - self.shift), dtype=np.uint64) << np.uint64(self.shift)).astype(np.int64)
        self.size = len(h)

    def look(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which grams are in the table, and their values (0 of the others)."""
        h = hashed(grams)
        at = self.begins[(h >> np.uint64(self.shift)).astype(np.int64)]
        todo = np.flatnonzero(self.hashes[at] < h)
        while len(todo):
            at[todo] += 1
            todo = todo[self.hashes[at[todo]] < h[todo]]
        there = (self.hashes[at] == h) & (at < self.size)
        return there, np.where(there, self.values[at], np.float32(0))


class SortedModel:
    """A language's model in one fold: tables of probabilities and spares of each order."""

    def __init__(self, tables: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]):
        self.tables = {k: HashTable(*v) for k, v in tables.items()}

    def total(self, grams: np.ndarray) -> float:
        """Sum of the log probabilities of n-grams; those not counted fall back order by order."""
        total = 0.0
        for i in range(0, len(grams), _CHUNK):
            left = grams[i : i + _CHUNK]
            for k in range(ORDER, 0, -1):
                if ("p", k) not in self.tables:
                    continue
                part = left & np.uint64(_mask(k) & ((1 << 64) - 1))
                there, value = self.tables["p", k].look(part)
                total += float(value.sum(dtype=np.float64))
                left = left[~there]
                if not len(left):
                    break
                total += float(self.tables["spare", k].look(part[~there] >> np.uint64(16))[1].sum(dtype=np.float64))
            total -= len(left) * _UNIFORM
        return total


_BASE = "row long, doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, logp double"


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        models = model.value if model is not None else {}
        nothing = SortedModel({})
        names = [x.split()[0] for x in _BASE.split(", ")]
        for batch in sliced(batches):
            out = []
            for lang, fold, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                text = text or b""
                base = base_counts(text, numbers)
                grams = packed(text) if base[0] else np.zeros(0, np.uint64)
                logp = models.get((lang, fold), nothing).total(grams) if model is not None else 0.0
                out.append((*base, len(grams), logp))
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 6 + [pa.float64()], strict=True)]], names=names)

    return run


def _own_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        for row, _, lang, fold, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text and text.split():
                grams, n = np.unique(packed(text), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(grams), pa.int64()), pa.array([lang] * len(grams), pa.string()), pa.array([fold] * len(grams), pa.int32()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["row", "lang", "fold", "gram", "m"],
                )


def _joined(own: DataFrame, model: DataFrame) -> DataFrame:
    """(row, sum): SortedModel.total of each row's counted grams, by joins."""
    left, sums = own.withColumn("acc", F.lit(0.0)), []
    for k in range(ORDER, 0, -1):
        p = model.filter((F.col("order") == k) & (F.col("kind") == "p")).select("lang", "fold", F.col("gram").alias("part"), F.col("value").cast("double").alias("p"))
        spare = model.filter((F.col("order") == k) & (F.col("kind") == "spare")).select("lang", "fold", F.col("gram").alias("context"), F.col("value").cast("double").alias("spare"))
        met = _same(left.withColumn("part", F.col("gram").bitwiseAND(F.lit(_mask(k)))), p, ["lang", "fold", "part"], "left")
        sums.append(met.filter("p IS NOT NULL").select("row", (F.col("m") * (F.col("acc") + F.col("p"))).alias("sum")))
        missed = met.filter("p IS NULL").withColumn("context", F.shiftrightunsigned("part", 16)).drop("p", "part")
        left = _same(missed, spare, ["lang", "fold", "context"], "left").withColumn("acc", F.col("acc") + F.coalesce("spare", F.lit(0.0))).drop("spare", "context")
    sums.append(left.select("row", (F.col("m") * (F.col("acc") - _UNIFORM)).alias("sum")))
    return reduce(DataFrame.union, sums).groupBy("row").agg(F.sum("sum").alias("sum"))


def _models(model: DataFrame) -> dict[Part, SortedModel]:
    table = model.withColumn("kind", F.col("kind") == "p").toArrow()
    columns = {n: table.column(n).to_numpy() for n in ("fold", "order", "gram", "value")}
    is_p = table.column("kind").to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0, bool)
    langs = table.column("lang").combine_chunks().dictionary_encode()
    number = langs.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    names = [*enumerate(langs.dictionary.to_pylist()), (-1, None)]
    out = {}
    for i, lang in names:
        for fold in (0, 1):
            here = (number == i) & (columns["fold"] == fold)
            tables = {}
            for k in range(1, ORDER + 1):
                for kind, which in (("p", is_p), ("spare", ~is_p)):
                    some = here & which & (columns["order"] == k)
                    if some.any():
                        tables[kind, k] = columns["gram"][some].view(np.uint64), columns["value"][some]
            out[lang, fold] = SortedModel(tables)
    return out


def _medians(df: DataFrame, value: str, name: str) -> DataFrame:
    """(lang, name): the exact lower median of integers, from their counts by language.

    Counts are first summed by 1000 values, then only those of the middle sum are looked at, so a
    task meets few rows of a language however many values there are.
    """
    counts = df.groupBy("lang", value).agg(F.count(F.lit(1)).alias("n")).withColumn("coarse", F.floor(F.col(value) / 1000)).checkpoint()
    by = Window.partitionBy("lang")
    sums = counts.groupBy("lang", "coarse").agg(F.sum("n").alias("n"))
    sums = sums.withColumn("upto", F.sum("n").over(by.orderBy("coarse"))).withColumn("all", F.sum("n").over(by)).filter(F.col("upto") * 2 >= F.col("all"))
    middle = sums.groupBy("lang").agg(F.min(F.struct("coarse", (F.col("upto") - F.col("n")).alias("before"), "all")).alias("m")).select("lang", "m.*")
    fine = _same(counts, middle, ["lang", "coarse"]).withColumn("upto", F.col("before") + F.sum("n").over(by.orderBy(value)))
    return fine.filter(F.col("upto") * 2 >= F.col("all")).groupBy("lang").agg(F.min(value).alias(name))


def quality(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", row: str | None = None, width: float | None = None, model_rows: int = MODEL_ROWS) -> DataFrame:
    """Of every row: row, doc_id, lang, the counts, log_perplexity, low and high of its band, base_failed and kept."""
    spark = docs.sparkSession
    prepare(spark)
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    raw = F.col(text).cast("string").cast("binary")
    fold = F.pmod(F.xxhash64(raw), F.lit(2)).cast("int")
    d = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), fold.alias("fold"), raw.alias("text"))
    # what the texts of one fold have is the model of the other
    counted = d.select("lang", (1 - F.col("fold")).alias("fold"), "text").mapInArrow(_measured, "lang string, fold int, gram long, n long")
    model = kneser_ney(counted.groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n")).checkpoint()).checkpoint()
    if model.count() <= model_rows:
        # model_rows rows at most, of 8 + 4 bytes: the check above bounds what driver and executors hold
        shared = spark.sparkContext.broadcast(_models(model))
        scored = d.mapInArrow(_scored(shared), _BASE).checkpoint()
        shared.destroy()  # workers let go of it
    else:
        sums = _joined(d.mapInArrow(_own_grams, "row long, lang string, fold int, gram long, m long"), model)
        scored = d.mapInArrow(_scored(None), _BASE).join(sums, "row", "left").withColumn("logp", F.coalesce("sum", F.lit(0.0))).drop("sum").checkpoint()
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed).withColumn("log_perplexity", F.when(F.col("n_grams") > 0, -F.col("logp") / F.col("n_grams")))
    scored = scored.withColumn("bin", F.round(F.col("log_perplexity") * _BIN).cast("long"))
    judged = scored.filter("NOT base_failed")
    middle = _medians(judged, "bin", "middle")
    apart = F.abs(F.col("bin") - F.col("middle")) * F.sqrt("n_grams")
    apart = _same(judged.select("lang", "bin", "n_grams"), middle, ["lang"]).withColumn("apart", F.least(F.round(apart).cast("long"), F.lit(_FAR * _BIN)))
    bands = _same(middle, _medians(apart, "apart", "mad"), ["lang"])
    deviation = F.greatest(F.col("mad") / _BIN, F.lit(LEAST_DEVIATION))
    bands = bands.select(F.col("lang").alias(OWN + "lang"), (F.col("middle") / _BIN).alias(OWN + "middle"), deviation.alias(OWN + "deviation"))
    out = scored.join(bands, F.col("lang").eqNullSafe(F.col(OWN + "lang")), "left")
    reach = F.when(F.col("n_grams") > 0, F.col(OWN + "deviation") / F.sqrt("n_grams"))
    low, high = (LOW_WIDTH, HIGH_WIDTH) if width is None else (width, width)
    out = out.withColumn("low", F.col(OWN + "middle") - reach * low).withColumn("high", F.col(OWN + "middle") + reach * high)
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high"))
    out = out.withColumn("kept", F.coalesce(~F.col("base_failed") & inside, F.lit(False)))
    return out.drop(OWN + "lang", OWN + "middle", OWN + "deviation", "bin", "logp", "n_grams")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "log_perplexity", "low", "high")

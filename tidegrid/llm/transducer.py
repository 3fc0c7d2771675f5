"""Token counts by a finite-state transducer compiled from a byte-pair vocabulary.

In byte-pair encoding the last token of every prefix of a text is unique, and a token may follow
another if and only if the two alone encode to themselves. So a text can be read from left to right:
the state is the longest suffix that some token could still extend past, with the last token and the
relative token count at each position in it; a character leads to the next state and emits the
change of the token count. That is a deterministic transducer. It is compiled lazily: a state or
transition is made when it is first met, and all are dropped at a bound of both together, also within
a text. Whether two tokens encode to themselves is told from the merges that make each of them: those
go on side by side, unless one across the joint is better. They are kept for each token of the vocabulary.

Where two neighbouring characters stand together in no token, no token crosses: the state returns to
the start whatever came before. So the map that a chunk of text makes of states has a short form, valid
for every state it may start in: what stands before the chunk's first such place is still to be read
from the state; what comes after adds a fixed count and leads to a fixed state. These maps compose
associatively. Texts of more than `chunk_bytes` become rows of chunks, whose maps are made in parallel,
in any order and on any executor, and composed in rounds, neighbours first. A map names its state by
content, not by number, as each worker compiles its own part of the transducer. A chunk without such a
place (a megabyte of one letter) is read when its neighbour's state is known.

Spaces begin units that no token crosses; the counts of short whole units are remembered, up to a bound.

Scope: SentencePiece byte-pair models with byte fallback, without text normalisation or user-defined
symbols, as `compile_counter` checks; others are refused.

Defined results: a null text is empty and has no tokens; rows that repeat are counted each; an
empty table gives no rows; texts of any length are read whole. Other columns are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import OWN, prepare, read, sliced, with_row_id

LIMIT = 4096
SPACE = "▁"
CHUNK_BYTES = 1 << 20
#: States and transitions, and units, that a worker remembers at most; each about 100 to 200 bytes.
_MOST_STEPS = 450_000
_MOST_UNITS = 200_000
_SHORT = 64


#: Content of the state before any text.
_START = ("", (None,), (0,))


class CountingTransducer:
    def __init__(self, scores: dict[str, float]):
        """scores: of the tokens; of two neighbours the pair that makes the token of the highest score merges first."""
        self.scores = scores
        self.heads = {h: h for t in scores for h in (t[:i] for i in range(1, len(t)))}
        self._tokens = {t: t for t in scores}  # states share these strings and counts, not copies
        self._relative: dict[tuple, tuple] = {}
        self._merges: dict[str, tuple | None] = {}
        self.pairs = {t[i : i + 2] for t in scores for i in range(len(t) - 1)}
        self._clear()

    def _clear(self) -> None:
        self.size = 0  # states and transitions
        self._relative.clear()
        self._numbers: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self.next: list[dict[str, tuple[int, int]]] = []

    def _number(self, state: tuple) -> int:
        n = self._numbers.get(state)
        if n is None:
            n = self._numbers[state] = len(self._states)
            self._states.append(state)
            self.next.append({})
            self.size += 1
        return n

    def encoded(self, text: str) -> list[str]:
        """Byte-pair encoding by repeated merging; only used on tokens, to compile."""
        return self._merged(text)[0]

    def _merged(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """What a text encodes to, and of each merge on the way the score, the first part and the last part before it."""
        parts, steps = list(text), []
        while True:
            best = max(((self.scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.scores), default=None)
            if best is None:
                return parts, steps
            steps.append((best[0], parts[0], parts[-1]))
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _ends(self, token: str) -> tuple | None:
        """Scores of the merges that make a token, and its first and last parts between them; None if it encodes to something else."""
        if len(token) == 1:
            return (-math.inf,), (token,), (token,)
        if token not in self._merges:  # of tokens only: no more than the vocabulary
            parts, steps = self._merged(token)
            name = self._tokens[token]
            told = [(x, self._tokens.get(a, a), self._tokens.get(b, b)) for x, a, b in steps] + [(-math.inf, name, name)]
            self._merges[name] = tuple(zip(*told, strict=True)) if len(parts) == 1 else None
        return self._merges[token]

    def _may_follow(self, last: str | None, token: str) -> bool:
        """Do the two alone encode to themselves? Their own merges go on, best first, unless one across the joint is better."""
        after = self._ends(token)
        if after is None or not last:
            return after is not None
        before = self._ends(last)
        if before is None:
            return False
        (x, _, ends), (y, starts, _), scores = before, after, self.scores
        i = j = 0
        while True:
            across = scores.get(ends[i] + starts[j])
            if across is None:
                if x[i] == y[j] == -math.inf:
                    return True
            elif across > x[i] and across >= y[j]:  # of equal ones the first in the text goes first
                return False
            if x[i] >= y[j]:
                i += 1
            else:
                j += 1

    def _weight(self, token: str) -> int:
        return 1 if token in self.scores else len(token.encode())

    def _step(self, state: int, char: str) -> tuple[int, int]:
        tail, lasts, counts = self._states[state]
        if lasts[-1] is not None and lasts[-1][-1] + char not in self.pairs:
            tail, lasts, counts = "", (None,), (0,)  # no token crosses this place
        tail += char
        n, token, emitted, live = len(tail), None, 0, []
        for i, last in enumerate(lasts):
            if last == "":
                continue
            part = tail[i:]
            if token is None and (part in self.scores or i == n - 1) and self._may_follow(last, part):
                token, emitted = self._tokens.get(part, part), counts[i] + self._weight(part)
            if part in self.heads:
                live.append(i)
        if token is None:  # pragma: no cover - a single character may follow unless a longer token does
            raise AssertionError(f"no token ends {tail!r}")
        if not live:
            return self._number(("", (token,), (0,))), emitted
        # only places that a token could still extend from matter later, and the end
        cut = live[0]
        ends, relative = [""] * (n - cut), [0] * (n - cut + 1)
        for i in live:
            ends[i - cut], relative[i - cut] = lasts[i], counts[i] - emitted
        told = tuple(relative)
        return self._number((self.heads[tail[cut:]], (*ends, token), self._relative.setdefault(told, told))), emitted

    def run(self, state: tuple, text: str) -> tuple[tuple, int]:
        """The state, by content, that a text leads to, and the change of the token count on the way."""
        at, total, after = self._number(state), 0, self.next
        for char in text:
            step = after[at].get(char)
            if step is None:
                if self.size + 2 > _MOST_STEPS:  # also within a long text
                    state = self._states[at]
                    self._clear()
                    at, after = self._number(state), self.next
                step = after[at][char] = self._step(at, char)
                self.size += 1
            at = step[0]
            total += step[1]
        return self._states[at], total

    def count(self, unit: str) -> int:
        """Tokens of a text, read from the start state."""
        return self.run(_START, unit)[1]


class _Units(dict):
    """Token counts of units; a unit is given without its first space."""

    def __init__(self, machine: CountingTransducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, unit: bytes) -> int:
        n = self.machine.count(SPACE + unit.decode("utf-8", "replace").replace(" ", SPACE))
        if len(unit) <= _SHORT:
            if len(self) >= _MOST_UNITS:
                self.clear()
            self[unit] = n
        return n


_SPACES = re.compile(rb" +[^ ]*")
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")


class ChunkMap:
    """What a chunk makes of a state: `head` is read from it; then `count` tokens more and the state `end` (None: all of it is head)."""

    __slots__ = ("count", "end", "head")

    def __init__(self, head: str, count: int, end: tuple | None):
        self.head, self.count, self.end = head, count, end

    @classmethod
    def of(cls, chunk: str, units: _Units) -> ChunkMap:
        pairs = units.machine.pairs
        cut = next((i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in pairs), None)
        if cut is None:
            return cls(chunk, 0, None)
        head, rest = chunk[:cut], chunk[cut:]
        first = rest.find(SPACE)
        parts = _UNIT.findall(rest, first) if first >= 0 else []
        opening, last = (rest[:first], parts.pop()) if parts else (rest, "")
        total = sum(units[p[1:].replace(SPACE, " ").encode()] for p in parts)
        if last:
            total += units.machine.count(opening)
            end, n = units.machine.run(_START, last)
        else:
            end, n = units.machine.run(_START, opening)
        return cls(head, total + n, end)

    def then(self, other: ChunkMap, units: _Units) -> ChunkMap:
        if self.end is None:
            return ChunkMap(self.head + other.head, other.count, other.end)
        end, n = units.machine.run(self.end, other.head)
        return ChunkMap(self.head, self.count + n + other.count, end if other.end is None else other.end)

    def tokens(self, units: _Units) -> int:
        """Tokens of a text with this map; a space goes before it."""
        state, n = units.machine.run(_START, SPACE)
        return n + units.machine.run(state, self.head)[1] + self.count


def scan(maps: list[ChunkMap], units: _Units) -> ChunkMap:
    """All maps composed, neighbours first, in rounds that halve their number."""
    while len(maps) > 1:
        maps = [maps[i].then(maps[i + 1], units) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


class TokenCounter:
    def __init__(self, machine: CountingTransducer, chunk_bytes: int = CHUNK_BYTES):
        if any(p[1] == SPACE and p[0] != SPACE for p in machine.pairs):
            raise ValueError("a token goes across a space")
        self.units, self.chunk_bytes = _Units(machine), chunk_bytes
        self.mark = SPACE.encode()

    def count(self, text: bytes) -> int:
        if not text:
            return 0
        if self.mark in text:
            text = text.replace(self.mark, b" ")  # both are the same symbol
        if len(text) <= self.chunk_bytes:
            if b"  " not in text and text[:1] != b" ":
                return sum(map(self.units.__getitem__, text.split(b" ")))  # each unit is one space and a word; a space goes first
            return sum(self.units[p[1:]] for p in _SPACES.findall(b" " + text))
        maps = [self.chunk_map(text[i : i + self.chunk_bytes + 3], i, self.chunk_bytes) for i in range(0, len(text), self.chunk_bytes)]
        return scan(maps, self.units).tokens(self.units)

    def chunk_map(self, piece: bytes, place: int, size: int) -> ChunkMap:
        """Map of the characters that begin in `size` bytes from `place` on; piece has up to three bytes more."""
        begin, end = 0, min(size, len(piece))
        while place and begin < min(3, len(piece)) and piece[begin] & 0xC0 == 0x80:
            begin += 1
        while end < len(piece) and piece[end] & 0xC0 == 0x80:
            end += 1
        return ChunkMap.of(piece[begin:end].decode("utf-8", "replace").replace(" ", SPACE), self.units)


_compiled: dict[str, TokenCounter] = {}


def compile_counter(model: bytes) -> TokenCounter:
    """From the bytes of a SentencePiece model file."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(model)
    n, t = m.normalizer_spec, m.trainer_spec
    kinds = {p.type for p in m.pieces}
    if t.model_type != t.BPE or not t.byte_fallback or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces or t.treat_whitespace_as_suffix or kinds & {4, 5}:
        raise ValueError("only byte-pair models with byte fallback and no normalisation can be compiled")
    return TokenCounter(CountingTransducer({p.piece: p.score for p in m.pieces if p.type == 1}))


def _counter(name: str, model: bytes) -> TokenCounter:
    if name not in _compiled:  # once for each Python worker
        _compiled[name] = compile_counter(model)
    return _compiled[name]


_OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _counts(name: str, model: bytes, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(name, model)
        for batch in sliced(batches):
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            n = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


_MAP = "row long, doc_id long, n_bytes long, at long, head string, count long, end string"


def _maps(name: str, model: bytes, size: int) -> Callable:
    """The map of each chunk; its state as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(name, model)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                m = counter.chunk_map(one.column(4)[0].as_py(), one.column(3)[0].as_py(), size)
                told = [pa.array([m.head]), pa.array([m.count], pa.int64()), pa.array([None if m.end is None else json.dumps(m.end)], pa.string())]
                yield pa.RecordBatch.from_arrays([*one.columns[:4], *told], names=[x.split()[0] for x in _MAP.split(", ")])

    return run


def _composed(name: str, model: bytes, limit: int) -> Callable:
    """Counts of texts whose chunks' maps come together and in order; at most one row for each chunk of one text is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(name, model)
        row, held = None, []

        def told() -> pa.RecordBatch:
            maps = [ChunkMap(head, count, None if end is None else tuple(tuple(x) if isinstance(x, list) else x for x in json.loads(end))) for *_, head, count, end in held]
            n = scan(maps, counter.units).tokens(counter.units)
            return pa.RecordBatch.from_arrays(
                [pa.array([held[0][1]], pa.int64()), pa.array([held[0][2]], pa.int64()), pa.array([n], pa.int64()), pa.array([n > limit])], names=["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

        for batch in batches:
            for item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and item[0] != row:
                    yield told()
                    held = []
                row = item[0]
                held.append(item)
        if held:
            yield told()

    return run


def token_counts(docs: DataFrame, model_path: str, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; the model goes to executors with the code."""
    prepare(docs.sparkSession)
    with open(model_path, "rb") as f:
        model = f.read()
    rows = with_row_id(docs, OWN + "row")
    d = rows.select(F.col(OWN + "row").alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    long = F.octet_length("text") > chunk_bytes
    short = d.filter(F.col("text").isNull() | ~long).select("doc_id", "text").mapInArrow(_counts(model_path, model, limit), _OUT)
    # the mark of a space and a space are the same symbol; a chunk has the bytes of a character that it begins
    plain = d.filter(long).withColumn("n_bytes", F.octet_length("text").cast("long")).withColumn("text", F.replace(F.col("text").cast("string"), F.lit(SPACE), F.lit(" ")).cast("binary"))
    chunks = plain.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.octet_length("text").cast("long") - 1, F.lit(chunk_bytes).cast("long"))))
    chunks = chunks.select("row", "doc_id", "n_bytes", "at", F.expr(f"substring(text, CAST(at AS INT) + 1, {chunk_bytes + 3})").alias("piece"))
    maps = chunks.repartition("row", "at").mapInArrow(_maps(model_path, model, chunk_bytes), _MAP)
    whole = maps.repartition("row").sortWithinPartitions("row", "at").mapInArrow(_composed(model_path, model, limit), _OUT)
    return short.union(whole)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))

"""Token ids as files of Huffman-coded blocks.

Ids are counted over all texts; a canonical Huffman code of at most `MOST_BITS` bits follows from
the counts, and its code lengths are the whole header. Each document's ids are coded on their own,
padded to whole bytes, with a checkpoint (the bit offset) every `STRIDE` ids. Documents are
range-partitioned by doc_id and row number, so that one id fills no range, and sorted; every `BLOCK_DOCS` or `BLOCK_BYTES` of them make a block,
which can be decoded alone. Decoding reads a table indexed by the next MOST_BITS bits and
runs all checkpoints of a block in step.

File format (a folder): `header`, one row with the code length of each id; `blocks`, Parquet rows of
part, seq (blocks in ascending order of doc_id), doc_ids, rows, n_ids and n_bits of each document,
checkpoints (bit offsets in the payload) and payload.

Tokenizing happens once; ids are staged as 16-bit numbers in the shared checkpoint folder, since the
code needs the counts of all. A white-space-separated word's ids don't depend on its neighbours
with this tokenizer, so each worker remembers words; words of letters of ASCII and Latin-1 and
ASCII marks are normalised and split here and their pieces encoded in bulk by the library's model,
all others go through the whole library pipeline one by one.

Defined results: a null text is empty and has the end id alone; a null doc_id sorts first; rows that
repeat are all written; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import OWN, prepare, read, running_total, sliced, with_row_id

END = 1
MOST_BITS = 18
STRIDE = 256
BLOCK_DOCS = 512
BLOCK_BYTES = 1 << 22
_PLAIN_BYTES = np.zeros(256, bool)
_PLAIN_BYTES[0x21:0x7F] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BLANK = re.compile(rb"[ \t\n\v\f\r]")
#: The tokenizer's own split pattern, on words of ASCII and of Latin-1 letters; no piece holds a line feed.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-zß-öø-ÿ0-9]+")
_CHUNK = 1 << 19
_SLOT_BITS = 22
_SLOTS = 1 << _SLOT_BITS
_MOST_WORDS = 2_300_000
_EIGHT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_keys(raw: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: of up to eight bytes a bijection, of up to 24 a mix, of more a digest.

    WordIds uses 63 bits of it, and 32 of the word's length and letters beside them.
    """
    padded = raw + b"\0" * 24
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # eight bytes from every place on
    size = stop - start
    keys = eight[start] & _EIGHT[np.minimum(size, 8)]
    for k in (8, 16):
        more = np.flatnonzero(size > k)
        keys[more] = _mixed(keys[more]) + (eight[start[more] + k] & _EIGHT[np.minimum(size[more] - k, 8)])
    more = np.flatnonzero(size > 24)
    if len(more):
        keys[more] = [xxhash.xxh64_intdigest(raw[x:y]) for x, y in zip(start[more].tolist(), stop[more].tolist(), strict=True)]
    return _mixed(keys)


class WordIds:
    """Ids of the words of texts, from a table of words that were met before.

    A chunk of text is cut to words and the words hashed in whole arrays, to 64 bits beside the length
    and three of the bytes themselves. The table is open addressing over arrays; words
    that it lacks are encoded by the library, each once, and put in. A full table is emptied.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.loads(definition)
        self.whole = Tokenizer.from_str(definition)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        shape = json.dumps([spec["normalizer"], spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]])
        specials = [t["content"] for t in spec["added_tokens"]]
        self.bulk = None
        if shape == _KNOWN_SHAPE and spec["model"].get("end_of_word_suffix") == "</w>" and all(x.startswith("<|") for x in specials):
            self.bulk = Tokenizer(self.whole.model)
            self.bulk.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.last = np.zeros(1 << 16, bool)
            for token, i in spec["model"]["vocab"].items():
                self.last[i] = token.endswith("</w>")
        self._empty()

    def _empty(self) -> None:
        self.keys, self.checks = np.zeros(_SLOTS, np.uint64), np.zeros(_SLOTS, np.uint32)
        self.begin, self.size = np.zeros(_SLOTS, np.int32), np.zeros(_SLOTS, np.int32)
        self.pool, self.used, self.words = np.zeros(1 << 20, np.uint16), 0, 0

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Slot of each key; below 0 if it isn't there."""
        slot = (keys >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            there = self.keys[at]
            hit = (there == keys[todo]) & (self.checks[at] == checks[todo])
            out[todo[hit]] = at[hit]
            todo = todo[~hit & (there != 0)]
            slot[todo] = (slot[todo] + 1) & (_SLOTS - 1)
        return out

    def _put(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """New distinct keys and their ids, one word's after another's."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint16)))
        self.pool[self.used : self.used + len(ids)] = ids
        begins = np.concatenate(([0], ends[:-1]))
        slot = (keys >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            self.keys[slot[free]] = keys[free]  # of several for one slot the last stays
            self.checks[slot[free]] = checks[free]
            at = slot[free]
            mine = (self.keys[at] == keys[free]) & (self.checks[at] == checks[free])
            self.begin[at[mine]] = self.used + begins[free[mine]]
            self.size[at[mine]] = (ends - begins)[free[mine]]
            todo = np.setdiff1d(todo, free[mine], assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (_SLOTS - 1)
        self.used += len(ids)
        self.words += len(keys)

    def _encoded(self, words: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' order, their ids, and where each one's ids end."""
        easy = np.flatnonzero(plain) if self.bulk is not None else np.zeros(0, np.int64)
        rest = np.flatnonzero(~plain) if self.bulk is not None else np.arange(len(words))
        ids, ends, total = [], [], 0
        if len(easy):
            # in lower case, pieces parted by blanks, a line a word; the same pieces come again and again
            text = _PIECES.sub(r"\g<0> ", b"\n".join([words[k] for k in easy.tolist()]).decode().lower()).encode()
            _, size, got = self._chunk(text, leaves=True)
            marks = np.frombuffer(text + b"\n", np.uint8)
            pieces = np.cumsum(marks == 32)[marks == 10]
            ids.append(got)
            ends.append(np.cumsum(size)[pieces - 1])
            total = len(got)
        if len(rest):
            texts = [words[k].decode("utf-8", "replace") for k in rest.tolist()]
            got = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            ids.append(np.array([x for g in got for x in g], np.uint16))
            ends.append(total + np.cumsum([len(g) for g in got]))
        return np.concatenate((easy, rest)), np.concatenate(ids), np.concatenate(ends).astype(np.int64)

    def _leaves(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As _encoded, of pieces that the model takes as they are."""
        ids, ends, total = [], [], 0
        for i in range(0, len(pieces), 2000):
            part = pieces[i : i + 2000]
            (one,) = self.bulk.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
            got = np.array(one.ids, np.uint16)
            stops = np.flatnonzero(self.last[got]) + 1
            if len(stops) != len(part):  # pragma: no cover - a piece always ends in a word-end token
                raise AssertionError("pieces and word ends differ")
            ids.append(got)
            ends.append(total + stops)
            total += len(got)
        return np.arange(len(pieces)), np.concatenate(ids), np.concatenate(ends)

    def _chunk(self, raw: bytes, leaves: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where words begin, how many ids each has, and all the ids of a text."""
        b = np.frombuffer(raw, np.uint8)
        space = _SPACE[b]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        start, stop = edge[::2], edge[1::2]
        if not len(start):
            return start, np.zeros(0, np.int64), np.zeros(0, np.uint16)
        keys = word_keys(raw, start, stop)
        keys |= np.uint64(1)  # no key is 0, which marks a free slot
        checks = ((stop - start) << 24 | b[start].astype(np.int64) << 16 | b[(start + stop) >> 1].astype(np.int64) << 8 | b[stop - 1]).astype(np.uint32)
        if self.words > _MOST_WORDS and not leaves:
            self._empty()
        slot = self._find(keys, checks)
        new = np.flatnonzero(slot < 0)
        if len(new):
            order = np.lexsort((checks[new], keys[new]))
            k, c = keys[new][order], checks[new][order]
            first = new[order[np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))]]
            words = [raw[x:y] for x, y in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
            if leaves:
                order, ids, ends = self._leaves(words)
            else:
                order, ids, ends = self._encoded(words, _plain(words))
                # a piece may have been put in for a word of the same letters
                fresh = self._find(keys[first][order], checks[first][order]) < 0
                size = np.diff(ends, prepend=0)
                order, ids, ends = order[fresh], ids[np.repeat(fresh, size)], np.cumsum(size[fresh])
            if len(order):
                self._put(keys[first][order], checks[first][order], ids, ends)
            slot[new] = self._find(keys[new], checks[new])
        size = self.size[slot].astype(np.int64)
        total = np.cumsum(size)
        return start, size, self.pool[np.repeat(self.begin[slot] - (total - size), size) + np.arange(total[-1])]

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text. Short texts go together; a long one goes in parts that end at white space."""
        out: list[np.ndarray] = []
        held: list[bytes] = []
        length = 0

        def flush() -> None:
            nonlocal held, length
            start, size, ids = self._chunk(b" ".join(held))
            begins = np.cumsum([0, *[len(t) + 1 for t in held]])
            upto = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, begins)].tolist()
            out.extend(ids[x:y] for x, y in zip(upto, upto[1:], strict=False))
            held, length = [], 0

        for t in texts:
            if held and length + len(t) > _CHUNK:
                flush()
            if len(t) > _CHUNK:
                parts, at = [], 0
                while at < len(t):
                    blank = _BLANK.search(t, at + _CHUNK)
                    end = blank.start() if blank else len(t)
                    parts.append(self._chunk(t[at:end])[2])
                    at = end
                out.append(np.concatenate(parts))
                continue
            held.append(t)
            length += len(t) + 1
        if held:
            flush()
        return out


_KNOWN_SHAPE = json.dumps(
    [
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    ]
)
_loaded: dict[str, WordIds] = {}


def loaded(path: str, definition: str) -> WordIds:
    """The words of a tokenizer, once for each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordIds(definition)
    return _loaded[path]


def _plain(words: list[bytes]) -> np.ndarray:
    """Which words are of printable ASCII and letters of Latin-1, without what may be a special token."""
    b = np.frombuffer(b"\n".join([*words, b""]), np.uint8)
    trail = np.concatenate(([False], b[:-1] == 0xC3)) & (b >= 0x80) & (b < 0xC0) & (b != 0x97) & (b != 0xB7)
    odd = ~_PLAIN_BYTES[b] & (b != 0xC3) & ~trail & (b != 10)
    odd[:-1] |= ((b[:-1] == 60) & (b[1:] == 124)) | ((b[:-1] == 0xC3) & ~trail[1:])
    ends = np.flatnonzero(b == 10)
    return np.diff(np.cumsum(odd)[ends], prepend=0) == 0


def forget(path: str) -> None:
    """Let a worker's table of words go, a hundred megabytes, where other work follows."""
    _loaded.pop(path, None)


_STAGED = "row long, doc_id long, ids binary, counted array<int>, n array<long>"


def _tokenized(path: str, definition: str, end: int):
    """Each document's ids, and a last row with how often the task has seen each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tail = loaded(path, definition), np.array([end], "<u2").tobytes()
        total = np.zeros(1 << 16, np.int64)
        names, ints, longs = [x.split()[0] for x in _STAGED.split(", ")], pa.list_(pa.int32()), pa.list_(pa.int64())
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                ids = words.ids([t or b"" for t in part.column(2).to_pylist()])
                total += np.bincount(np.concatenate(ids), minlength=1 << 16)
                total[end] += len(ids)
                raw = pa.array([x.astype("<u2").tobytes() + tail for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), raw, pa.nulls(len(ids), ints), pa.nulls(len(ids), longs)], names=names)
        at = np.flatnonzero(total)
        nothing = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
        yield pa.RecordBatch.from_arrays([*nothing, pa.array([at.astype(np.int32)], ints), pa.array([total[at]], longs)], names=names)

    return run


def code_lengths(counts: dict[int, int], most: int = MOST_BITS) -> dict[int, int]:
    """Code length of each id: Huffman's, limited to `most` bits, as the package-merge algorithm gives them."""
    if len(counts) > 1 << most:
        raise ValueError("too many ids for codes of so few bits")
    if len(counts) == 1:
        return dict.fromkeys(counts, 1)
    order = sorted(counts, key=lambda i: (counts[i], i))
    # try plain Huffman first: within the limit it is the same optimum
    heap = [(counts[i], k, (k,)) for k, i in enumerate(order)] if len(order) < 64 else None
    if heap:
        depth = [0] * len(order)
        heapq.heapify(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for k in a[2] + b[2]:
                depth[k] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(depth) <= most:
            return {i: depth[k] for k, i in enumerate(order)}
    weights = np.array([counts[i] for i in order], np.float64)
    n = len(order)
    # level by level: merge the leaves with the packages of the level below; keep which entries are leaves
    packages = np.zeros(0)
    leaves: list[np.ndarray] = []
    for _ in range(most):
        every = np.concatenate((weights, packages))
        at = np.argsort(every, kind="stable")
        every = every[at]
        leaves.append(at < n)
        even = len(every) // 2 * 2
        packages = every[0:even:2] + every[1:even:2]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for is_leaf in reversed(leaves):
        some = int(is_leaf[:take].sum())
        lengths[:some] += 1
        take = 2 * (take - some)
    return {i: int(x) for i, x in zip(order, lengths, strict=True)}


def canonical(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and lengths by id (length 0: no code); shorter codes first, then by id."""
    size = max(lengths) + 1
    codes, bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
    code = before = 0
    for i in sorted(lengths, key=lambda i: (lengths[i], i)):
        code <<= lengths[i] - before
        codes[i], bits[i], before = code, lengths[i], lengths[i]
        code += 1
    return codes, bits


def encode(ids: np.ndarray, codes: np.ndarray, bits: np.ndarray, stride: int = STRIDE) -> tuple[bytes, int, np.ndarray]:
    """Payload, its bits, and the bit offset of every stride-th id."""
    payload, ends, total, marks, _ = encode_many(ids, np.array([len(ids)]), codes, bits, stride)
    return payload.tobytes(), int(total[0]), marks


def encode_many(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, bits: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents one after another, each from a whole byte on.

    Payload, where each document's bytes end, its bits, the bit offsets in it of every stride-th id,
    and how many of these each document has.
    """
    n = bits[ids]
    stop = np.cumsum(n)
    last = np.cumsum(lengths)
    upto = np.concatenate((np.zeros(1, np.int64), stop))[np.concatenate((np.zeros(1, np.int64), last))]
    total = np.diff(upto)
    ends = np.cumsum((total + 7) >> 3)
    base = np.concatenate((np.zeros(1, np.int64), ends[:-1])) << 3
    start = stop - n + np.repeat(base - upto[:-1], lengths)
    word = start >> 6
    room = 64 - (start & 63) - n  # below 0: the code runs over into the next word
    code = codes[ids]
    out = np.zeros(((int(ends[-1]) if len(ends) else 0) >> 3) + 2, np.uint64)
    if len(ids):
        over = np.flatnonzero(room < 0)
        spill = room[over]
        room[over] = 0
        first = code << room.astype(np.uint64)
        first[over] = code[over] >> (-spill).astype(np.uint64)
        turn = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[turn]] = np.add.reduceat(first, turn)  # the codes of a word have no bit in common
        out[word[over] + 1] += code[over] << (64 + spill).astype(np.uint64)
    counts = -(-lengths // stride)
    before = np.cumsum(counts) - counts
    at = (np.arange(int(counts.sum())) - np.repeat(before, counts)) * stride
    marks = start[at + np.repeat(last - lengths, counts)] - np.repeat(base, counts) if len(at) else np.zeros(0, np.int64)
    return out.astype(">u8").view(np.uint8)[: int(ends[-1]) if len(ends) else 0], ends, total, marks, counts


class Decoder:
    def __init__(self, codes: np.ndarray, bits: np.ndarray):
        self.most = int(bits.max())
        self.table = np.zeros(1 << self.most, np.uint32)
        for i in np.flatnonzero(bits).tolist():
            free = self.most - int(bits[i])
            a = int(codes[i]) << free
            self.table[a : a + (1 << free)] = (i << 5) | int(bits[i])

    def decode(self, payload: bytes, offsets: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """The ids after each offset, so many as counts says; all offsets go in step."""
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        four = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        order = np.argsort(-counts, kind="stable")
        at, left = offsets[order].astype(np.int64), counts[order]
        steps = int(left[0]) if len(left) else 0
        out = np.zeros((len(left), steps), np.uint16)
        shift = np.uint32(32 - self.most)
        for k in range(steps):
            live = int(np.searchsorted(-left, -k, side="left"))  # those with more than k ids
            here = at[:live]
            entry = self.table[(four[here >> 3] << (here & 7).astype(np.uint32)) >> shift]
            out[:live, k] = entry >> 5
            at[:live] += entry & 31
        result: list[np.ndarray] = [None] * len(left)  # type: ignore[list-item]
        for place, k in enumerate(order.tolist()):
            result[k] = out[place, : left[place]]
        return result


_CODED = "row long, doc_id long, n_ids long, n_bits long, marks array<long>, payload binary"


def _coded(lengths: dict[int, int], stride: int):
    tables: list[np.ndarray] = []  # made in the worker

    def offsets(ends: np.ndarray) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.int32), ends.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _CODED.split(", ")]
        if not tables:
            tables.extend(canonical(lengths))
        codes, bits = tables
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                raw = part.column(2).to_pylist()
                n = np.array([len(x) >> 1 for x in raw], np.int64)
                payload, ends, total, marks, counts = encode_many(np.frombuffer(b"".join(raw), "<u2"), n, codes, bits, stride)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(n), pa.array(total),
                        pa.ListArray.from_arrays(pa.array(offsets(np.cumsum(counts))), pa.array(marks)),
                        pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets(ends)), pa.py_buffer(payload)]),
                    ],
                    names=names,
                )

    return run


_BLOCK = "part int, seq long, rows array<long>, doc_ids array<long>, n_ids array<long>, n_bits array<long>, checkpoints array<long>, payload binary, block_ids long"


def _blocked(docs: int, size: int):
    """Blocks of rows that come sorted by part, doc_id and row; a block is of one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = None, 0
        held: list[tuple] = []
        held_bytes = 0

        def block() -> pa.RecordBatch:
            nonlocal held, held_bytes, seq
            rows, doc_ids, n_ids, n_bits, marks, payload, _ = zip(*held, strict=True)
            begins = np.concatenate(([0], np.cumsum([len(p) for p in payload])[:-1])) * 8
            points = np.concatenate([np.array(m, np.int64) + b for m, b in zip(marks, begins, strict=True)])
            longs = pa.list_(pa.int64())
            cells = [(part, pa.int32()), (seq, pa.int64()), (rows, longs), (doc_ids, longs), (n_ids, longs), (n_bits, longs), (points, longs), (b"".join(payload), pa.binary()), (sum(n_ids), pa.int64())]
            held, held_bytes, seq = [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in cells], names=[x.split()[0] for x in _BLOCK.split(", ")])

        for batch in batches:
            for item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (item[6] != part or len(held) >= docs or held_bytes >= size):
                    yield block()
                if item[6] != part:
                    part, seq = item[6], 0
                held.append(item)
                held_bytes += len(item[5])
        if held:
            yield block()

    return run


def _coded_blocks(lengths: dict[int, int], stride: int, docs: int, size: int):
    """Blocks of staged ids of one part, in one Python worker."""
    code, block = _coded(lengths, stride), _blocked(docs, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def coded() -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, 64):
                for out in code(iter([batch])):
                    yield out.append_column("part", batch.column(3))

        yield from block(coded())

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id", row: str | None = None, end: int = END, stride: int = STRIDE) -> None:
    """Tokenize docs and write header and blocks under path, in ascending order of doc_id."""
    spark = docs.sparkSession
    prepare(spark)
    if row is None:
        docs, row = with_row_id(docs), OWN + "row"
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    d = docs.select(F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    staged = f"{spark.sparkContext.getCheckpointDir()}/ids-{uuid.uuid4().hex}"
    d.mapInArrow(_tokenized(tokenizer_path, definition, end), _STAGED).write.option("compression", "zstd").parquet(staged)
    everything = spark.read.schema(_STAGED).parquet(staged)
    ids = everything.filter("ids IS NOT NULL").select("row", "doc_id", "ids")
    pairs = everything.filter("counted IS NOT NULL").select(F.explode(F.arrays_zip("counted", "n")).alias("p"))
    counted = pairs.groupBy(F.col("p.counted").alias("id")).agg(F.sum("p.n").alias("n"))
    counts = {r["id"]: r["n"] for r in counted.collect()}  # at most 65,536 rows
    counts.setdefault(end, 1)
    lengths = code_lengths(counts)
    spark.createDataFrame([(sorted(lengths), [lengths[i] for i in sorted(lengths)], stride)], "ids array<int>, bits array<int>, stride int").coalesce(1).write.parquet(f"{path}/header")
    # sorted as staged numbers: to find the ranges' bounds, ids are only read once more, not coded twice
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    ids = ids.repartitionByRange(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    ids.select("row", "doc_id", "ids", F.spark_partition_id().alias("part")).mapInArrow(_coded_blocks(lengths, stride, BLOCK_DOCS, BLOCK_BYTES), _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")
    where = spark._jvm.org.apache.hadoop.fs.Path(staged)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _decoded(lengths: dict[int, int], stride: int):
    """part, seq, doc_id, start within the block, n_tokens, ids_crc32 and ids of each document of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(*canonical(lengths))
        for batch in batches:
            for part, seq, rows, doc_ids, n_ids, points, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = np.array(n_ids, np.int64)
                pieces = -(-n // stride)
                counts = np.full(int(pieces.sum()), stride, np.int64)
                last = np.cumsum(pieces) - 1
                counts[last] = n - (pieces - 1) * stride
                parts = decoder.decode(payload, np.array(points, np.int64), counts)
                ids = np.concatenate(parts).astype("<u4")
                stops = np.cumsum(n)
                starts = stops - n
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                own = pa.array([ids[a:b].astype(np.int32) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), pa.array([seq] * len(n), pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(n), pa.array(crc, pa.int64()), own],
                    names=["part", "seq", "doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return run


def _digests(lengths: dict[int, int], stride: int):
    whole = _decoded(lengths, stride)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            yield batch.select(["part", "seq", "doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row for each document: doc_id, start (ids before it), n_tokens, ids_crc32 and, if asked for, ids."""
    head = spark.read.parquet(f"{path}/header").first()
    lengths = dict(zip(head["ids"], head["bits"], strict=True))
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    places = running_total(blocks.select("part", "seq", "block_ids"), [], "part", [F.col("seq")], F.col("block_ids"), "after")
    places = places.select(F.col("part").alias("p"), F.col("seq").alias("s"), (F.col("after") - F.col("block_ids")).alias("before"))
    own = "part int, seq long, doc_id long, start long, n_tokens long, ids_crc32 long"
    wide = blocks.select("part", "seq", "rows", "doc_ids", "n_ids", "checkpoints", "payload")
    docs = wide.mapInArrow(_decoded(lengths, head["stride"]), own + ", ids array<int>") if with_ids else wide.mapInArrow(_digests(lengths, head["stride"]), own)
    docs = docs.join(places, (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s")))
    return docs.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    prepare(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/token-files-{uuid.uuid4().hex}"
    write_token_files(read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path, with_ids=False)

"""Format-preserving pseudonyms for personal data.

Candidates are found by pattern and validated: card numbers by their check digit, IBANs by theirs,
dates by the calendar, addresses by range. What passes is replaced by a keyed permutation of its own
format: a Feistel network over the two factors of the format's number of values, walked on until the
result is a value of the format. So a card number becomes a card number with a right check digit, a
date a date in the same notation, and an address in one letter case or spacing keeps it. It is a
permutation: with one key, equal values stay equal in all documents and different ones different.

The values of a kind are permuted by content, not by notation: 4111-1111-... and 4111 1111 ... are
linked, as are 2001-02-03 and 03.02.2001, and (555) 123-4567 and +1 555 123 4567: a number without a
country code is one of the code 1, whose notations those are. Secrets after `token =`, `key:` and the
like are taken to their end, dots and padding included, and keep their alphabet; long ones are permuted
in parts. Digits are those of ASCII; other scripts' are letters like any. Numbers that fail validation
stay as they are, as do four numbers with dots that `v` or `version` calls a version.

Without the key pseudonyms can't be led back; with it `Pseudonyms(key).restored` does. The key is a
parameter, never written out. Texts are worked on where they are read: there is no shuffle.

Defined results: a null text stays null, with nothing found; overlapping candidates: the kind that
comes first in KINDS is taken; rows that repeat get equal results; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import prepare, read

#: For tests and the registered query; give your own to `pseudonymize`.
EXAMPLE_KEY = b"tidegrid example key"
ROUNDS = 10

_DAY_0, _DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def luhn_digit(digits: str) -> str:
    return next(c for c in _DIGITS if luhn(digits + c))


def _iban_rest(country: str, rest: str) -> int:
    return int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


class Pseudonyms:
    def __init__(self, key: bytes, rounds: int = ROUNDS):
        if not key:
            raise ValueError("a key is needed")
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _round(self, tweak: bytes, i: int, value: int, size: int) -> int:
        n = (size.bit_length() + 7) // 8 + 16  # 128 bits beyond the range: no bias that counts
        data = self.key + len(tweak).to_bytes(2, "big") + tweak + bytes([i]) + value.to_bytes((value.bit_length() + 7) // 8 or 1, "big")
        return int.from_bytes(hashlib.shake_256(data).digest(n), "big") % size

    def permuted(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        """A permutation of 0 .. size - 1, or its inverse."""
        if not 0 <= value < size:
            raise ValueError("not a value of the format")
        a = 1
        while a * a < size:
            a <<= 1
        b = -(-size // a)
        name = f"{tweak}/{size}".encode()
        while True:
            left, right = divmod(value, b)
            for i in reversed(range(self.rounds)) if back else range(self.rounds):
                sign = -1 if back else 1
                if i % 2 == 0:
                    left = (left + sign * self._round(name, i, right, a)) % a
                else:
                    right = (right + sign * self._round(name, i, left, b)) % b
            value = left * b + right
            if value < size:  # else walk on along the cycle
                return value

    def letters(self, text: str, tweak: str, back: bool = False) -> str:
        """Each letter and digit becomes one of its own class; all else stays in place."""
        classes = [next((k for k in (_DIGITS, _LOWER, _UPPER) if c in k), "") for c in text]
        value = 0
        size = 1
        for c, k in zip(text, classes, strict=True):
            if k:
                value, size = value * len(k) + k.index(c), size * len(k)
        shape = "".join("d" if k is _DIGITS else "a" if k else c for c, k in zip(text, classes, strict=True))
        value = self.permuted(value, size, f"{tweak}:{shape}", back) if size > 1 else value
        out = []
        for c, k in zip(reversed(text), reversed(classes), strict=True):
            if k:
                value, i = divmod(value, len(k))
                c = k[i]
            out.append(c)
        return "".join(reversed(out))

    def digits(self, digits: str, tweak: str, back: bool = False) -> str:
        return str(self.permuted(int(digits), 10 ** len(digits), tweak, back)).zfill(len(digits)) if digits else ""


def _refill(notation: str, digits: str) -> str:
    left = iter(digits)
    return "".join(next(left) if c in _DIGITS else c for c in notation)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


_TO_LOWER = str.maketrans(_UPPER, _LOWER)


def _email(p: Pseudonyms, text: str, back: bool) -> str | None:
    local, _, domain = text.rpartition("@")
    host, _, top = domain.rpartition(".")
    if len(local) > 64 or len(domain) > 253 or not top.isalpha():
        return None
    # addresses are equal whatever their case: what is permuted is in lower case, the case is put back
    new = p.letters(local.translate(_TO_LOWER), "email", back) + "@" + p.letters(host.translate(_TO_LOWER), "host", back)
    return "".join(n.upper() if o in _UPPER else n for o, n in zip(text, new, strict=False)) + "." + top


def _iban(p: Pseudonyms, text: str, back: bool) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or (_iban_rest(plain[:2], plain[4:]) + int(plain[2:4])) % 97 != 1:
        return None
    rest = p.letters(plain[4:], "iban" + plain[:2], back)
    new = iter(plain[:2] + str(98 - _iban_rest(plain[:2], rest)).zfill(2) + rest)
    return "".join(c if c == " " else next(new) for c in text)


#: Leading digits of card numbers and the lengths that go with them.
_ISSUERS = (
    ("4", "4", (13, 16, 19)),
    ("51", "55", (16,)),
    ("2221", "2720", (16,)),
    ("34", "34", (15,)),
    ("37", "37", (15,)),
    ("300", "305", (14,)),
    ("36", "36", (14,)),
    ("38", "39", (14,)),
    ("3528", "3589", (16,)),
    ("6011", "6011", (16, 19)),
    ("62", "62", (16, 17, 18, 19)),
    ("644", "649", (16, 19)),
    ("65", "65", (16, 19)),
)


def _card_valid(d: str) -> bool:
    return luhn(d) and any(len(d) in lengths and low <= d[: len(low)] <= high for low, high, lengths in _ISSUERS)


def _card(p: Pseudonyms, text: str, back: bool) -> str | None:
    d = _only_digits(text)
    if not _card_valid(d):
        return None
    while True:  # what no issuer has is walked past
        d = p.digits(d[:-1], "card", back)
        d += luhn_digit(d)
        if _card_valid(d):
            return _refill(text, d)


#: Leading digits of country codes that have one and two digits; all others have three.
_ONE_DIGIT_CODES = ("1", "7")
_TWO_DIGIT_CODES = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
    "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)


def _phone(p: Pseudonyms, text: str, back: bool) -> str | None:
    d = _only_digits(text)
    if not 8 <= len(d) <= 15:
        return None
    if text[0] == "+":
        code = 1 if d.startswith(_ONE_DIGIT_CODES) else 2 if d.startswith(_TWO_DIGIT_CODES) else 3
        return _refill(text, d[:code] + p.digits(d[code:], "phone+" + d[:code], back))
    return _refill(text, p.digits(d, "phone+1", back))


def _ip(p: Pseudonyms, text: str, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts):
        return None
    n = p.permuted(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip", back)
    return ".".join(map(str, n.to_bytes(4, "big")))


def _ssn_valid(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _ssn(p: Pseudonyms, text: str, back: bool) -> str | None:
    d = _only_digits(text)
    if not _ssn_valid(d):
        return None
    while True:
        d = p.digits(d, "ssn", back)
        if _ssn_valid(d):
            return _refill(text, d)


def _date(p: Pseudonyms, text: str, back: bool) -> str | None:
    a, mark, b, c = re.fullmatch(r"([0-9]+)([-/.])([0-9]+)[-/.]([0-9]+)", text).groups()
    for order in ((0, 1, 2),) if len(a) == 4 else ((2, 1, 0), (2, 0, 1)):  # y-m-d; d/m/y, else m/d/y
        y, m, d = (int((a, b, c)[i]) for i in order)
        try:
            day = dt.date(y, m, d).toordinal() - _DAY_0
        except ValueError:
            continue
        if 0 <= day < _DAYS:
            break
    else:
        return None
    unpadded = len(a) == 1 or len(b) == 1
    while True:
        day = p.permuted(day, _DAYS, "date", back)
        x = dt.date.fromordinal(day + _DAY_0)
        # a m/d/y date must not read as d/m/y afterwards, nor an unpadded one lose its sign
        if order == (2, 0, 1) and x.day <= 12 or unpadded and x.day > 9 and x.month > 9:
            continue
        parts = [0, 0, 0]
        for i, v in zip(order, (x.year, x.month, x.day), strict=True):
            parts[i] = v
        width = [4 if i == order[0] else 1 if unpadded else 2 for i in range(3)]
        return mark.join(str(v).zfill(w) for v, w in zip(parts, width, strict=True))


#: Characters of a secret that are permuted together.
_SECRET_PART = 256


def _secret(p: Pseudonyms, text: str, back: bool) -> str | None:
    if not any(c in _DIGITS for c in text):
        return None
    parts = [text[i : i + _SECRET_PART] for i in range(0, len(text), _SECRET_PART)]
    if text.isdigit() or not re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        return "".join(p.letters(x, f"secret{i}", back) for i, x in enumerate(parts))
    upper = text.upper() == text
    while True:  # what would not be found again is walked past
        parts = [f"{p.permuted(int(x, 16), 16 ** len(x), f'hex{i}', back):0{len(x)}x}" for i, x in enumerate(parts)]
        new = "".join(parts)
        if any(c in _DIGITS for c in new) and not new.isdigit():
            return new.upper() if upper else new


#: kind: (pattern whose group 1 is the value, what must be in a text that has one, replacement).
KINDS: dict[str, tuple[re.Pattern[str], str, Callable[[Pseudonyms, str, bool], str | None]]] = {
    "email": (re.compile(r"(?<![\w.%+-])([\w.%+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24})(?![A-Za-z0-9-])"), "@", _email),
    "secret": (re.compile(r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)[ \t]*[=:][ \t]*[\"']?([A-Za-z0-9_+/-]{16,}(?:\.[A-Za-z0-9_+/-]{4,})*={0,2})"), "", _secret),
    "iban": (re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?))(?![A-Za-z0-9])"), "", _iban),
    "ip": (re.compile(r"(?<![0-9.])(?<![Vv])(?<![Vv]ersion )([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\.?[0-9])"), ".", _ip),
    "card": (re.compile(r"(?<![0-9])([0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\3[0-9]{4,5})(?![0-9])"), "", _card),
    "phone": (
        re.compile(
            r"(?<![0-9+])(\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}"
            r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"
        ),
        "",
        _phone,
    ),
    "ssn": (re.compile(r"(?<![0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"), "-", _ssn),
    "date": (re.compile(r"(?<![0-9./-])([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}([/.])[0-9]{1,2}\2[0-9]{4}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2})(?![0-9/-])(?!\.[0-9])"), "", _date),
}
_ANY = re.compile(r"[0-9@]")


def find(text: str, p: Pseudonyms, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, stop, kind, replacement) of what is found, in order, without overlap."""
    if not _ANY.search(text):
        return []
    out: list[tuple[int, int, str, str]] = []
    for kind, (pattern, needs, new) in KINDS.items():
        if needs and needs not in text:
            continue
        taken = len(out)
        for m in pattern.finditer(text):
            if (value := new(p, m[1], back)) is not None:
                out.append((*m.span(1), kind, value))
        for a, b, _, _ in out[taken:]:  # later kinds don't see it
            text = text[:a] + "\0" * (b - a) + text[b:]
    return sorted(out)


def replaced(text: str, found: list[tuple[int, int, str, str]]) -> str:
    parts, last = [], 0
    for a, b, _, value in found:
        parts += [text[last:a], value]
        last = b
    return "".join([*parts, text[last:]])


_OUT = "doc_id long, text string, n_found long, found array<struct<kind: string, start: long, stop: long>>"


def _run(key: bytes, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pseudonyms(key)
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                texts, found = part.column(1).to_pylist(), []
                for j, text in enumerate(texts):
                    found.append(find(text, p, back) if text else [])
                    if found[-1]:
                        texts[j] = replaced(text, found[-1])
                marks = [[{"kind": k, "start": a, "stop": b} for a, b, k, _ in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array([len(f) for f in found], pa.int64()), pa.array(marks, spans)], names=["doc_id", "text", "n_found", "found"]
                )

    return run


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", doc_id: str = "doc_id", back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, n_found, and the kind and place (in the text as it came) of each; back: undo it."""
    prepare(docs.sparkSession)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInArrow(_run(key, back), _OUT)


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(read(spark, sf_dir, "documents"), EXAMPLE_KEY)

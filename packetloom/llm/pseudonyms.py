"""Format-preserving pseudonyms for personal data.

Card and account numbers, phone numbers, IP addresses, e-mail addresses, bank accounts, dates and secrets are found by
pattern, validated (Luhn sum, address ranges, calendar, check digits), and permuted by a keyed Feistel network inside the
set of values of their own format. A value gets the same pseudonym in every document, so records stay linked; different
values get different ones; without the key nothing leads back. Nothing is shuffled.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from packetloom.llm.memory import tidy

ROUNDS, LONGEST = 8, 512
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâäãåçèéêëìíîïñòóôöõùúûüýÿß",
             "ÀÁÂÄÃÅÇÈÉÊËÌÍÎÏÑÒÓÔÖÕÙÚÛÜÝ"]
_CLASS = {c: (alphabet, i) for alphabet in ALPHABETS for i, c in enumerate(alphabet)}
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
PATTERN = re.compile(r"""
    (?P<email>[^\W_](?:[\w.+-]*\w)?@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,})
  | (?P<secret>(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)\W{0,3}\s*[=:]\s*["']?(?P<key>[A-Za-z0-9+/_.-]{8,}))
  | (?P<hex>\b(?:[0-9a-f]{32,}|[0-9A-F]{32,})\b)
  | (?P<iban>\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b)
  | (?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d))
  | (?P<date>(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?!\d))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<phone>\+\d{1,3}[ .-]?\d(?:[ .-]?\d{2}){4}(?!\d)|\+\d{1,3}[^\w\n]{0,6}\d{2,4}(?:[^\w\n]{1,6}\d{2,4}){1,2}(?!\d)|\+\d{8,15}(?!\d)
            |(?<!\d)\(\d{3}\)[ ]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]))
  | (?P<number>(?<![\d.])(?:\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d))
""", re.VERBOSE | re.IGNORECASE)
#: What every alternative above needs: a digit of any script, @, = or :, or a hexadecimal run of letters only.
HINTS = re.compile(r"[\d@=:]"), re.compile(r"[a-fA-F]{32}")


class Feistel:
    """Keyed permutations of the numbers below any product a * b."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, a: int, b: int, i: int, half: int, modulus: int) -> int:
        told = f"{kind}|{a}|{b}|{i}|{half}".encode()
        size = (modulus.bit_length() + 7) // 8 + 8
        out = b""
        while len(out) < size:
            out += hashlib.blake2b(told + bytes([len(out) % 251]), key=self.key, digest_size=64).digest()
        return int.from_bytes(out[:size], "big") % modulus

    def permute(self, kind: str, value: int, a: int, b: int, back: bool = False) -> int:
        """The image of ``value`` (below a * b); ``back`` inverts it."""
        left, right = divmod(value, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                left = (left + sign * self._round(kind, a, b, i, right, a)) % a
            else:
                right = (right + sign * self._round(kind, a, b, i, left, b)) % b
        return left * b + right

    def digits(self, kind: str, values: list[int], radix: list[int], back: bool = False) -> list[int]:
        """A mixed-radix number, digit by digit, permuted among all of its radices, ``LONGEST`` of them at a time, so that a
        value of any length takes time in proportion."""
        out = []
        for n, at in enumerate(range(0, len(values), LONGEST)):
            out += self._block(f"{kind}#{n}" if n else kind, values[at:at + LONGEST], radix[at:at + LONGEST], back)
        return out

    def _block(self, kind: str, values: list[int], radix: list[int], back: bool) -> list[int]:
        half = len(radix) // 2
        a, b = 1, 1
        for r in radix[:half]:
            a *= r
        for r in radix[half:]:
            b *= r
        number = 0
        for v, r in zip(values, radix, strict=True):
            number = number * r + v
        number = self.permute(kind + ":" + ",".join(map(str, radix)), number, a, b, back)
        out = []
        for r in reversed(radix):
            number, v = divmod(number, r)
            out.append(v)
        return out[::-1]

    def text(self, kind: str, value: str, back: bool = False) -> str:
        """Letters and digits permuted, each within its own alphabet; all else stays in its place."""
        known = [(i, *_CLASS[c]) for i, c in enumerate(value) if c in _CLASS]
        if not known:
            return value
        new = self.digits(kind, [v for _, _, v in known], [len(a) for _, a, _ in known], back)
        out = list(value)
        for (i, alphabet, _), v in zip(known, new, strict=True):
            out[i] = alphabet[v]
        return "".join(out)


def luhn_digit(body: str) -> int:
    """The check digit that makes ``body`` plus it pass the Luhn sum."""
    total = sum(int(c) if i % 2 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(body)))
    return -total % 10


def _number(f: Feistel, value: str, back: bool) -> str | None:
    """All digits but the last are permuted; the last is the Luhn digit again, so a valid number stays valid."""
    digits = re.sub(r"\D", "", value)
    if int(digits[-1]) != luhn_digit(digits[:-1]):
        return None
    body = f.text("number", digits[:-1], back)
    new = iter(body + str(luhn_digit(body)))
    return re.sub(r"\d", lambda _: next(new), value)


def _ip(f: Feistel, value: str, back: bool) -> str | None:
    parts = [int(p) for p in value.split(".")]
    return ".".join(map(str, f.digits("ip", parts, [256] * 4, back))) if max(parts) < 256 else None


def _date(f: Feistel, value: str, back: bool) -> str | None:
    layout = "%Y-%m-%d" if "-" in value else "%d.%m.%Y" if "." in value else "%m/%d/%Y"
    try:
        day = datetime.datetime.strptime(value, layout).date()
    except ValueError:
        return None
    number, days = day.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1
    if not 0 <= number < days:
        return None
    while True:  # a permutation of a slightly larger square, walked until it is back among the days
        number = f.permute("date", number, 271, 271, back)
        if number < days:
            return datetime.date.fromordinal(FIRST_DAY + number).strftime(layout)


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(f: Feistel, value: str, back: bool) -> str | None:
    country, body = value[:2].upper(), value[4:].upper()
    if not country.isascii() or f"{_iban_check(country, body):02d}" != value[2:4]:
        return None
    body = f.text("iban", body, back)
    return f"{country}{_iban_check(country, body):02d}{body}"


def _email(f: Feistel, value: str, back: bool) -> str:
    name, _, end = value.rpartition(".")
    return f"{f.text('email', name, back)}.{end}"


def _phone(f: Feistel, value: str, back: bool) -> str:
    code = re.match(r"\+\d{1,3}(?=\D)", value)  # the country code stays
    at = code.end() if code else 0
    return value[:at] + f.text("phone", value[at:], back)


def _hex(f: Feistel, value: str, back: bool) -> str:
    alphabet = "0123456789ABCDEF" if value.upper() == value else "0123456789abcdef"
    at = [alphabet.find(c) for c in value]
    if min(at) < 0:
        return f.text("secret", value, back)
    return "".join(alphabet[v] for v in f.digits("hex", at, [16] * len(at), back))


def replace(f: Feistel, text: str, back: bool = False) -> tuple[str, int]:
    """The text with every validated value replaced, and how many there were.

    A number that fails the Luhn sum stays, and the search goes on behind its first group: a valid one may begin there.
    """
    parts, count, done, at = [], 0, 0, 0
    while m := PATTERN.search(text, at):
        kind, value = m.lastgroup, m[0]
        if m["secret"] is not None:
            out = value[:m.start("key") - m.start()] + _hex(f, m["key"], back)
        else:
            out = {"email": _email, "hex": _hex, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone,
                   "number": _number, "ssn": lambda f, v, b: f.text("ssn", v, b)}[kind](f, value, back)
        at = m.end()
        if out is not None:
            parts += [text[done:m.start()], out]
            count, done = count + 1, at
        elif kind == "number":
            at = m.start() + len(re.match(r"\d+", value)[0])
    return "".join([*parts, text[done:]]), count


@lru_cache(maxsize=4)
def _network(key: bytes) -> Feistel:
    return Feistel(key)


def pseudonymised(docs: DataFrame, key: bytes, column: str = "text", counted: str | None = None) -> DataFrame:
    """``docs`` with the values in ``column`` replaced; ``counted`` names a column to add with their number.

    All other columns stay, whatever their names; a column called ``counted`` is replaced. Null texts stay null and count 0, empty ones
    stay empty, repeated rows come out equal, an empty table stays empty. The same key undoes it (``replace(.., back=True)``).
    """
    columns = [c for c in docs.columns if c != counted]
    kept = docs.select(*[docs[c] for c in columns]) if counted in docs.columns else docs
    at = columns.index(column)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = _network(key)
        for frame in frames:
            texts, counts = frame.column(at).to_pylist(), np.zeros(frame.num_rows, np.int64)
            for i, text in enumerate(texts):
                if text and any(h.search(text) for h in HINTS):
                    texts[i], counts[i] = replace(f, text)
            out = list(frame.columns)
            out[at] = pa.array(texts, frame.schema.field(at).type)
            names = list(columns)
            if counted:
                out, names = [*out, pa.array(counts)], [*names, counted]
            yield pa.RecordBatch.from_arrays(out, names)

    extra = [T.StructField(counted, T.LongType())] if counted else []
    return kept.mapInArrow(tidy(run), T.StructType([*kept.schema.fields, *extra]))

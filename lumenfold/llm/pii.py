"""Format-preserving pseudonyms for personal data: a keyed Feistel permutation inside each format.

Numbers and dates count only when they validate: cards by their check digit, account numbers by theirs, addresses of
machines by their ranges, telephone and social security numbers by theirs, dates by the calendar. A value becomes
another valid one of its format with the same separators, and the permutation depends on the digits alone, so equal
values stay linked across documents and two values never meet. Telephone numbers are 3-3-4 digits, ten digits in a row
that are valid so, or 8 to 15 digits after a plus sign in any groups; digits that follow such groups behind one
separator count as theirs while 15 are not passed, so a number may then lose its link, but not its inversion. Mail addresses keep their domain, and letters and
digits of the name are permuted within their kinds. The key holder can invert every pseudonym.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame

from lumenfold.llm.batches import small_batches

KINDS = ("email", "account", "date", "address", "social", "phone", "card")
PATTERN = re.compile(
    r"""
    (?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)
  | (?P<account>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9]))
  | (?P<date>(?<![0-9.])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4})(?![0-9]|[.][0-9]))
  | (?P<address>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))
  | (?P<social>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))
  | (?P<phone>(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])
      | (?<![0-9A-Za-z+])\+[1-9][0-9]{7,14}(?![0-9])
      | (?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}[\x20.-](?:\([0-9]{1,5}\)[\x20.-]?)?[0-9]{1,8}(?:[\x20.-][0-9]{2,8}){0,5}(?![0-9])
      | (?<![0-9A-Za-z+.,_/=-])[2-9][0-9]{2}[2-9][0-9]{6}(?![0-9A-Za-z_/=]|[.,-][0-9]))
  | (?P<card>(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[\x20-])(?:[0-9]{4}(?P=gap)){2}[0-9]{4}(?:(?P=gap)[0-9]{1,3})?|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9A-Za-z]))
    """,
    re.VERBOSE,
)
_MAY_HOLD = re.compile(r"[0-9@]")
_LAST_GROUP = {"account": re.compile(r" [^ ]*$"), "phone": re.compile(r"(?<=[0-9)])[\x20.-][0-9]+$")}
# Country codes of two digits; those that start with 1 or 7 have one digit, all others three.
TWO_DIGIT_COUNTRIES = frozenset(
    [20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, 43, 44, 45, 46, 47, 48, 49, 51, 52, 53, 54, 55, 56, 57, 58]
    + [60, 61, 62, 63, 64, 65, 66, 81, 82, 84, 86, 90, 91, 92, 93, 94, 95, 98]
)
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73049  # 1900 to 2099


class Feistel:
    """A keyed permutation of 0 to size - 1 for every size and use."""

    rounds = 10

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _function(self, use: str, size: int, turn: int, value: int) -> int:
        message = f"{use}:{size}:{turn}:{value}".encode()
        return int.from_bytes(blake2b(message, digest_size=32, key=self.key).digest(), "big")

    def _step(self, value: int, size: int, use: str, turns) -> int:
        left = 1
        while left * left < size:
            left <<= 1
        sides = (left, left)  # a domain of at most four times the size; values outside it are walked over
        high, low = divmod(value, left)
        for turn in turns:
            if turn % 2:
                low = (low + self._function(use, size, turn, high) * self._sign) % sides[1]
            else:
                high = (high + self._function(use, size, turn, low) * self._sign) % sides[0]
        return high * left + low

    def permute(self, value: int, size: int, use: str, back: bool = False) -> int:
        """Another number of the domain (itself only if the domain is that small); ``back`` inverts it."""
        if not 0 <= value < size:
            raise ValueError("the value is not in the domain")
        self._sign = -1 if back else 1
        turns = range(self.rounds - 1, -1, -1) if back else range(self.rounds)
        value = self._step(value, size, use, turns)
        while value >= size:
            value = self._step(value, size, use, turns)
        return value


def luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        doubled = int(digit) * (2 - place % 2)
        total += doubled - 9 * (doubled > 9)
    return -total % 10


def _fill(shape: str, digits: str) -> str:
    """The shape with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in shape)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def _card(value: str, cipher: Feistel, back: bool) -> str | None:
    digits = _digits(value)
    if luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    width = len(digits) - 2  # the first digit, which names the kind of issuer, stays
    body = digits[0] + str(cipher.permute(int(digits[1:-1]), 10**width, f"card:{digits[0]}", back)).zfill(width)
    return _fill(value, body + str(luhn(body)))


def _account(value: str, cipher: Feistel, back: bool) -> str | None:
    plain = value.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if len(plain) < 15 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _by_kind(plain[4:], cipher, "account:" + plain[:2], back)
    check = str(98 - number(body + plain[:2] + "00") % 97).zfill(2)
    left = iter(plain[:2] + check + body)
    return "".join(" " if c == " " else next(left) for c in value)


def _by_kind(text: str, cipher: Feistel, use: str, back: bool) -> str:
    """Digits, capitals and small letters each permuted together with all others, within their kind."""
    kinds = [(10, "0") if c.isdigit() else (26, "A") if c.isupper() else (26, "a") if c.islower() else (1, c) for c in text]
    size, value = 1, 0
    for c, (many, zero) in zip(text, kinds, strict=True):
        size, value = size * many, value * many + (ord(c) - ord(zero))
    shape = "".join(zero for _, zero in kinds)
    value = cipher.permute(value, size, f"{use}:{shape}", back)
    out = []
    for many, zero in reversed(kinds):
        value, digit = divmod(value, many)
        out.append(chr(ord(zero) + digit))
    return "".join(reversed(out))


def _email(value: str, cipher: Feistel, back: bool) -> str | None:
    name, domain = value.rsplit("@", 1)
    return f"{_by_kind(name, cipher, 'email:' + domain.lower(), back)}@{domain}"


def _address(value: str, cipher: Feistel, back: bool) -> str | None:
    """Dotted numbers; the lengths of the four parts are the format and stay."""
    parts = value.split(".")
    if any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
        return None
    bounds = [(0, 10) if len(p) == 1 else (10, 100) if len(p) == 2 else (100, 256) for p in parts]
    size, number = 1, 0
    for part, (low, high) in zip(parts, bounds, strict=True):
        size, number = size * (high - low), number * (high - low) + int(part) - low
    number = cipher.permute(number, size, "address:" + ".".join(str(len(p)) for p in parts), back)
    out = []
    for low, high in reversed(bounds):
        number, part = divmod(number, high - low)
        out.append(str(part + low))
    return ".".join(reversed(out))


def _social(value: str, cipher: Feistel, back: bool) -> str | None:
    area, group, serial = (int(p) for p in value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    number = cipher.permute((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "social", back)
    number, serial = divmod(number, 9999)
    place, group = divmod(number, 99)
    return f"{place + 1 + (place >= 665):03}-{group + 1:02}-{serial + 1:04}"


def country_of(digits: str) -> str:
    """The country code that the digits after a plus sign start with."""
    return digits[: 1 if digits[0] in "17" else 2 if int(digits[:2]) in TWO_DIGIT_COUNTRIES else 3]


def _phone(value: str, cipher: Feistel, back: bool) -> str | None:
    """Area and exchange start with 2 to 9, and the country stays; other numbers count only with a country."""
    digits = _digits(value)
    country = country_of(digits) if value[0] == "+" else ""
    number = digits[len(country) :]
    if len(number) != 10:
        if country in ("", "1") or not 8 <= len(digits) <= 15 or len(number) < 4:
            return None
        low = 0 if number[0] == "0" else 10 ** (len(number) - 1)  # a leading zero stays, and so does its absence
        size = 10 ** (len(number) - 1) if low == 0 else 9 * low
        made = low + cipher.permute(int(number) - low, size, f"phone:{country}:{len(number)}:{low > 0}", back)
        return _fill(value, country + str(made).zfill(len(number)))
    if number[0] < "2" or number[3] < "2":
        if not country:
            return None
        while True:  # numbers of the other sort are walked over
            number = str(cipher.permute(int(number), 10**10, "phone abroad", back)).zfill(10)
            if number[0] < "2" or number[3] < "2":
                break
        return _fill(value, country + number)
    place = ((int(number[0]) - 2) * 100 + int(number[1:3])) * 800 + (int(number[3]) - 2) * 100 + int(number[4:6])
    place = cipher.permute(place * 10000 + int(number[6:]), 800 * 800 * 10000, "phone", back)
    place, line = divmod(place, 10000)
    area, exchange = divmod(place, 800)
    return _fill(value, f"{country}{area + 200}{exchange + 200}{line:04}")


def _date(value: str, cipher: Feistel, back: bool) -> str | None:
    """A day of 1900 to 2099; of two readings of day and month the first valid one counts."""
    separator = next(c for c in value if not c.isdigit())
    parts = value.split(separator)
    if len(parts) != 3:
        return None
    orders = ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy") if separator == "." else ("mdy", "dmy")
    for order in orders:
        named = dict(zip(order, map(int, parts), strict=True))
        try:
            day = datetime.date(named["y"], named["m"], named["d"]).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            continue
        # A pseudonym must read in the same order and keep its width; days that do not are walked over.
        while True:
            day = cipher.permute(day, _DAYS, "date", back)
            found = datetime.date.fromordinal(day + _FIRST_DAY)
            made = {"y": f"{found.year:04}", "m": str(found.month), "d": str(found.day)}
            out = [made[c].zfill(len(p)) for c, p in zip(order, parts, strict=True)]
            if all(len(a) == len(b) for a, b in zip(out, parts, strict=True)) and _first_order(out, orders) == order:
                return separator.join(out)
    return None


def _first_order(parts: list[str], orders: tuple[str, ...]) -> str | None:
    for order in orders:
        named = dict(zip(order, map(int, parts), strict=True))
        try:
            if 0 <= datetime.date(named["y"], named["m"], named["d"]).toordinal() - _FIRST_DAY < _DAYS:
                return order
        except ValueError:
            continue
    return None


_MAKERS = {"email": _email, "account": _account, "date": _date, "address": _address, "social": _social, "phone": _phone, "card": _card}


def replaced(text: str, cipher: Feistel, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, start and end of each in the new text."""
    if not _MAY_HOLD.search(text):
        return text, []
    out, spans, done, at, length = [], [], 0, 0, 0
    while match := PATTERN.search(text, at):
        kind, value = match.lastgroup, match.group()
        made = _MAKERS[kind](value, cipher, back)
        cut = _LAST_GROUP.get(kind)
        while made is None and cut and (shorter := cut.sub("", value)) != value:  # groups after a number may not belong to it
            value = shorter
            made = _MAKERS[kind](value, cipher, back)
        if made is None:  # not valid as this kind; another kind may start inside
            at = match.start() + 1
            continue
        out += [text[done : match.start()], made]
        length += match.start() - done
        spans.append((kind, length, length + len(made)))
        length += len(made)
        done = at = match.start() + len(value)
    return "".join([*out, text[done:]]), spans


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in the text and the column ``pii_spans`` (kind, start, end in code points).

    With ``back`` and the same key the original texts come back. Null stays null, with no spans; other columns stay,
    but one named like the new one is replaced.
    """
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text, "pii_spans")]
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = Feistel(key)
        for batch in batches:
            texts, found = [], []
            for value in batch.column(text).to_pylist():
                made, spans = (None, []) if value is None else replaced(value, cipher, back)
                texts.append(made)
                found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            made = [pa.array(texts, pa.string()), pa.array(found, pa.list_(span))]
            yield pa.record_batch([*(batch.column(c) for c in others), *made], [*others, text, "pii_spans"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in others)
    return docs.select(*others, text).mapInArrow(rows, kept + f"`{text}` string, pii_spans array<struct<kind:string,start:int,end:int>>")

"""Format-preserving pseudonyms: a keyed Feistel permutation of personal data.

Numbers and dates that are valid in their format are replaced by others that
are valid in the same format: payment cards keep their length, separators and
Luhn digit, IBANs their country and check digits, IPv4 addresses four octets, IPv6
addresses the full or the short form, social security numbers their valid ranges,
phone numbers their country code and punctuation, dates a real day in the same
notation, in figures or with the month's name in four languages. E-mail addresses keep their
shape and last label. Each kind of value is a number below the size of its format;
a Feistel network whose rounds are keyed hashes permutes these numbers, walking
on until it lands inside. The key alone decides the pseudonym, so equal values
get equal pseudonyms in any document and any task, and the key takes
them back: ``restore`` finds the pseudonyms as it would the values.
"""
from __future__ import annotations

import datetime
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from rankwise.llm.text import fresh, named

ROUNDS = 10
ROWS_AT_ONCE = 256
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1


@lru_cache(maxsize=65536)
def permute(key: bytes, tweak: str, size: int, value: int, back: bool = False) -> int:
    """A permutation of range(size), chosen by key and tweak."""
    low = isqrt(size - 1) + 1 if size > 1 else 1
    high = -(-size // low)

    def f(i: int, half: int) -> int:
        text = f"{tweak}|{size}|{i}|{half}".encode()
        return int.from_bytes(blake2b(text, key=key, digest_size=24).digest(), "big")
    while True:
        left, right = divmod(value, low)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                right = (right + sign * f(i, left)) % low
            else:
                left = (left + sign * f(i, right)) % high
        value = left * low + right
        if value < size:
            return value


def _radix(text: str, alphabets: list[str]) -> tuple[int, int]:
    value = size = 0
    for c, a in zip(text, alphabets, strict=True):
        value, size = value * len(a) + a.index(c), (size or 1) * len(a)
    return value, size


def _spell(value: int, alphabets: list[str]) -> str:
    out = []
    for a in reversed(alphabets):
        value, i = divmod(value, len(a))
        out.append(a[i])
    return "".join(reversed(out))


DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()


def _alphabets(text: str) -> list[str]:
    return [DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER for c in text]


def _refill(shape: str, chars: str, into: Callable[[str], bool]) -> str:
    """``shape`` with its characters that satisfy ``into`` replaced in order."""
    it = iter(chars)
    return "".join(next(it) if into(c) else c for c in shape)


def luhn_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return str(-total % 10)


def _card(text, move):
    digits = re.sub("[^0-9]", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] \
            or not digits.strip("0"):
        return None
    # A first digit that is not zero stays so: the number keeps its length.
    body, alphabets = digits[:-1], [DIGITS] * (len(digits) - 1)
    if body[0] != "0":
        alphabets[0] = DIGITS[1:]
    value, size = _radix(body, alphabets)
    new = _spell(move("card" + alphabets[0][0], size, value), alphabets)
    return _refill(text, new + luhn_digit(new), str.isdigit)


# Lengths of IBANs by country.
IBAN_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22,
    "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18,
    "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
}


def iban_check(country: str, body: str) -> str:
    number = int("".join(str(int(c, 36)) for c in f"{body}{country}00"))
    return f"{98 - number % 97:02d}"


def _iban(text, move):
    # What follows after a space may be another word: the country has the length.
    long = IBAN_LENGTHS.get(text[:2], 0)
    cut = re.match(r"(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % max(long, 1), text)
    if not long or not cut:
        return None
    text = cut[0]
    plain = text.replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if iban_check(country, body) != check:
        return None
    alphabets = _alphabets(body)
    value, size = _radix(body, alphabets)
    new = _spell(move("iban" + country, size, value), alphabets)
    return _refill(text, country + iban_check(country, new) + new, lambda c: c != " ")


def _ip(text, move):
    parts = [int(x) for x in text.split(".")]
    if any(p > 255 for p in parts) or any(str(p) != x for p, x in
                                          zip(parts, text.split("."), strict=True)):
        return None
    return ".".join(map(str, move("ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
                        .to_bytes(4, "big")))


def _ssn(text, move):
    area, group, serial = map(int, re.split("[- ]", text))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(move("ssn", 898 * 99 * 9999, value), 9999)
    area, group = divmod(value, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


def _phone(text, move):
    # The country code stays, or the zero that stands for it.
    country = re.match(r"\+[0-9]{1,3}(?=[^0-9])|0(?=[0-9]([ .-])[0-9]{2}(?:\1[0-9]{2}){3}$)|", text)[0]
    digits = re.sub("[^0-9]", "", text[len(country):])
    if not 7 <= len(digits) <= 14 or len(set(digits)) == 1:
        return None
    new = move("phone", 10 ** len(digits), int(digits))
    return country + _refill(text[len(country):], f"{new:0{len(digits)}d}", str.isdigit)


def _date(text, move):
    a, mark, b, _, c = re.match(r"(\d+)([-/.])(\d+)([-/.])(\d+)$", text).groups()
    if len(a) == 4:
        order = "ymd"
    else:
        # With slashes the month leads where it can; with points the day does.
        order = "mdy" if mark == "/" and int(a) <= 12 else "dmy"
    part = dict(zip(order, (int(a), int(b), int(c)), strict=True))
    try:
        day = datetime.date(part["y"], part["m"], part["d"]).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= day < DAYS:
        return None

    # Without a leading zero in either number, a date stays written so.
    short = order != "ymd" and (len(a) == 1 or len(b) == 1)

    def spell(x: datetime.date, order: str) -> str:
        return mark.join(f"{x.year:04d}" if k == "y" else
                         f"{x.month if k == 'm' else x.day:0{1 if short else 2}d}" for k in order)
    # The notation of a slashed date tells month and day apart only when a number
    # is over 12, so the walk goes on to a day that reads back in this order.
    while True:
        day = move("date", DAYS, day)
        new = datetime.date.fromordinal(day + FIRST_DAY)
        told = mark != "/" or order != "dmy" or new.day > 12
        # Unpadded, a day and a month of two digits would read back as padded.
        if told and (not short or new.day < 10 or new.month < 10):
            return spell(new, order)


# Names of the months in English, German, French and Spanish.
MONTHS = {
    "en": "January February March April May June July August September October November December",
    "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}
MONTH_LISTS = {k: v.lower().split() for k, v in MONTHS.items()}
MONTH_LISTS["short"] = [m[:3] for m in MONTH_LISTS["en"]]


def _month_list(name: str) -> list[str] | None:
    """The months that a name is told to be of: languages share some, and French and
    Spanish write them small."""
    order = ("fr", "es", "en", "de", "short") if name.islower() else ("en", "de", "short", "fr", "es")
    return next((MONTH_LISTS[k] for k in order if name.lower() in MONTH_LISTS[k]), None)


def _worded_date(text, move):
    """A day, the name of a month and a year: what stands between them stays."""
    name = re.search(r"[^\W\d_]{3,}", text)
    months = _month_list(name[0])
    if months is None:
        return None
    day, year = sorted(re.finditer("[0-9]+", text), key=lambda m: len(m[0]))
    try:
        at = datetime.date(int(year[0]), months.index(name[0].lower()) + 1,
                           int(day[0])).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= at < DAYS:
        return None
    spell = str.lower if name[0].islower() else str.upper if name[0].isupper() else str.title
    # On to a day of as many digits, in a month whose name reads back as one of these.
    while True:
        at = move("date", DAYS, at)
        new = datetime.date.fromordinal(at + FIRST_DAY)
        word = spell(months[new.month - 1])
        if (new.day < 10) == (int(day[0]) < 10) and _month_list(word) is months:
            break
    out, end = "", 0
    for span, value in sorted([(day.span(), f"{new.day:0{len(day[0])}d}"),
                               (year.span(), f"{new.year:04d}"), (name.span(), word)]):
        out, end = out + text[end:span[0]] + value, span[1]
    return out + text[end:]


def _ip6(text, move):
    """Written in full or short; a mixed form comes back short. ``::`` and ``::1`` stay."""
    try:
        number = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    if number < 2 or not re.search("[0-9]", text):
        return None
    full = len(text) == 39
    while True:
        number = move("ip6", 1 << 128, number)
        new = ipaddress.IPv6Address(number)
        out = new.exploded if full else str(new)
        if number > 1 and (len(out) == 39) == full and new.ipv4_mapped is None:
            return out.upper() if text.isupper() else out


def _email(text, move):
    local, _, host = text.rpartition("@")
    labels, _, last = host.rpartition(".")
    known = [c for c in local + labels if c in DIGITS + LOWER + UPPER]
    alphabets = _alphabets("".join(known))
    value, size = _radix("".join(known), alphabets)
    shape = re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", f"{local}@{labels}")))
    new = _spell(move("email" + shape, size, value), alphabets)
    return _refill(f"{local}@{labels}", new, lambda c: c in DIGITS + LOWER + UPPER) + "." + last


# Formats, the more particular first. Each begins where no word or number runs on.
FORMATS = [
    ("email", _email, re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@"
        r"(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9-])")),
    ("iban", _iban, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")),
    ("ip", _ip, re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])")),
    ("ip6", _ip6, re.compile(
        r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}:(?:[0-9A-Fa-f]{0,4}:){1,6}[0-9A-Fa-f]{0,4}"
        r"(?![0-9A-Za-z:]|\.[0-9])")),
    ("date", _date, re.compile(
        r"(?<![0-9A-Za-z./-])(?:[0-9]{4}([/-])[0-9]{2}\1[0-9]{2}"
        r"|[0-9]{2}([/.-])[0-9]{2}\2[0-9]{4}|[1-9][0-9]?([/.-])[1-9][0-9]?\3[0-9]{4})"
        r"(?:(?=T[0-9]{2}:)|(?![0-9A-Za-z]|[./-][0-9]))")),
    ("date", _worded_date, re.compile(
        r"(?<![0-9A-Za-z./-])[0-9]{1,2}(?:\. ?| de | |-)[^\W\d_]{3,10}(?:\.? | de |-)[0-9]{4}"
        r"(?![0-9A-Za-z]|[./-][0-9])"
        r"|(?<![^\W_])[A-Z][A-Za-z]{2,8}\.? [0-9]{1,2},? [0-9]{4}(?![0-9A-Za-z]|[./-][0-9])")),
    ("ssn", _ssn, re.compile(
        r"(?<![0-9A-Za-z-])(?<![0-9] )[0-9]{3}([ -])[0-9]{2}\1[0-9]{4}(?![0-9A-Za-z]|[ -][0-9])")),
    ("card", _card, re.compile(
        r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?"
        r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})(?![0-9A-Za-z])")),
    ("phone", _phone, re.compile(
        r"(?<![0-9A-Za-z+])\+(?:[0-9]{9,15}|[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])"
        r"[0-9]{3,4}[ .-]?[0-9]{3,4})(?![0-9A-Za-z])"
        r"|(?<![0-9A-Za-z)])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
        r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-](?:[0-9](?:[ .-][0-9]{2}){4}"
        r"|[0-9]{3}(?:[ .-][0-9]{2}){3}|[0-9]{3}(?:[ .-][0-9]{3}){2}|[0-9]{2,4}[ .-][0-9]{6,8})"
        r"(?![0-9A-Za-z])"
        r"|(?<![0-9A-Za-z.-])(?<![0-9] )0[0-9]([ .-])[0-9]{2}(?:\1[0-9]{2}){3}(?![0-9A-Za-z]|[ .-][0-9])"
        r"|(?<![0-9A-Za-z.-])(?<![0-9] )[0-9]{3}([ .-])[0-9]{3}\2[0-9]{4}(?![0-9A-Za-z]|[ .-][0-9])")),
]
HINT = re.compile("[0-9@]")


def _overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span meets one of the sorted, disjoint spans."""
    i = bisect_left(taken, (end, 0))
    return i > 0 and taken[i - 1][1] > start


def replace(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, list[tuple]]:
    """The text with pseudonyms, and (kind, start, end) of each in the old text.
    ``back`` takes pseudonyms for values again."""
    if not text or not HINT.search(text):
        return text, []

    def move(tweak: str, size: int, value: int) -> int:
        return permute(key, tweak, size, value, back)
    found, taken = [], []
    for kind, change, pattern in FORMATS:
        if kind == "email" and "@" not in text:
            continue
        at = 0
        while m := pattern.search(text, at):
            start = m.start()
            new = None if _overlaps(taken, start, m.end()) else change(m[0], move)
            if new is None:
                at = start + 1     # what begins inside may still be valid
            else:
                # An address may change its length; an IBAN may end before its match.
                at = start + len(new) if kind == "iban" else m.end()
                found.append((start, at, kind, new))
        taken = sorted((a, b) for a, b, _, _ in found)
    out, at = [], 0
    found.sort()
    for a, b, _, new in found:
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:], [(kind, a, b) for a, b, kind, _ in found]


def _replaced(batches: Iterator[pa.RecordBatch], key: bytes, back: bool):
    """(row, text) to (row, text, found)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            done = [replace(t, key, back) for t in part.column("text").to_pylist()]
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in f] for _, f in done]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array([t for t, _ in done], pa.string()),
                 pa.array(spans, kind)], names=["row", "text", "found"])


def pseudonymise(docs: DataFrame, key: bytes, *, text: str = "text",
                 back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and pii_found: kind, start and end of
    what was replaced, in code points of the old text.

    All rows and columns stay; a clashing name gets a leading underscore. Null
    and empty texts stay as they are, with nothing found. Rows do not depend on
    each other, so repeated rows give equal results. ``back`` restores.
    """
    others = [c for c in docs.columns if c != text]
    packed = docs.select(F.struct(*(named(c) for c in others), F.lit(0).alias("_")).alias("row"),
                         named(text).alias("text"))
    span = StructType().add("kind", "string").add("start", "long").add("end", "long")
    schema = StructType([packed.schema["row"]]).add("text", "string").add("found", ArrayType(span))
    out = packed.mapInArrow(lambda batches: _replaced(batches, key, back), schema)
    return out.select(*(F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c)
                        for c in docs.columns), F.col("found").alias(fresh(docs, "pii_found")))


def restore(docs: DataFrame, key: bytes, *, text: str = "text") -> DataFrame:
    """The texts that ``pseudonymise`` was given, under the same key."""
    return pseudonymise(docs, key, text=text, back=True)

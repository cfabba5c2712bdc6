"""Format-preserving pseudonyms by a keyed Feistel network.

Values that look private and hold up to validation (check digits, ranges, calendar) are replaced by others of the same
format: the same kind, separators and letter case, with valid check digits. A value is numbered within its format, and
the number x in [0, m) becomes P'(P(x) + s), P a Feistel permutation of [0, m) under the key and the kind, P' its
inverse and s a fixed step. That is a permutation without fixed points: equal values stay equal in all documents,
different ones different, none stays itself, and whoever has the key can restore them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from parcelwise.llm import bytewise

ROUNDS = 10

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_EPOCH, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


class Cipher:
    def __init__(self, key: bytes, backwards: bool = False) -> None:
        self.key, self.backwards = key, backwards

    def _permute(self, kind: str, x: int, m: int, inverse: bool) -> int:
        """Feistel network on the smallest even number of bits that holds m, walked until the value is below m."""
        half = max(1, ((m - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        while True:
            left, right = x >> half, x & mask
            for k in range(ROUNDS):
                k = ROUNDS - 1 - k if inverse else k
                spoken = left if inverse else right
                text = f"{kind}/{m}/{k}/{spoken}".encode()
                word = int.from_bytes(blake2b(text, key=self.key, digest_size=(half + 7) // 8 + 8).digest(), "big") & mask
                left, right = (right ^ word, left) if inverse else (right, left ^ word)
            x = left << half | right
            if x < m:
                return x

    def number(self, kind: str, x: int, m: int) -> int:
        """The pseudonym of x in [0, m)."""
        if m < 2:
            return x
        step = 1 + int.from_bytes(blake2b(f"{kind}/{m}".encode(), key=self.key, digest_size=8).digest(), "big") % (m - 1)
        step = -step if self.backwards else step
        return self._permute(kind, (self._permute(kind, x, m, False) + step) % m, m, True)

    def text(self, kind: str, value: str) -> str:
        """Letters become letters of the same case and digits digits; other characters stay."""
        x, m, places = 0, 1, []
        for c in value:
            base = 10 if c in "0123456789" else 26 if c.lower() in _LETTERS else 1
            places.append(base)
            if base > 1:
                x, m = x * base + ("0123456789".find(c) if base == 10 else _LETTERS.find(c.lower())), m * base
        y, out = self.number(kind, x, m), []
        for c, base in zip(reversed(value), reversed(places)):
            if base > 1:
                y, digit = divmod(y, base)
                new = str(digit) if base == 10 else _LETTERS[digit]
                c = new.upper() if c.isupper() else new
            out.append(c)
        return "".join(reversed(out))


def _refill(pattern: str, digits: str) -> str:
    """The digits in the places of the pattern's digits."""
    left = iter(digits)
    return "".join(next(left) if c in "0123456789" else c for c in pattern)


def _digits(value: str) -> str:
    return re.sub(r"[^0-9]", "", value)


def luhn(digits: str) -> int:
    """Check digit to be appended."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def card(value: str, cipher: Cipher) -> str | None:
    digits = _digits(value)
    if luhn(digits[:-1]) != int(digits[-1]) or not digits.strip("0"):
        return None
    body = digits[0] + cipher.text("card", digits[1:-1])
    return _refill(value, f"{body}{luhn(body)}")


def _iban_check(country: str, rest: str) -> str:
    text = "".join(str(int(c, 36)) for c in f"{rest}{country}00".upper())
    return f"{98 - int(text) % 97:02d}"


def iban(value: str, cipher: Cipher) -> str | None:
    plain = value.replace(" ", "")
    country, check, rest = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or _iban_check(country, rest) != check:
        return None
    rest = cipher.text(f"iban {country}", rest)
    left = iter(f"{country}{_iban_check(country, rest)}{rest}")
    return "".join(c if c == " " else next(left) for c in value)


def social(value: str, cipher: Cipher) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if not (1 <= area <= 899 and area != 666 and group and serial):
        return None
    area -= 2 if area > 666 else 1
    x = cipher.number("social", (area * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999)
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return f"{area + (2 if area >= 665 else 1):03d}-{group + 1:02d}-{serial + 1:04d}"


def address(value: str, cipher: Cipher) -> str | None:
    x = 0
    for part in value.split("."):
        x = x << 8 | int(part)
    x = cipher.number("ipv4", x, 1 << 32)
    return ".".join(str(x >> k & 255) for k in (24, 16, 8, 0))


def phone(value: str, cipher: Cipher) -> str | None:
    digits = _digits(value)
    if not 8 <= len(digits) <= 15:
        return None
    keep = min(3, len(re.match(r"\+?([0-9]*)", value)[1])) if value[0] == "+" else 0
    if value[0] == "+" and keep == 3 and value[4:5].isdigit():
        keep = 1 if digits[0] in "17" else 2
    return _refill(value, digits[:keep] + cipher.text("phone", digits[keep:]))


def email(value: str, cipher: Cipher) -> str | None:
    local, _, domain = value.rpartition("@")
    return f"{cipher.text('email ' + domain.lower(), local)}@{domain}"


def secret(value: str, cipher: Cipher) -> str | None:
    """Hexadecimal keys of 32 or more digits, not all of one kind."""
    if value.isdigit() or value.isalpha():
        return None
    x = int(value, 16)
    while True:
        x = cipher.number("secret", x, 16 ** len(value))
        new = f"{x:0{len(value)}x}"
        if not new.isdigit() and not new.isalpha():
            return new.upper() if value.upper() == value else new


def _day(year: int, month: int, day: int) -> int | None:
    try:
        n = (date(year, month, day) - _EPOCH).days
    except ValueError:
        return None
    return n if 0 <= n < _DAYS else None


def calendar(value: str, cipher: Cipher) -> str | None:
    """Dates from 1900 to 2099. Day and month in doubt are read day first; the others stay such that they can't be."""
    a, separator, b, c = re.match(r"([0-9]+)([-/.])([0-9]+)[-/.]([0-9]+)", value).groups()
    if len(a) == 4:
        n, form = _day(int(a), int(b), int(c)), "iso"
    else:
        n, form = _day(int(c), int(b), int(a)), "day"
        if n is None:
            n, form = _day(int(c), int(a), int(b)), "month"
    if n is None:
        return None
    while True:
        n = cipher.number(f"date {form}", n, _DAYS)
        d = _EPOCH + timedelta(days=n)
        if form != "month" or d.day > 12:
            break
    parts = {"iso": (d.year, d.month, d.day), "day": (d.day, d.month, d.year), "month": (d.month, d.day, d.year)}[form]
    return separator.join(f"{p:0{4 if p > 31 else 2}d}" for p in parts)


_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Kind, pattern and replacement, tried in this order at each place.
KINDS: tuple[tuple[str, str, Callable[[str, Cipher], str | None]], ...] = (
    ("email", r"(?<![\w.+-])[A-Za-z0-9._+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])", email),
    ("iban", r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?!\w)", iban),
    ("secret", r"(?<!\w)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?!\w)", secret),
    ("card", r"(?<![\w.-])(?:[0-9]{13,19}|[0-9]{4}(?P<c>[ -])[0-9]{4}(?P=c)[0-9]{4}(?P=c)[0-9]{4}|[0-9]{4}(?P<d>[ -])[0-9]{6}(?P=d)[0-9]{5})(?![\w-])", card),
    ("social", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", social),
    ("date", r"(?<![\w/.-])(?:[0-9]{4}(?P<y>[-/.])[0-9]{2}(?P=y)[0-9]{2}|[0-9]{2}(?P<z>[-/.])[0-9]{2}(?P=z)[0-9]{4})(?![\w/-]|\.[0-9])", calendar),
    ("address", rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.[0-9])", address),
    ("phone", r"(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?!\w)", phone),
    ("phone", r"(?<![\w+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])", phone),
)


_ANY = re.compile("|".join(f"(?P<k{k}>{pattern})" for k, (_, pattern, _) in enumerate(KINDS)))
_EACH = [(kind, re.compile(pattern), replacement) for kind, pattern, replacement in KINDS]
#: Lengths of IBANs by country, and numbers of digits of phones by the first digits after the plus sign.
_IBAN_LENGTHS = {
    country: int(length)
    for length, countries in (
        line.split(":")
        for line in (
            "15:NO", "16:BE", "18:DK FI FK FO GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU XK MN", "21:CH HR LI LV",
            "22:BG BH CR DE GB GE IE ME RS VA", "23:AE GI IL IQ OM SO TL", "24:AD CZ ES MD PK RO SA SE SK TN VG DZ",
            "25:AO CV GW LY MZ PT", "26:IS TR", "27:BF BI BJ CF CG CI CM DJ FR GA GQ GR IT KM MC MG ML MR NE SM SN TD TG",
            "28:AL AZ BY CY DO GT HN HU LB NI PL SV", "29:BR EG PS QA UA", "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU",
        )
    )
    for country in countries.split()
}
_PHONE_DIGITS = {"1": 11, "7": 11, "30": 12, "31": 11, "33": 11, "34": 11, "41": 11, "45": 10, "47": 10, "48": 11, "91": 12}
_NEEDED = np.zeros(256, bool)
_NEEDED[list(b"0123456789@")] = True


def _candidates(kind: str, value: str) -> list[str]:
    """The match or parts of it up to the end of a group, in the order in which they are tried: words and numbers that
    follow may have been taken for groups. The order depends on what a pseudonym keeps, so that it can be restored."""
    if kind not in ("iban", "phone"):
        return [value]
    parts = [value[: m.start()] for m in re.finditer(" " if kind == "iban" else "[ .-]", value)] + [value]
    if kind == "iban":
        known = _IBAN_LENGTHS.get(value[:2])
        return [p for p in parts if len(p.replace(" ", "")) == known] + [value]
    if value[0] != "+":
        return [value]
    digits = _digits(value)
    known = _PHONE_DIGITS.get(digits[:1]) or _PHONE_DIGITS.get(digits[:2])
    known = known and known + ("(0)" in value)
    return [p for p in parts if len(_digits(p)) == known] + parts[::-1]


def _first(text: str, m: re.Match, cipher: Cipher) -> tuple[str, str, str] | None:
    """(kind, value, pseudonym) of what begins where the match begins, by the match's kind or a later one."""
    at = int(m.lastgroup[1:])  # the group that closes last
    for kind, pattern, replacement in _EACH[at:]:
        if found := pattern.match(text, m.start()):
            for value in _candidates(kind, found[0]):
                if (new := replacement(value, cipher)) is not None:
                    return kind, value, new
    return None


def replace(text: str, cipher: Cipher) -> tuple[str, list[tuple[str, int, int]]]:
    """(new text, (kind, start, length) of each replacement, in code points of the new text)."""
    out, found, done, shift, at = [], [], 0, 0, 0
    while m := _ANY.search(text, at):
        hit = _first(text, m, cipher)
        if hit is None:  # go on after the first group
            at = m.start() + len(m[0].split(" ")[0])
            continue
        kind, value, new = hit
        out += [text[done : m.start()], new]
        found.append((kind, m.start() + shift, len(new)))
        shift += len(new) - len(value)
        at = done = m.start() + len(value)
    return "".join([*out, text[done:]]), found


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the parts of texts that may hold private values, in bytes, from blank to blank.

    Every blank-separated part of a value has a digit or an at sign, but for IBAN groups, of which two letter groups may
    follow one another: the parts are taken with two words on either side.
    """
    starts, ends, rows = bytewise.spans(bytewise.NOT_SPACE[data], offsets)
    hit = np.zeros(len(starts), bool)
    hit[np.searchsorted(starts, np.flatnonzero(_NEEDED[data]), "right") - 1] = True
    near = hit.copy()
    for k in (1, 2):
        same = rows[k:] == rows[:-k]
        near[k:] |= hit[:-k] & same
        near[:-k] |= hit[k:] & same
    joined = near[:-1] & near[1:] & (rows[1:] == rows[:-1])
    first, last = near.copy(), near.copy()
    first[1:] &= ~joined
    last[:-1] &= ~joined
    return starts[first], ends[last], rows[first]


def pseudonymise(docs: DataFrame, key: bytes, *, backwards: bool = False) -> DataFrame:
    """All columns of the documents with `text` replaced, and `replaced`, an array of (kind, start, length).

    Each row is treated by itself, so the result is the same in every run and partition. Nulls and texts without
    private values stay as they are. A column named `replaced` is replaced. `key` has 64 bytes at most; `backwards`
    restores.
    """
    own = [c for c in docs.columns if c != "replaced"]
    docs = docs.select(*[f"`{c}`" for c in own])
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = Cipher(key, backwards)
        for batch in batches:
            texts = batch.column("text")
            news, found = {}, [[] for _ in range(batch.num_rows)]
            for low, _, data, offsets in bytewise.slices(texts):
                state: tuple = (None, [], 0, 0)  # row, new parts, bytes done, length of the new parts

                def close():
                    row, parts, done, _ = state
                    if row is not None and found[low + row]:
                        news[low + row] = "".join([*parts, data[done : offsets[row + 1]].tobytes().decode()])

                for a, b, row in zip(*(x.tolist() for x in windows(data, offsets))):
                    new, spans = replace(data[a:b].tobytes().decode(), cipher)
                    if not spans:
                        continue
                    if row != state[0]:
                        close()
                        state = (row, [], int(offsets[row]), 0)
                    _, parts, done, length = state
                    before = data[done:a].tobytes().decode()
                    at = length + len(before)
                    found[low + row] += [{"kind": k, "start": at + s, "length": n} for k, s, n in spans]
                    parts += [before, new]
                    state = (row, parts, b, at + len(new))
                close()
            if news:
                mask = np.zeros(batch.num_rows, bool)
                mask[list(news)] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([news[k] for k in sorted(news)], texts.type))
            columns = [texts if n == "text" else c for n, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(item))], [*batch.schema.names, "replaced"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(bytewise.lean(run), f"{fields}, replaced array<struct<kind string, start int, length int>>")

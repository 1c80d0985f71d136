"""Personal data replaced by format-preserving pseudonyms.

Each value found is validated (check digits, ranges, calendar), read as a number in the
set of values of its own format, and that set is permuted by a keyed Feistel network:
the result is another valid value of the same format.  Equal values have equal
pseudonyms in every document, different values have different ones, and with the key the
permutation can be undone.  Separators, letter case and mail domains stay.

Kinds, in the order in which overlapping finds are decided: mail address, IBAN, key or
token, payment card (Luhn), social security number, IP address, date, phone number.
A pseudonym is made from the key, the kind and the value alone, never from the text
around it.  Cards and IBANs that stand among other groups of digits (expiry date, CVV,
amount, numbers before) are found by the lengths of their issuer or country first;
runs of other lengths that validate, the longest first, only where nothing else was found.
What was replaced is undone from the spans that :func:`replaced` returns.

Defined cases: a NULL text stays NULL with 0 finds, an empty one stays empty; NULL ids
do not matter; repeated rows are handled alike; an empty table gives an empty result;
other columns pass through, those named like an added column are replaced.
"""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import ipaddress
import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strataload.llm.common import append

_ROUNDS = 10


@dataclass(frozen=True)
class PiiSpec:
    """``key`` is the secret of the permutation: give your own in production."""

    key: bytes = b"strataload pseudonyms"


class Feistel:
    """Keyed permutations of range(n), one for each n and name."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, name: str, step: int, half: int, width: int) -> int:
        data = f"{name}|{step}|{width}|{half:x}".encode()
        size = min(64, (width + 7) // 8 + 8)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=size).digest(), "big")

    def _network(self, value: int, name: str, width: int, undo: bool) -> int:
        mask = (1 << width) - 1
        left, right = value >> width, value & mask
        if undo:
            for step in reversed(range(_ROUNDS)):
                left, right = right ^ (self._round(name, step, left, width) & mask), left
        else:
            for step in range(_ROUNDS):
                left, right = right, left ^ (self._round(name, step, right, width) & mask)
        return left << width | right

    def permute(
        self, value: int, n: int, name: str, valid: Callable[[int], bool] = lambda _: True, undo: bool = False
    ) -> int:
        """Walks the network's cycle from ``value`` to the next valid number below ``n``."""
        width = max(1, ((n - 1).bit_length() + 1) // 2)
        while True:
            value = self._network(value, name, width, undo)
            if value < n and valid(value):
                return value


_DIGITS, _LOWER, _UPPER, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def _recode(net: Feistel, text: str, name: str, undo: bool, hexadecimal: bool = False) -> str:
    """Digits, lower and upper case letters permuted together, each within its class."""
    folded = text.lower() if hexadecimal else text
    alphabets = [
        _HEX if hexadecimal and c in _HEX else next((a for a in (_DIGITS, _LOWER, _UPPER) if c in a), None) for c in folded
    ]
    value, n = 0, 1
    for c, alphabet in zip(folded, alphabets):
        if alphabet:
            value, n = value * len(alphabet) + alphabet.index(c), n * len(alphabet)
    if n == 1:
        return text
    shape = "".join(str(len(a)) if a else "." for a in alphabets)

    value = net.permute(value, n, f"{name}:{shape}", undo=undo)
    out = []
    for c, original, alphabet in zip(reversed(folded), reversed(text), reversed(alphabets)):
        if alphabet:
            value, at = divmod(value, len(alphabet))
            c = alphabet[at].upper() if hexadecimal and original.isupper() else alphabet[at]
        out.append(c)
    return "".join(reversed(out))


def _refill(shape: str, digits: str) -> str:
    """``digits`` in the places of the digits of ``shape``."""
    rest = iter(digits)
    return "".join(next(rest) if c in _DIGITS else c for c in shape)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _mail(net: Feistel, found: re.Match, undo: bool) -> str | None:
    local, domain = found.group().rsplit("@", 1)
    changed = _recode(net, local.lower(), "mail", undo)
    return "".join(c.upper() if o.isupper() else c for c, o in zip(changed, local)) + "@" + domain


def _iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


# Length of an IBAN by country.
_IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
_SPACES = " \u00a0\u2009\u202f"


def _plain(found: str) -> str:
    return "".join(c for c in found if c not in _SPACES)


def _iban_valid(found: str) -> bool:
    plain = _plain(found).upper()
    return found in (found.upper(), found.lower()) and _iban_check(plain[:2], plain[4:]) == plain[2:4]


def _iban_usual(found: str) -> bool:
    plain = _plain(found).upper()
    return _IBAN_LENGTHS.get(plain[:2]) == len(plain)


def _iban(net: Feistel, found: re.Match, undo: bool) -> str | None:
    text = found.group()
    if not _iban_valid(text):
        return None
    plain = _plain(text).upper()
    country = plain[:2]
    body = _recode(net, plain[4:], f"iban{country}", undo)
    rest = iter(country + _iban_check(country, body) + body)
    new = "".join(c if c in _SPACES else next(rest) for c in text)
    return new if text == text.upper() else new.lower()


def _secret(net: Feistel, found: re.Match, undo: bool) -> str | None:
    prefix, value = found.group(1), found.group(2)
    plain = value.lower() in (value, value.swapcase()) and all(c in _HEX for c in value.lower())
    return prefix + _recode(net, value, "secret", undo, hexadecimal=plain)


def _card_valid(found: str) -> bool:
    digits = _only_digits(found)
    return luhn_digit(digits[:-1]) == digits[-1]


# First digits of payment cards and the usual lengths of their numbers.
_ISSUERS = [
    (range(4, 5), (16,)),
    (range(51, 56), (16,)),
    (range(2221, 2721), (16,)),
    (range(34, 35), (15,)),
    (range(37, 38), (15,)),
    (range(300, 306), (14,)),
    (range(36, 37), (14,)),
    (range(38, 40), (14,)),
    (range(3528, 3590), (16,)),
    (range(6011, 6012), (16,)),
    (range(644, 660), (16,)),
    (range(62, 63), (16, 17, 18, 19)),
]


def _card_usual(found: str) -> bool:
    if "." in found and min(map(len, re.split("[^0-9]", found))) < 3:
        return False  # a decimal number
    digits = _only_digits(found)
    return any(len(digits) in sizes and int(digits[: len(str(first[0]))]) in first for first, sizes in _ISSUERS)


def _card(net: Feistel, found: re.Match, undo: bool) -> str | None:
    if not _card_valid(found.group()):
        return None
    digits = _only_digits(found.group())
    size, usual = len(digits) - 1, _card_usual(digits)

    def alike(value: int) -> bool:
        return _card_usual(f"{value:0{size}d}0") == usual

    body = f"{net.permute(int(digits[:-1]), 10**size, f'card{size}', alike, undo):0{size}d}"
    return _refill(found.group(), body + luhn_digit(body))


def _ssn_valid(value: int) -> bool:
    area, group, serial = value // 10**6, value // 10**4 % 100, value % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(net: Feistel, found: re.Match, undo: bool) -> str | None:
    value = int(_only_digits(found.group()))
    if not _ssn_valid(value):
        return None
    return _refill(found.group(), f"{net.permute(value, 10**9, 'ssn', _ssn_valid, undo):09d}")


def _ip(net: Feistel, found: re.Match, undo: bool) -> str | None:
    parts = [int(p) for p in found.group().split(".")]
    if max(parts) > 255:
        return None
    value = net.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip", undo=undo)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _ipv6(net: Feistel, found: re.Match, undo: bool) -> str | None:
    """An address in any of its spellings is one value; the pseudonym has the shortest one."""
    text = found.group()
    groups = [g for g in text.split(":") if g]
    if len(groups) < 3 or not any(c in _DIGITS for c in text):
        return None
    try:
        value = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    new = str(ipaddress.IPv6Address(net.permute(value, 1 << 128, "ipv6", undo=undo)))
    return new.upper() if text == text.upper() and text != text.lower() else new


_FIRST_DAY, _DAYS = dt.date(1900, 1, 1), (dt.date(2100, 1, 1) - dt.date(1900, 1, 1)).days


# years that two digits stand for
_SHORT_FIRST = dt.date(1950, 1, 1)
_SHORT_DAYS = (dt.date(2050, 1, 1) - _SHORT_FIRST).days


def _other_day(net: Feistel, day: dt.date, undo: bool, short: bool, late: bool) -> dt.date | None:
    """The pseudonym of a day of 1900 to 2099, or of 1950 to 2049 if the year has two digits.

    ``late``: the new day is after the 12th, so that it is read day first again.
    """
    first, days = (_SHORT_FIRST, _SHORT_DAYS) if short else (_FIRST_DAY, _DAYS)
    value = (day - first).days
    if not 0 <= value < days:
        return None
    name = ("short " if short else "") + ("late date" if late else "date")
    return first + dt.timedelta(net.permute(value, days, name, lambda n: not late or (first + dt.timedelta(n)).day > 12, undo))


def _date(net: Feistel, found: re.Match, undo: bool) -> str | None:
    """Year first, or day and month first: month/day unless only day/month is a date."""
    parts = re.split(r"([-/.])", found.group())
    a, b, c = (int(parts[i]) for i in (0, 2, 4))
    year_first, short = len(parts[0]) == 4, len(parts[4]) == 2 and len(parts[0]) < 4
    day_first = not year_first and (parts[1] == "." or a > 12)
    if short:
        c += 1900 if c >= 50 else 2000
    try:
        day = dt.date(*((a, b, c) if year_first else (c, b, a) if day_first else (c, a, b)))
    except ValueError:
        return None
    new = _other_day(net, day, undo, short, late=day_first and parts[1] != ".")
    if new is None:
        return None
    year = f"{new.year % 100:02d}" if short else f"{new.year:04d}"
    two = f"{new.month:02d}", f"{new.day:02d}"
    texts = (year, *two) if year_first else (*(two[::-1] if day_first else two), year)
    return texts[0] + parts[1] + texts[1] + parts[3] + texts[2]


# Names of the months, whole and short.
_MONTHS = {
    "en": "january february march april may june july august september october november december",
    "en short": "jan feb mar apr may jun jul aug sep oct nov dec",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}
_MONTH_NAMES = {kind: names.split() for kind, names in _MONTHS.items()}
_MONTH = "|".join(sorted({n for names in _MONTH_NAMES.values() for n in names}, key=len, reverse=True))


def _named_date(net: Feistel, found: re.Match, undo: bool) -> str | None:
    """A date with the month's name, in the language of that name (the first that has it)."""
    part = found.groupdict()
    name, day, year = (part[k + "1"] or part[k + "2"] for k in ("month", "day", "year"))
    kind, number = next((k, names.index(name.lower()) + 1) for k, names in _MONTH_NAMES.items() if name.lower() in names)
    try:
        new = _other_day(net, dt.date(int(year), number, int(day)), undo, short=False, late=False)
    except ValueError:
        return None
    if new is None:
        return None
    month = _MONTH_NAMES[kind][new.month - 1]
    month = month.upper() if name.isupper() else month.capitalize() if name[0].isupper() else month
    values = {"month": month, "day": f"{new.day:02d}", "year": f"{new.year:04d}"}
    spans = sorted((found.span(k), values[k[:-1]]) for k, v in part.items() if v is not None)
    out, at = [], found.start()
    for (start, end), value in spans:
        out += [found.string[at:start], value]
        at = end
    return "".join(out) + found.string[at : found.end()]


def _phone(net: Feistel, found: re.Match, undo: bool) -> str | None:
    """The country code after a plus sign or 00 stays: 1, else the digits up to the first separator."""
    text = found.group()
    digits = _only_digits(text)
    code = 0
    if text[0] == "+":
        code = 1 if digits[0] == "1" else len(re.match(r"\+([0-9]{1,3})", text).group(1))
    elif text.startswith("00"):
        code = 3 if digits[2] == "1" else len(re.match(r"00[0-9]{1,3}", text).group())
    national = digits[code:]
    if not 7 <= len(national) <= 14:
        return None
    size = len(national)
    value = net.permute(int(national), 10**size, f"phone{size}", undo=undo)
    return _refill(text, digits[:code] + f"{value:0{size}d}")


def _called(net: Feistel, found: re.Match, undo: bool) -> str | None:
    """Digits without separators after a word that says that they are a phone number."""
    size = len(found.group(2))
    return found.group(1) + f"{net.permute(int(found.group(2)), 10**size, f'phone{size}', undo=undo):0{size}d}"


_CARD_GROUPS = r"[0-9](?:[ .\u00a0\u2009\u202f-]?[0-9]){12,18}(?![0-9])"
_IBAN_GROUPS = r"(?:[ \u00a0\u2009\u202f]?%s{4}){2,7}(?:[ \u00a0\u2009\u202f]?%s{1,3})?\b"

# pattern, what a text must contain for a match, pseudonym (None: not valid, left alone)
_KINDS: list[tuple[str, re.Pattern, str, Callable]] = [
    ("mail", re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}\b"), "@", _mail),
    ("iban", re.compile(r"\b[A-Z]{2}[0-9]{2}" + _IBAN_GROUPS % (("[A-Z0-9]",) * 2)), "0-9", _iban),
    ("iban", re.compile(r"\b[a-z]{2}[0-9]{2}" + _IBAN_GROUPS % (("[a-z0-9]",) * 2)), "0-9", _iban),
    (
        "secret",
        re.compile(
            r"((?i:(?:token|secret|passwd|password|api[_-]?key|access[_-]?key|private[_-]?key)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?))"
            r"([A-Za-z0-9][A-Za-z0-9_+/-]{7,})"
        ),
        "=:",
        _secret,
    ),
    ("secret", re.compile(r"\b(AKIA|ASIA|ghp_)([A-Za-z0-9]{16,36})\b"), "", _secret),
    ("card", re.compile(r"(?<![0-9])" + _CARD_GROUPS), "0-9", _card),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), "0-9", _ssn),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"), "0-9", _ip),
    (
        "date",
        re.compile(
            r"(?<![0-9./-])(?:[0-9]{4}([./-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([./-])[0-9]{1,2}\2[0-9]{4}"
            r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2})(?![0-9/-])(?!\.[0-9])"
        ),
        "0-9",
        _date,
    ),
    (
        "date",
        re.compile(
            rf"(?i)\b(?:(?P<day1>[0-9]{{1,2}})(?:st|nd|rd|th|er|\.)?(?: de)? (?P<month1>{_MONTH})\.?,?(?: de)? (?P<year1>[0-9]{{4}})"
            rf"|(?P<month2>{_MONTH})\.? (?P<day2>[0-9]{{1,2}})(?:st|nd|rd|th)?,? (?P<year2>[0-9]{{4}}))\b"
        ),
        "0-9",
        _named_date,
    ),
    (
        "ip",
        re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:)[0-9A-Fa-f:]{4,39}(?![\w:])"),
        ":",
        _ipv6,
    ),
    (
        "phone",
        re.compile(
            r"(?<![\w.+-])(?:(?:\+|00(?=[1-9]))[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
            r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])(?!-[0-9])"
        ),
        "0-9",
        _phone,
    ),
    (
        "phone",
        re.compile(
            r"((?i:\b(?:tel|telephone|phone|mobile|cell|fax|call|whatsapp)\b\.?\s{0,2}(?:no\.?|number)?\s{0,2}[:#]?\s{0,3}))"
            r"([0-9]{7,12})(?![0-9])"
        ),
        "0-9",
        _called,
    ),
]
_ANY_DIGIT = re.compile("[0-9]")
# kinds whose pattern can run on into the groups around a value: whether a run has a usual length
_GROUPED = {"iban": _iban_usual, "card": _card_usual}
_RUNS_ON = re.compile("[/.:][0-9]")  # the last group is the start of a date, an amount or a time
_SEPARATORS = " .-" + _SPACES


class _Taken:
    """Finds that do not overlap, in order."""

    def __init__(self):
        self.finds: list[tuple[int, int, str, str]] = []

    def free(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self.finds, (end,))  # the finds before it start before ``end``
        return not at or self.finds[at - 1][1] <= start

    def add(self, *find) -> None:
        bisect.insort(self.finds, find)


def _ends(pattern: re.Pattern, text: str, found: re.Match) -> list[re.Match]:
    """The match and those from its start to the ends of its earlier groups: longest first, ends that run on last."""
    start, end = found.span()
    ends = [at for at in range(end, start, -1) if at == end or text[at] in _SEPARATORS]
    ends.sort(key=lambda at: _RUNS_ON.match(text, at) is not None)
    return [shorter for at in ends if (shorter := pattern.fullmatch(text, start, at))]


def _alone(text: str, found: re.Match) -> bool:
    """No digit stands before the run or behind it, also across a sign."""
    before, after = text[max(0, found.start() - 2) : found.start()], text[found.end() : found.end() + 2]
    return not re.search(r"[0-9][.-]\Z|[.-]\Z", before) and not re.match("-[0-9]", after)


def _grouped(kind: str, pattern: re.Pattern, text: str, taken: _Taken, pseudonym: Callable, net: Feistel, undo: bool) -> None:
    """Finds of a usual length wherever they start; then the longest valid run of each other start.

    Lower-case IBANs and cards with dots are found by their usual length only: they look
    like other words and decimal numbers.
    """
    usual = _GROUPED[kind]
    for only_usual in (True, False):
        at = 0
        while found := pattern.search(text, at):
            at = found.start() + 1
            if not only_usual and (not _alone(text, found) or found.group()[:2].islower()):
                continue
            for tried in _ends(pattern, text, found):
                start, end = tried.span()
                if not usual(tried.group()) if only_usual else "." in tried.group():
                    continue
                if not taken.free(start, end):
                    continue
                new = pseudonym(net, tried, undo)
                if new is not None:
                    taken.add(start, end, kind, new)
                    at = end
                    break


def _finds(text: str, net: Feistel, undo: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of all values of a text, in order."""
    digit = _ANY_DIGIT.search(text) is not None
    taken = _Taken()
    for kind, pattern, need, pseudonym in _KINDS:
        if need == "0-9" and not digit or need and need != "0-9" and not any(sign in text for sign in need):
            continue
        if kind in _GROUPED:
            _grouped(kind, pattern, text, taken, pseudonym, net, undo)
            continue
        for found in pattern.finditer(text):
            start, end = found.span()
            if not taken.free(start, end):
                continue
            new = pseudonym(net, found, undo)
            if new is not None:
                taken.add(start, end, kind, new)
    return taken.finds


def _with(text: str, finds: list[tuple[int, int, str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with the new values, and where they are in it."""
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, new in finds:
        size += start - at
        spans.append((size, size + len(new), kind))
        out += [text[at:start], new]
        at, size = end, size + len(new)
    return "".join([*out, text[at:]]), spans


def pseudonymise(text: str | None, net: Feistel, undo: bool = False) -> tuple[str | None, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of what was replaced in the input.

    ``undo`` turns back what is found in a text; :func:`restored` turns back what was replaced.
    """
    finds = _finds(text, net, undo) if text else []
    return _with(text, finds)[0] if finds else text, [find[:3] for find in finds]


def replaced(text: str | None, net: Feistel) -> tuple[str | None, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of where these are in the result."""
    return _with(text, _finds(text, net)) if text else (text, [])


def restored(text: str, spans: list[tuple[int, int, str]], net: Feistel) -> str:
    """The text before :func:`replaced`, from its result and spans.

    Days and months come back with two digits, IPv6 addresses in their shortest spelling.
    """
    finds = []
    for start, end, kind in spans:
        for name, pattern, _, pseudonym in _KINDS:
            found = pattern.fullmatch(text, start, end) if name == kind else None
            old = found and pseudonym(net, found, True)
            if old is not None:
                finds.append((start, end, kind, old))
                break
        else:
            raise ValueError(f"no {kind} at {start} to {end}")
    return _with(text, finds)[0]


def pseudonymised(docs: DataFrame, spec: PiiSpec = PiiSpec()) -> DataFrame:
    """``docs`` with pseudonyms in text, and the columns n_replaced and kinds (of each find, in order)."""
    key = spec.key
    added = T.StructType().add("text", "string").add("n_replaced", "integer").add("kinds", T.ArrayType(T.StringType()))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        net = Feistel(key)
        done = [pseudonymise(text, net) for text in rows.text]
        return pd.DataFrame(
            {
                "text": [text for text, _ in done],
                "n_replaced": [len(found) for _, found in done],
                "kinds": [[kind for _, _, kind in found] for _, found in done],
            }
        )

    return append(docs, ["text"], run, added)


def private_text(docs: DataFrame, spec: PiiSpec = PiiSpec()) -> DataFrame:
    """Stage: ``docs`` with pseudonyms in text and, if there is such a column, n_chars to match."""
    key = spec.key
    added = T.StructType().add("text", "string")
    if "n_chars" in docs.columns:
        added = added.add(docs.schema["n_chars"])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        net = Feistel(key)
        texts = [pseudonymise(text, net)[0] for text in rows.text]
        return pd.DataFrame({"text": texts, "n_chars": [None if t is None else len(t) for t in texts]})

    return append(docs, ["text"], run, added).select(*docs.columns)

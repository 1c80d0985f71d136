"""One pseudonym per value, undone from spans; forms of values; work in proportion to the finds."""

import datetime as dt
import ipaddress
import random
import re
import time

import pytest

from strataload.llm.pii import Feistel, _iban_check, luhn_digit, pseudonymise, replaced, restored

NET = Feistel(b"values")
AROUND = [
    "{}", "pay {} now", "{} 123", "{} 12/25", "12 {}", "No.{}", "({})", "{} EUR", "card:{}, 99.50", "{} 4000 99", "{}.", "7 {} 7 7",
]


def cards():
    rng = random.Random(4)
    for first in ("4", "51", "37", "6011", "2345"):
        for _ in range(80):
            size = 14 if first == "37" else 15
            body = first + "".join(rng.choice("0123456789") for _ in range(size - len(first)))
            yield body + luhn_digit(body)


def ibans():
    rng = random.Random(5)
    for country, size in (("ES", 20), ("DE", 18), ("GB", 18), ("NO", 11)):
        for _ in range(100):
            body = "".join(rng.choice("0123456789") for _ in range(size))
            yield country + _iban_check(country, body) + body


@pytest.mark.parametrize("values, kind", [(list(cards()), "card"), (list(ibans()), "iban")], ids=["cards", "ibans"])
def test_one_pseudonym_in_all_surroundings(values, kind):
    for value in values:
        seen = set()
        for around in AROUND:
            text = around.format(value)
            changed, spans = replaced(text, NET)
            assert [k for _, _, k in spans] == [kind], text
            seen.add(changed[spans[0][0] : spans[0][1]])
            assert restored(changed, spans, NET) == text
        assert len(seen) == 1 and value not in seen


def test_values_and_pseudonyms_are_one_to_one():
    """Brute force: each value alone, its digits permuted, is what is found in a text of all of them."""
    values = list(cards()) + list(ibans())
    alone = {v: pseudonymise(v, NET)[0] for v in values}
    assert len(set(alone.values())) == len(set(values))
    changed, spans = replaced("\n".join(values), NET)
    assert changed.split("\n") == [alone[v] for v in values] and len(spans) == len(values)
    spaced = {v: re.sub(r"(.{4})(?=.)", r"\1 ", v) for v in values}
    for v in values:
        assert pseudonymise(spaced[v], NET)[0].replace(" ", "") == alone[v]


FORMS = [
    ("card No.4532015112830366", "card"), ("4532.0151.1283.0366", "card"), ("4532 0151 1283 0366", "card"),
    ("on 1984.02.29", "date"), ("on 1984-2-9", "date"), ("on 02/03/99", "date"), ("on 12 March 1984", "date"), ("March 12, 1984", "date"),
    ("le 3 février 1990", "date"), ("am 1. Mai 1971", "date"), ("el 4 de enero de 2001", "date"), ("Sept 2 was; Sep 2, 2001", "date"),
    ("es9121000418450200051332", "iban"), ("gb82 west 1234 5698 7654 32", "iban"), ("0044 20 7946 0958", "phone"),
    ("phone: 5551234567", "phone"), ("at 2001:db8::8a2e:370:7334 now", "ip"), ("FE80:0:0:0:202:B3FF:FE1E:8329", "ip"),
]


def address(text):
    return ipaddress.ip_address(re.search(r"[0-9A-Fa-f:]{6,}", text)[0])


@pytest.mark.parametrize("text, kind", FORMS)
def test_forms(text, kind):
    changed, spans = replaced(text, NET)
    assert [k for _, _, k in spans] == [kind] and changed != text
    back = restored(changed, spans, NET)
    if kind == "date":  # days and months come back with two digits
        assert [int(n) for n in re.findall(r"\d+", back)] == [int(n) for n in re.findall(r"\d+", text)]
    elif kind == "ip":
        assert address(back) == address(text)
    else:
        assert back == text
    again, others = replaced(f"x {text} y", NET)
    assert [again[s:e] for s, e, _ in others] == [changed[s:e] for s, e, _ in spans]


@pytest.mark.parametrize(
    "text",
    ["12:30:45", "std::vector", "a::b", "3.141592653589793", "32 March 1984", "may 1984", "5551234567", "1/2/345", "de12 abcd efgh ijkl mnop qr", "v1.2.3"],
)
def test_left_alone(text):
    assert pseudonymise(text, NET) == (text, [])


def test_short_years_stay_dates():
    for i in range(300):
        day = dt.date(1950, 1, 1) + dt.timedelta(121 * i)
        for text in (f"{day:%m/%d/%y}", f"{day:%d %B %Y}", f"{day:%Y/%m/%d}"):
            changed, spans = replaced(text, NET)
            assert len(spans) == 1 and restored(changed, spans, NET) == text


def test_spans_that_are_not_there():
    with pytest.raises(ValueError):
        restored("no card", [(0, 2, "card")], NET)


def test_work_grows_with_the_finds():
    def took(count):
        text = " ".join(f"user{i}@example.com 4532 0151 1283 0366" for i in range(count))
        start = time.process_time()
        assert len(pseudonymise(text, NET)[1]) == 2 * count
        return time.process_time() - start

    took(100)
    assert took(4000) < 8 * took(1000)

"""Cards and IBANs that are followed or preceded by other groups."""

import pytest

from strataload.llm.pii import Feistel, luhn_digit, pseudonymise


@pytest.mark.parametrize(
    "text, value, kind",
    [
        ("pay 4532015112830366 12/25", "4532015112830366", "card"),
        ("4532 0151 1283 0366 123", "4532 0151 1283 0366", "card"),
        ("4532-0151-1283-0366 99.50 EUR", "4532-0151-1283-0366", "card"),
        ("4532 0151 1283 0366/12", "4532 0151 1283 0366", "card"),
        ("12 4532015112830366", "4532015112830366", "card"),
        ("ES9121000418450200051332 EUR", "ES9121000418450200051332", "iban"),
        ("ES91 2100 0418 4502 0005 1332 PAID 2024", "ES91 2100 0418 4502 0005 1332", "iban"),
    ],
)
def test_value_before_other_groups(text, value, kind):
    net = Feistel(b"key")
    changed, found = pseudonymise(text, net)
    start = text.index(value)
    assert found == [(start, start + len(value), kind)]
    assert value not in changed and changed.replace(changed[start : start + len(value)], value) == text
    assert pseudonymise(changed, net, undo=True)[0] == text


def test_undone_whatever_follows():
    net = Feistel(b"key")
    for i in range(400):
        body = f"{453201511283036 + i * 7919}"
        for text in (f"card {body}{luhn_digit(body)} {i % 1000:03d}", f"{i % 100:02d} {body}{luhn_digit(body)} end"):
            changed, found = pseudonymise(text, net)
            assert found and changed != text and pseudonymise(changed, net, undo=True)[0] == text

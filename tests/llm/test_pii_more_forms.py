"""More forms of personal data, and tables of numbers, with expectations written by hand."""

import random
import time

import pytest

from gamestate.llm import pii

FOUND = {
    "born 3/4/1990 here": ("3/4/1990", "date"),
    "on 12/31/99.": ("12/31/99", "date"),
    "am 7.11.1985 in": ("7.11.1985", "date"),
    "ruf 030 1234567 an": ("030 1234567", "phone"),
    "call 020 7946 0958 now": ("020 7946 0958", "phone"),
    "0171/2345678": ("0171/2345678", "phone"),
    "ssn 123 45 6789 ok": ("123 45 6789", "ssn"),
    "pay gb82 west 1234 5698 7654 32 please": ("gb82 west 1234 5698 7654 32", "iban"),
    "see http://user:passw0rd@host/x": ("user:passw0rd", "login"),
    "mac 00:1B:44:11:3A:B7 up": ("00:1B:44:11:3A:B7", "mac"),
    "mac 00-1b-44-11-3a-b7": ("00-1b-44-11-3a-b7", "mac"),
    "Passport No: C01X00447 of": ("Passport No: C01X00447", "passport"),
}


@pytest.mark.parametrize("text", FOUND)
def test_found_and_reversed(text):
    value, kind = FOUND[text]
    (got,) = pii.find(text)
    assert (text[got[0] : got[1]], got[2]) == (value, kind)
    new, found = pii.pseudonymise(text, b"k")
    assert new != text and len(new) == len(text) and value not in new
    again = pii.find(new)
    assert [x[2] for x in again] == [kind]
    assert pii.pseudonymise(new, b"k", back=True, found=found)[0] == text


@pytest.mark.parametrize("text", ["1/2 cup", "ratio 3/4/5", "v1.2.3", "32/13/1999", "0 1234567", "03 12", "000 0000000", "12 30 1999", "http://host:8080/a@b", "00:1B:44:11:3A", "passport office", "Passport number DEPARTURE", "1 020 7946 0958 4", "0.30 1234567"])
def test_left_alone(text):
    assert pii.find(text) == []


def test_short_dates_are_permutations():
    made = {}
    for y in (1990, 1991):
        for m in range(1, 13):
            for d in range(1, 29):
                text = f"{d}/{m}/{y}"
                new = pii.pseudonymise(text, b"k")[0]
                assert made.setdefault(new, text) == text and len(new) == len(text)


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_tables_of_numbers(width):
    r = random.Random(width)
    text = " ".join(str(r.randrange(10**width)).zfill(width) for _ in range(200_000 // (width + 1)))
    began = time.perf_counter()
    pii.find(text)
    assert time.perf_counter() - began < 4

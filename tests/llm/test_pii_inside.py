"""Values inside or beside longer matches."""

import pytest

from gamestate.llm import pii

CARD, PHONE, IP, IBAN = "4111 1111 1111 1111", "+1 (826) 555-4081", "190.137.223.204", "AT61 1904 3002 3457 3201"


@pytest.mark.parametrize(
    "text, values",
    [
        (f"{CARD} 123", [(CARD, "card")]),
        ("12 4111111111111111", [("4111111111111111", "card")]),
        (f"2021-02-28 {CARD}", [("2021-02-28", "date"), (CARD, "card")]),
        (f"{PHONE} {IP}", [(PHONE, "phone"), (IP, "ipv4")]),
        (f"{IBAN} BANK", [(IBAN, "iban")]),
        (f"{IBAN} {IBAN}", [(IBAN, "iban"), (IBAN, "iban")]),
    ],
)
def test_values_beside_others(text, values):
    out, found = pii.pseudonymise(text, b"key")
    assert [(text[a:b], k) for a, b, k in found] == values
    assert len(out) == len(text) and all(v not in out for v, _ in values)
    assert pii.pseudonymise(out, b"key", back=True, found=found)[0] == text


def test_no_shorter_value_inside_a_run():
    for text in ("41111111111111111", "4111 1111 1111 1112", "+1 826 555 4081x", "x+1 826"):
        assert pii.find(text) == []

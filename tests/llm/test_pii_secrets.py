"""Secrets of any spelling and length."""

import random

import pytest

from gamestate.llm import pii

HEX = "".join(random.Random(1).choices("0123456789abcdef", k=40))


@pytest.mark.parametrize("word", ["token", "TOKEN", "Token", "SECRET", "Secret", "Passwd", "PASSWD", "passWord", "Api-Key", "API_key"])
def test_spellings(word):
    text = f'{word} = "{HEX}"'
    out, found = pii.pseudonymise(text, b"key")
    assert [k for _, _, k in found] == ["secret"] and HEX not in out
    assert pii.pseudonymise(out, b"key", back=True)[0] == text


@pytest.mark.parametrize("n", [100, 128, 129, 500, 3000, 60_000])
def test_long_values(n):
    value = "".join(random.Random(n).choices("abcdefghijkLMNOPQRSTUVwxyz0123456789", k=n))
    text = f"secret: {value} end"
    out, found = pii.pseudonymise(text, b"key")
    assert [(text[a:b], k) for a, b, k in found] == [(f"secret: {value}", "secret")] and len(out) == len(text)
    new = out[8 : 8 + n]
    for at in range(0, n - 19, 20):  # no stretch stays in clear
        assert new[at : at + 20] != value[at : at + 20]
    assert pii.pseudonymise(out, b"key", back=True)[0] == text


def test_letters_that_only_fold_to_key_words():
    for text in ("\u017fecret = abcdefghij", "to\u212aen = abcdefghij"):
        assert pii.pseudonymise(text, b"key") == (text, [])

"""Personal data gives way to format-preserving pseudonyms from a keyed Feistel network.

Found values are validated (check digits, ranges, calendar) and ranked among the values of their format; a Feistel
network over that rank, with cycle walking, gives the rank of the pseudonym. So a pseudonym is as valid and as long as
the value it replaces, equal values get equal pseudonyms in all documents, different ones of a format different ones, and
the key's holder can reverse it. The key is an argument without a default.

Numbers are permuted by their digits, whatever separates them, so differently written equal numbers stay linked; the
calling code of a phone comes from a table, not from its separators, and stays. Numeric dates of all orders share one
permutation, which keeps days up to 12 and days above 12 apart, since only those below can be read in two orders (as day
before month). Dates with a written month keep its language and length and the digits of the day, and are permuted among
the dates that are written alike; they aren't linked with numeric ones. Addresses of version 6 are permuted as written.

The domain of an address stays, so mail of one provider can still be told from that of another: a domain that names a
family or a firm of one person still points to them. Mask domains before this, if that matters.

Defined results: a null text stays null, an empty one empty, with nothing found; text outside found values is
untouched; repeated rows repeat; texts of any length are read whole, in a time in proportion to it (some 10 seconds for a
megabyte of short numbers); all other columns are kept as they are, but for one named spans, which gives way.
"""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import ipaddress
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8


def feistel(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of range(size)."""
    if size < 2:
        return x
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    wide = -(-a.bit_length() // 256)  # digests that cover a half
    steps = range(ROUNDS)[::-1] if back else range(ROUNDS)
    while True:
        left, right = divmod(x, b)
        for i in steps:
            seen = right if i % 2 == 0 else left
            said = [f"{tweak}|{size}|{i}|{seen}{f'|{n}' if n else ''}".encode() for n in range(wide)]
            h = b"".join(hashlib.blake2b(x, key=key, digest_size=32).digest() for x in said)
            f = int.from_bytes(h, "big") * (-1 if back else 1)
            if i % 2 == 0:
                left = (left + f) % a
            else:
                right = (right + f) % b
        x = left * b + right
        if x < size:
            return x


LONGEST = 128
Permute = Callable[[int, int, str], int]
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEX = "0123456789abcdef"


def _walk(step: Callable[[str], str], value: str, fits: Callable[[str], bool]) -> str:
    """Cycle walking: a permutation of the values that fit from one of a larger set. The value itself must fit."""
    value = step(value)
    while not fits(value):
        value = step(value)
    return value


def _letters(value: str, tweak: str, permute: Permute, classes: tuple[str, ...] = _CLASSES) -> str:
    """Every digit becomes a digit, every letter a letter of its case; other characters stay.

    Values above LONGEST characters are permuted in even parts, as ranks of long values take time by the square of their length.
    """
    if len(value) > LONGEST:
        n = -(-len(value) // LONGEST)
        cuts = [len(value) * k // n for k in range(n + 1)]
        return "".join(_letters(value[a:b], f"{tweak}{len(value)}|{k}|", permute, classes) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    rank, size, kinds = 0, 1, []
    for c in value:
        kind = next((k for k in classes if c in k), None)
        kinds.append(kind)
        if kind:
            rank, size = rank * len(kind) + kind.index(c), size * len(kind)
    rank, out = permute(rank, size, f"{tweak}{len(value)}"), []
    for c, kind in zip(reversed(value), reversed(kinds), strict=True):
        if kind:
            rank, at = divmod(rank, len(kind))
            c = kind[at]
        out.append(c)
    return "".join(reversed(out))


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _refill(shape: str, digits: str) -> str:
    it = iter(digits)
    return re.sub("[0-9]", lambda _: next(it), shape)


_TWICE = bytes(sum(divmod(2 * (c - 48), 10)) if 48 <= c < 58 else 0 for c in range(256))
_ONCE = bytes(c - 48 if 48 <= c < 58 else 0 for c in range(256))


def luhn_digit(body: str) -> str:
    b = body.encode()
    return str(-(sum(b[-1::-2].translate(_TWICE)) + sum(b[-2::-2].translate(_ONCE))) % 10)


def _card(value: str, permute: Permute) -> str | None:
    d = _digits(value)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None

    def step(x: str) -> str:
        body = x[0] + _letters(x[1:-1], "card", permute)
        return body + luhn_digit(body)

    return _refill(value, _walk(step, d, lambda x: len(set(x)) > 1))


def iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in f'{rest}{country}00')) % 97:02d}"


def _iban(value: str, permute: Permute) -> str | None:
    if value.islower():  # one case throughout
        made = _iban(value.upper(), permute)
        return made and made.lower()
    s = value.replace(" ", "")
    if not 15 <= len(s) <= 34 or iban_check(s[:2], s[4:]) != s[2:4]:
        return None
    rest = _letters(s[4:], "iban" + s[:2], permute)
    it = iter(s[:2] + iban_check(s[:2], rest) + rest)
    return "".join(c if c == " " else next(it) for c in value)


_AREAS = [a for a in range(1, 900) if a != 666]


def _ssn(value: str, permute: Permute) -> str | None:
    area, group, serial = int(value[:3]), int(value[4:6]), int(value[7:])
    if not 0 < area < 900 or area == 666 or not group or not serial:
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rank, serial = divmod(permute(rank, len(_AREAS) * 99 * 9999, "ssn"), 9999)
    return f"{_AREAS[rank // 99]:03d}{value[3]}{rank % 99 + 1:02d}{value[6]}{serial + 1:04d}"


#: Calling codes of one and two digits; all others have three.
_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}


def _american(rest: str) -> bool:
    return len(rest) == 10 and rest[0] >= "2" and rest[3] >= "2"


def _phone(value: str, permute: Permute) -> str | None:
    d = _digits(value)
    if value[0] == "0":  # dialled within a country: the leading zero stays
        return _refill(value, "0" + _letters(d[1:], "phone0", permute)) if 9 <= len(d) <= 12 and len(set(d)) > 2 else None
    if not 8 <= len(d) <= 15:
        return None
    code = "" if value[0] != "+" else next((d[:n] for n in (1, 2) if d[:n] in _CODES), d[:3])
    rest = d[len(code) :]
    if code in ("", "1") and _american(rest):
        area, exchange, line = int(rest[:3]) - 200, int(rest[3:6]) - 200, int(rest[6:])
        rank, line = divmod(permute((area * 800 + exchange) * 10_000 + line, 6_400_000_000, "phone"), 10_000)
        return _refill(value, f"{code}{rank // 800 + 200}{rank % 800 + 200}{line:04d}")
    tweak = "phone" + ("" if code == "1" else code)
    return _refill(value, code + _walk(lambda x: _letters(x, tweak, permute), rest, lambda x: code not in ("", "1") or not _american(x)))


def _ipv4(value: str, permute: Permute) -> str | None:
    parts = [int(x) for x in value.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
        return None
    # octets keep their numbers of digits, so that the text keeps its length
    sizes = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(x)] for x in value.split(".")]
    rank = 0
    for p, (low, n) in zip(parts, sizes, strict=True):
        rank = rank * n + p - low
    rank, out = permute(rank, math.prod(n for _, n in sizes), "ip" + "".join(str(low) for low, _ in sizes)), []
    for low, n in reversed(sizes):
        rank, p = divmod(rank, n)
        out.append(str(p + low))
    return ".".join(reversed(out))


def _is_ipv6(value: str) -> bool:
    """A valid address of eight groups, or a shortened one that can't be a name of a program: with a group of four with a digit."""
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return False
    return "::" not in value or any(len(g) == 4 and re.search("[0-9]", g) for g in value.split(":"))


def _ipv6(value: str, permute: Permute) -> str | None:
    if not _is_ipv6(value) or (re.search("[a-f]", value) and re.search("[A-F]", value)):
        return None
    upper = bool(re.search("[A-F]", value))
    letters = _HEX.upper() if upper else _HEX
    return _walk(lambda x: _letters(x, f"ipv6{upper}", permute, (letters,)), value, lambda x: _is_ipv6(x) and bool(re.search("[A-F]", x)) == upper)


_FIRST, _DAYS = dt.date(1900, 1, 1), (dt.date(2100, 1, 1) - dt.date(1900, 1, 1)).days
_ALL = np.datetime64("1900-01-01") + np.arange(_DAYS)
_MONTH = _ALL.astype("datetime64[M]").astype(int) % 12
_DAY = (_ALL - _ALL.astype("datetime64[M]")).astype(int) + 1
_EARLY, _LATE = np.flatnonzero(_DAY <= 12), np.flatnonzero(_DAY > 12)

#: Names of the months. A name belongs to the first list that has it.
MONTHS = [
    "january february march april may june july august september october november december".split(),
    "jan feb mar apr may jun jul aug sep oct nov dec".split(),
    "januar februar märz april mai juni juli august september oktober november dezember".split(),
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(),
]
_LIST_OF = {name: k for k, names in reversed(list(enumerate(MONTHS))) for name in names}
_MONTH_NAME = "(?i:" + "|".join(sorted(_LIST_OF, key=len, reverse=True)) + ")"


def _suffix(day: int) -> str:
    return "th" if 10 < day < 14 else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th")


@lru_cache(maxsize=1024)
def _alike(names: int, length: int, digits: int, padded: bool, suffix: str) -> np.ndarray:
    """The days whose written form has a month name of that list and length and a day of these digits, padded or with that suffix."""
    months = [len(m) == length and _LIST_OF[m] == names for m in MONTHS[names]]
    days = [0 < d and (d < 10 if padded or digits == 1 else d > 9) and suffix in ("", _suffix(d)) for d in range(32)]
    return np.flatnonzero(np.array(months)[_MONTH] & np.array(days)[_DAY])


def _among(cell: np.ndarray, day: int, permute: Permute, tweak: str) -> int:
    return int(cell[permute(int(np.searchsorted(cell, day)), len(cell), tweak)])


def _written(value: str, month: re.Match[str], permute: Permute) -> str | None:
    name = month[0].lower()
    names = _LIST_OF[name]
    found = re.search(r"([0-9]{1,2})((?:st|nd|rd|th)?)(?![0-9])", value)
    year = int(value[-4:])
    try:
        day = (dt.date(year, MONTHS[names].index(name) + 1, int(found[1])) - _FIRST).days
    except ValueError:
        return None
    if not 0 <= day < _DAYS or found[2] not in ("", _suffix(int(found[1]))):
        return None
    how = (names, len(name), len(found[1]), found[1][0] == "0", found[2])
    new = _among(_alike(*how), day, permute, f"written{how}")
    said = MONTHS[names][_MONTH[new]]
    said = said.upper() if month[0].isupper() else said if month[0].islower() else said.capitalize()
    out = value[: month.start()] + said + value[month.end() :]
    out = out[: found.start(1)] + str(_DAY[new]).zfill(len(found[1])) + out[found.end(1) :]
    return f"{out[:-4]}{1900 + int(_ALL[new].astype('datetime64[Y]').astype(int)) + 70}"


def _form(number: int, said: str) -> bool:
    """Whether a number is written with as many digits, and as much padding, as another is."""
    return 0 < number and (number < 10 if len(said) == 1 or said[0] == "0" else number > 9)


@lru_cache(maxsize=1024)
def _numbered(day: str, month: str, short: bool, late: bool) -> np.ndarray:
    """The days whose numbers have the forms of these; with years of two digits those of 1930 to 2029."""
    year = _ALL.astype("datetime64[Y]").astype(int) + 1970
    fit = np.array([_form(d, day) for d in range(32)])[_DAY] & np.array([_form(m, month) for m in range(13)])[_MONTH + 1] & ((_DAY > 12) == late)
    return np.flatnonzero(fit & ((year >= 1930) & (year < 2030) if short else True))


def _short(parts: list[str], sep: str, permute: Permute) -> str | None:
    """A date whose day or month has one digit, or its year two: permuted among the dates that are written alike."""
    year = int(parts[2]) + (0 if len(parts[2]) == 4 else 1900 if int(parts[2]) >= 30 else 2000)
    for d, m in ((0, 1), (1, 0)):
        try:
            day = (dt.date(year, int(parts[m]), int(parts[d])) - _FIRST).days
        except ValueError:
            continue
        late = int(parts[d]) > 12
        how = ("0" if parts[d][0] == "0" else "1" * len(parts[d]), "0" if parts[m][0] == "0" else "1" * len(parts[m]))
        if 0 <= day < _DAYS:
            cell = _numbered(parts[d], parts[m], len(parts[2]) == 2, late)
            new = _FIRST + dt.timedelta(_among(cell, day, permute, f"short{how}{len(parts[2])}{late}"))
            out = ["", "", f"{new.year:04d}"[-len(parts[2]) :]]
            out[d], out[m] = str(new.day).zfill(len(parts[d])), str(new.month).zfill(len(parts[m]))
            return sep.join(out)
    return None


def _date(value: str, permute: Permute) -> str | None:
    month = re.search(_MONTH_NAME, value)
    if month:
        return _written(value, month, permute)
    parts = re.split("[-/.]", value)
    a, b, c = (int(x) for x in parts)
    sep = re.search("[-/.]", value)[0]
    iso = len(parts[0]) == 4
    if not iso and (len(parts[0]), len(parts[1]), len(parts[2])) != (2, 2, 4):
        return _short(parts, sep, permute)
    for order, ymd in (("ymd", (a, b, c)),) if iso else (("dmy", (c, b, a)), ("mdy", (c, a, b))):
        try:
            day = (dt.date(*ymd) - _FIRST).days
        except ValueError:
            continue
        if 0 <= day < _DAYS:
            late = ymd[2] > 12
            new = _FIRST + dt.timedelta(_among(_LATE if late else _EARLY, day, permute, f"date{late}"))
            part = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
            return sep.join(part[x] for x in order)
    return None


def _email(value: str, permute: Permute) -> str | None:
    name, _, domain = value.rpartition("@")
    return f"{_letters(name, 'email', permute)}@{domain}"


def _login(value: str, permute: Permute) -> str:
    name, _, word = value.partition(":")
    return f"{_letters(name, 'login', permute)}:{_letters(word, 'password', permute)}"


def _mac(value: str, permute: Permute) -> str | None:
    if re.search("[a-f]", value) and re.search("[A-F]", value):
        return None
    upper = bool(re.search("[A-F]", value))
    return _walk(lambda x: _letters(x, f"mac{upper}", permute, (_HEX.upper() if upper else _HEX,)), value, lambda x: bool(re.search("[A-F]", x)) == upper)


def _passport(value: str, permute: Permute) -> str | None:
    m = re.search("[A-Z0-9]+\\Z", value)
    return value[: m.start()] + _letters(m[0], "passport", permute) if re.search("[0-9]{4}", m[0]) else None


#: Beginnings of issued tokens, and words before a secret.
_ISSUED = r"AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-(?:proj-|ant-)?|[srp]k_(?:live|test)_|xox[abprs]-|AIza|hf_|npm_"
_WORDS = r"(?ai:(?:[A-Z0-9]{1,24}[_-]){0,4}(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key)(?:[_-][A-Z0-9]{1,24}){0,2})"
_SET = r"[\"']?\s{0,3}(?:=>|[=:])\s{0,3}"
_BLOCK = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
_SECRET = re.compile(rf"(?s)({_ISSUED}|eyJ|(?i:bearer)\s{{1,3}}|{_BLOCK}|{_WORDS}{_SET}[\"']?)(.*?)(-----END [A-Z ]{{0,40}}PRIVATE KEY-----)?\Z")


def _secret(value: str, permute: Permute) -> str | None:
    m = _SECRET.match(value)
    head, body, end = m[1], m[2], m[3] or ""
    if not re.search("[0-9]", body) and not re.search(r"=|[\"']\Z|BEGIN", head):
        return None  # prose: a word after a colon
    is_hex = lambda x: len(x) >= 16 and all(c in _HEX for c in x)
    if is_hex(body):
        return head + _letters(body, "secret", permute, (_HEX,)) + end
    return head + _walk(lambda x: _letters(x, "secret", permute), body, lambda x: not is_hex(x)) + end


#: Kind, pattern and pseudonym, in the order in which a place of the text is tried.
KINDS: list[tuple[str, str, Callable[[str, Permute], str | None]]] = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])", _email),
    ("secret", rf"{_BLOCK}(?:[^-]|-(?!----)){{16,}}-----END [A-Z ]{{0,40}}PRIVATE KEY-----|\b(?:AKIA|ASIA)[0-9A-Z]{{16}}\b|(?<![A-Za-z0-9_-])(?:{_ISSUED})[A-Za-z0-9_-]{{16,}}|(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{{8,}}\.[A-Za-z0-9_-]{{8,}}\.[A-Za-z0-9_-]{{8,}}|\b(?i:bearer)\s{{1,3}}[A-Za-z0-9._~+/-]{{16,}}|\b{_WORDS}{_SET}[\"']?[A-Za-z0-9_+/-]{{8,}}(?![A-Za-z0-9_+/-])", _secret),
    ("login", r"(?<=://)[^\s:/@?#]{1,64}:[^\s:/@?#]{3,128}(?=@[A-Za-z0-9\[])", _login),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b|\b[a-z]{2}[0-9]{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?\b", _iban),
    ("ssn", r"(?<![\w-])[0-9]{3}([- ])[0-9]{2}\1[0-9]{4}(?![\w-])(?! [0-9])", _ssn),
    ("passport", r"\b(?i:passport)(?:[ -](?i:no|nr|number))?\.?:?\s{1,3}[A-Z0-9]{6,9}\b", _passport),
    ("mac", r"(?<![\w:-])[0-9A-Fa-f]{2}([:-])(?:[0-9A-Fa-f]{2}\1){4}[0-9A-Fa-f]{2}(?![\w:-])", _mac),
    ("date", rf"(?<![\w./-])(?:[0-9]{{4}}([-/.])[0-9]{{2}}\1[0-9]{{2}}|[0-9]{{1,2}}([-/.])[0-9]{{1,2}}\2[0-9]{{4}}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}})(?![\w/-])(?!\.[0-9])|(?<!\w)[0-9]{{1,2}}(?:\.|st|nd|rd|th)?(?: of| de)? {_MONTH_NAME}\.?,?(?: de)? [0-9]{{4}}(?!\w)|(?<!\w){_MONTH_NAME}\.? [0-9]{{1,2}}(?:st|nd|rd|th)?,? [0-9]{{4}}(?!\w)", _date),
    ("ipv6", r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:|::)[0-9A-Fa-f:]{1,38}(?![\w:])", _ipv6),
    ("ipv4", r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w])(?!\.[0-9])", _ipv4),
    ("card", r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", _card),
    ("phone", r"(?<![\w+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?!\w)|(?<![\w-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])|(?<![\w.,/+-])(?<![0-9] )0[1-9][0-9]{1,3}[ /-][0-9]{3,8}(?:[ -][0-9]{3,4})?(?![\w/-])(?![ .,][0-9])", _phone),
]
_EACH = [(kind, re.compile(pattern), make) for kind, pattern, make in KINDS]
#: What must follow a value of the kinds whose matches can be cut shorter.
_TAILS = {"iban": re.compile(r"\b"), "card": re.compile(r"(?![\w-])"), "phone": re.compile(r"(?!\w)")}
_MAYBE = re.compile(r"[0-9@]|(?ai:passw|pwd|passphrase|secret|token|[_-]?key)")


def _ends(kind: str, pattern: re.Pattern[str], text: str, a: int, b: int, limit: int) -> Iterator[int]:
    """Ends up to limit at which a value of the kind that starts at a can stop, the furthest first; b is the pattern's own."""
    if b <= limit:
        yield b
    if kind in _TAILS:
        for e in range(min(b - 1, limit), a, -1):
            if text[e].isalnum() or not (text[e - 1].isalnum() or text[e - 1] == ")"):  # a value neither stops inside a number nor behind a gap
                continue
            if _TAILS[kind].match(text, e) and pattern.fullmatch(text, a, e):
                yield e


def find(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of every value, validated and without overlaps; an earlier kind wins, then an earlier start.

    Where a match is no value or runs into one of an earlier kind, shorter ends are tried, then the starts behind it.
    """
    found: list[tuple[int, int, str]] = []
    if not _MAYBE.search(text):
        return found
    same: Permute = lambda x, n, t: x
    for kind, pattern, make in _EACH:
        starts, own, at = [a for a, _, _ in found], [], 0
        while m := pattern.search(text, at):
            a, b = m.span()
            k = bisect.bisect_right(starts, a)
            if k and found[k - 1][1] > a:
                at = found[k - 1][1]
                continue
            limit = starts[k] if k < len(starts) else len(text)
            end = next((e for e in _ends(kind, pattern, text, a, b, limit) if make(text[a:e], same) is not None), None)
            if end is not None:
                own.append((a, end, kind))
            at = a + 1 if end is None else end
        found = sorted(found + own)
    return found


def pseudonymise(text: str, key: bytes, back: bool = False, found: list[tuple[int, int, str]] | None = None) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms and their places. found: known places, as a pseudonym and the digits beside it can look like one value."""
    found = find(text) if found is None else found
    if not found:
        return text, found
    permute: Permute = lambda x, n, t: feistel(x, n, key, t, back)
    make = {k: f for k, _, f in KINDS}
    out, at = [], 0
    for a, b, kind in found:
        out += [text[at:a], make[kind](text[a:b], permute)]
        at = b
    return "".join([*out, text[at:]]), found


SPANS = "array<struct<start:int,end:int,kind:string>>"


def mask(docs: DataFrame, key: bytes) -> DataFrame:
    """docs with pseudonyms in text, and the column spans with their places (code points) and kinds."""

    @F.pandas_udf(f"text string, spans {SPANS}")
    def masked(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            done = [(None, []) if t is None else pseudonymise(t, key) for t in s]
            yield pd.DataFrame({"text": [t for t, _ in done], "spans": [[{"start": a, "end": b, "kind": k} for a, b, k in f] for _, f in done]})

    name = next(n for n in ("_masked", "_masked_text", "_masked_text_") if n not in docs.columns)
    out = docs.withColumn(name, masked("text"))
    kept = [F.col(f"{name}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    return out.select(*kept, F.col(f"{name}.spans").alias("spans"))

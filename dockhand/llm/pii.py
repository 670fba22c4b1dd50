"""Personal data: format-preserving pseudonyms from a keyed Feistel network.

Numbers, dates and addresses are found by shape and then validated (check digits, calendar,
ranges).  Each valid value is mapped by a keyed permutation of all values of its format, so that
equal values stay equal in all documents, different ones different, and the result is valid
again.  What fails its check is left as it is.

A format is a mixed-radix number (digits, letters) of size N.  The network works on a*b >= N with
a = b = ceil(sqrt(N)); results of N or more are sent through again, which keeps it a permutation.

Defined cases: a null text stays null; an empty one stays empty.  At one place the first kind of
KINDS that validates wins; values found don't overlap.  Of cards, IBANs and international phones
all lengths that end with a group are tried, the longest first (the length of its country before
others), so that what follows a value doesn't hide it.  Repeated rows get the same pseudonyms.
Other decimal digits of Unicode count as the ASCII digits of their value, which take their place in
a pseudonym; other letters end a value like punctuation and are never part of one, but for the
names of e-mail addresses, where they stay.  Work is linear in the text.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import ipaddress
import math
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from dockhand.llm import words as W
from dockhand.llm.store import record

ROUNDS = 8
PIECE = 256  # most symbols that are one number
DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
FOUND = T.ArrayType(record(kind="string", start="int", end="int", pseudonym="string"))

Change = Callable[[int, int, str], int]  # value, size of its format, name of its format -> permuted value


def permutation(key: bytes) -> Change:
    """A keyed permutation of 0..size-1 for each format."""

    def mask(data: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=32).digest())

    def change(value: int, size: int, tweak: str) -> int:
        if size < 2:
            return value
        side = math.isqrt(size - 1) + 1
        wide = side > 1 << 192
        while True:
            left, right = divmod(value, side)
            for r in range(ROUNDS):
                head = f"{tweak}|{size}|{r}|{right}".encode()
                got = int.from_bytes(b"".join(hashlib.blake2b(head + bytes([i]), key=key).digest() for i in range(side.bit_length() // 448 + 1))) if wide else mask(head)
                left, right = right, (left + got) % side
            value = left * side + right
            if value < size:
                return value

    return change


def permute_symbols(text: str, alphabets: list[str], change: Change, tweak: str) -> str:
    """text's symbols as a mixed-radix number, permuted.

    A text longer than PIECE goes piece by piece, once forwards and once backwards: the tweak of
    each piece names all that went before, so that the whole is still a permutation and every
    symbol of the result depends on the whole text, in linear time."""
    if len(text) > PIECE:
        places = range(0, len(text), PIECE)
        pieces = [text[i : i + PIECE] for i in places]
        for turn, order in enumerate((range(len(pieces)), reversed(range(len(pieces))))):
            seen = hashlib.blake2b(f"{tweak}|{len(text)}".encode())
            for k in order:
                pieces[k] = permute_symbols(pieces[k], alphabets[places[k] : places[k] + PIECE], change, f"{tweak}|{turn}|{k}|{seen.hexdigest()}")
                seen.update(pieces[k].encode())
        return "".join(pieces)
    value, size = 0, 1
    for c, alphabet in zip(text, alphabets, strict=True):
        value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
    value, out = change(value, size, tweak), []
    for alphabet in reversed(alphabets):
        value, i = divmod(value, len(alphabet))
        out.append(alphabet[i])
    return "".join(reversed(out))


def alike(text: str, change: Change, tweak: str) -> str:
    """Digits, small and capital letters permuted together; other characters keep their place."""
    kept = [(i, DIGITS if c.isdigit() else LOWER if c.islower() else UPPER) for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    shape = "".join("0" if c in DIGITS else "a" if c in LOWER else "A" if c in UPPER else c for c in text)
    if len(shape) > PIECE:
        shape = hashlib.blake2b(shape.encode()).hexdigest()
    new = permute_symbols("".join(text[i] for i, _ in kept), [a for _, a in kept], change, f"{tweak}|{shape}")
    out = list(text)
    for (i, _), c in zip(kept, new, strict=True):
        out[i] = c
    return "".join(out)


def luhn(digits: str) -> int:
    """Check digit that makes digits + it valid."""
    total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _spread(shape: str, digits: str) -> str:
    """digits in the places of shape's digits."""
    left = iter(digits)
    return "".join(next(left) if c in DIGITS else c for c in shape)


def card(m: re.Match, change: Change) -> str | None:
    """Payment card: the first digit stays, the check digit is made anew."""
    d = "".join(c for c in m[0] if c in DIGITS)
    if d[0] not in "3456" or int(d[-1]) != luhn(d[:-1]):
        return None
    body = d[0] + permute_symbols(d[1:-1], [DIGITS] * (len(d) - 2), change, f"card{d[0]}")
    return _spread(m[0], body + str(luhn(body)))


def iban(m: re.Match, change: Change) -> str | None:
    """The country stays, check digits are made anew."""
    s = m[0].replace(" ", "")
    number = lambda x: int("".join(str(int(c, 36)) for c in x))
    if not 15 <= len(s) <= 34 or number(s[4:] + s[:4]) % 97 != 1:
        return None
    body = alike(s[4:], change, f"iban{s[:2]}")
    new = iter(f"{s[:2]}{98 - number(body + s[:2] + '00') % 97:02d}{body}")
    return "".join(c if c == " " else next(new) for c in m[0])


def address(m: re.Match, change: Change) -> str | None:
    """IPv4: any address to any other."""
    parts = [int(x) for x in m[0].split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m[0].split(".")):
        return None
    return ".".join(str(x) for x in change(int.from_bytes(bytes(parts)), 1 << 32, "ipv4").to_bytes(4))


def social(m: re.Match, change: Change) -> str | None:
    """US social security number among all that can be given out."""
    areas = [a for a in range(1, 900) if a != 666]
    area, group, serial = int(m[1]), int(m[2]), int(m[3])
    if area == 0 or area == 666 or area > 899 or not group or not serial:
        return None
    value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    rest, serial = divmod(change(value, len(areas) * 99 * 9999, "ssn"), 9999)
    area, group = divmod(rest, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def date(m: re.Match, change: Change) -> str | None:
    """Calendar dates of 1900-2099 among themselves; other years are left."""
    low, high = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal()
    g = m.groupdict()
    year, sep = (g["iso"], "-") if g["iso"] else (g["end"], g["sep"])
    first, second = (int(g["im"]), int(g["id"])) if g["iso"] else (int(g["a"]), int(g["b"]))
    month, day = (second, first) if sep == "." else (first, second)
    try:
        at = datetime.date(int(year), month, day).toordinal()
    except ValueError:
        return None
    if not low <= at < high:
        return None
    new = datetime.date.fromordinal(low + change(at - low, high - low, "date"))
    if g["iso"]:
        return f"{new.year}-{new.month:02d}-{new.day:02d}"
    pair = (new.day, new.month) if sep == "." else (new.month, new.day)
    return f"{pair[0]:02d}{sep}{pair[1]:02d}{sep}{new.year}"


def phone(m: re.Match, change: Change) -> str | None:
    """7 to 15 digits; the country code stays."""
    n = sum(c in DIGITS for c in m[0])
    if not 7 <= n <= 15:
        return None
    head = m["code"] or ""
    rest = m[0][len(head) :]
    return head + alike(rest, change, f"phone{head}")


# Characters of an IBAN by country.
_IBAN_LENGTH = {
    code: int(n)
    for n, codes in (line.split(":") for line in (
        "15:NO", "16:BE", "18:DK FI FO GL NL SD FK", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH HR LI LV", "22:BG BH CR DE GB GE IE ME RS VA",
        "23:AE GI IL IQ OM SO TL", "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM",
        "28:AL AZ BY CY DO GT HN HU LB NI PL SV", "29:BR EG PS QA UA", "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU",
    ))
    for code in codes.split()
}
# Digits of a phone number with its country code, where all numbers of a country have one length.
_PHONE_DIGITS = {
    "1": 11, "7": 11, "27": 11, "30": 12, "33": 11, "34": 11, "40": 11, "41": 11, "44": 12, "45": 10, "47": 10, "48": 11, "57": 12,
    "61": 11, "65": 10, "90": 12, "91": 12, "351": 12, "380": 12, "420": 12, "421": 12, "852": 11,
}


def _no_word(text: str, at: int) -> bool:
    """Nothing that continues a value, but perhaps a further group of digits."""
    after = text[at : at + 2]
    return not after or not (after[0].isalnum() or after[0] == "_") and (after[0] != "-" or after[1:].isdigit())


def _no_letter(text: str, at: int) -> bool:
    return not (text[at : at + 1].isascii() and text[at : at + 1].isalnum())


def _size(value: str) -> int:
    return sum(c.isalnum() for c in value)


def _iban_size(value: str) -> int | None:
    return _IBAN_LENGTH.get(value[:2])


def _phone_size(value: str) -> int | None:
    digits = "".join(c for c in value[:8] if c in DIGITS)
    return next((_PHONE_DIGITS[digits[:n]] for n in (1, 2, 3) if digits[:n] in _PHONE_DIGITS), None)


_RUN = re.compile(r"[A-Z0-9+(). -]{1,80}")  # reaches over the longest IBAN


def _candidates(pattern: re.Pattern, open_end: tuple[Callable, Callable] | None, text: str, start: int) -> Iterator[re.Match]:
    """What the pattern matches at start; with an open end, at all lengths that end with a group:
    first the size that is told by how the value begins, then the longest."""
    m = pattern.match(text, start)
    if m is None or open_end is None:
        if m is not None:
            yield m
        return
    ends, expected = open_end
    found = [hit for end in range(_RUN.match(text, start).end(), start, -1) if text[end - 1].isalnum() and ends(text, end) and (hit := pattern.fullmatch(text, start, end))]
    size = expected(m[0])
    yield from sorted(found, key=lambda hit: _size(hit[0]) != size)  # stable: else the longest first


# At one place the first kind that validates wins.  With an open end: what may follow, and the
# number of digits and letters that the value's beginning tells.
KINDS: tuple[tuple[str, re.Pattern, tuple[Callable, Callable] | None, Callable], ...] = (
    ("iban", re.compile(r"[A-Z]{2}[0-9][0-9](?: ?[A-Z0-9]){11,30}"), (_no_letter, _iban_size), iban),
    ("date", re.compile(r"(?:(?P<iso>[0-9]{4})-(?P<im>[0-9][0-9])-(?P<id>[0-9][0-9])|(?P<a>[0-9][0-9])(?P<sep>[./])(?P<b>[0-9][0-9])(?P=sep)(?P<end>[0-9]{4}))(?:(?![\w-])|(?<=-[0-9][0-9])(?=[Tt](?:[01][0-9]|2[0-4])(?::?[0-5][0-9]|(?!\w))))"), None, date),
    ("ipv4", re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w-])(?!\.[0-9])"), None, address),
    ("ssn", re.compile(r"([0-9]{3})-([0-9][0-9])-([0-9]{4})(?![\w-])"), None, social),
    ("card", re.compile(r"[0-9](?:[ -]?[0-9]){12,18}"), (_no_word, lambda value: None), card),
    ("phone", re.compile(r"(?P<code>\+[0-9]{1,3})[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}"), (_no_word, _phone_size), phone),
    ("phone", re.compile(r"(?P<code>)(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![\w-])"), None, phone),
)

_ANY = re.compile(r"[0-9@=:]")
_START = re.compile(r"(?<![\w@.+-])(?:\+[0-9]|\([0-9]|[0-9]|[A-Z]{2}[0-9][0-9])")
_EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_KEY = re.compile(r"(?<![A-Za-z0-9])AKIA([A-Z0-9]{16})(?![A-Za-z0-9])")
# Public prefixes of access tokens.
_PREFIXES = ("ghp_", "gho_", "ghs_", "ghu_", "ghr_", "github_pat_", "glpat-", "xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-", "sk_live_", "sk_test_", "sk-", "AIza")
_TOKEN = re.compile(f"(?<![A-Za-z0-9])(?:{'|'.join(map(re.escape, _PREFIXES))})([A-Za-z0-9_-]{{16,}})")
_SECRET = re.compile(r"""(?i:password|passwd|pwd|secret|token|api[_-]?key)(?P<sign>\s{0,3}[=:]\s{0,3})["']?(?P<value>[^\s"'`,;<>(){}\[\]]{8,})""")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:.])")


def _digit_table() -> dict[int, int]:
    """Every other decimal digit of Unicode to the ASCII one of its value."""
    digits = ((c, unicodedata.decimal(chr(c), None)) for c in range(128, sys.maxunicode + 1))
    return {c: ord("0") + d for c, d in digits if d is not None}


_DIGIT_TABLE = _digit_table()
_FAR = re.compile(f"[{chr(min(_DIGIT_TABLE))}-{chr(sys.maxunicode)}]")  # one comparison per character
_OTHER_DIGIT = re.compile(r"(?![0-9])\d")


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    """Values after a word for secrets.  After a plain "=" any value counts, elsewhere prose may
    follow and the value must hold a digit."""
    for m in _SECRET.finditer(text):
        value = m["value"].rstrip("!?:")
        if len(value) >= 8 and (m["sign"] == "=" or any(c in DIGITS for c in value)):
            yield m.start("value"), m.start("value") + len(value)


def wide_address(text: str, change: Change) -> str | None:
    """IPv6: any address to any other.  Fewer than three written groups, as in `a::b`, are as
    likely to be something else and stay."""
    if sum(map(bool, text.split(":"))) < 3:
        return None
    try:
        at = ipaddress.IPv6Address(text)
    except ValueError:
        return None
    return str(ipaddress.IPv6Address(change(int(at), 1 << 128, "ipv6")))


def _hidden(value: str, change: Change, kind: str) -> str:
    """Hexadecimal stays hexadecimal, other secrets keep the kind of each character."""
    if all(c in HEX for c in value):
        return permute_symbols(value, [HEX] * len(value), change, f"{kind}|hex{len(value)}")
    return alike(value, change, kind)


class _Spans:
    """Places in a text, united where they overlap."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        i = bisect.bisect_left(self.starts, b) - 1  # the last span that begins before b
        return i >= 0 and self.ends[i] > a


def find(text: str, change: Change) -> list[tuple[str, int, int, str]]:
    """kind, start, end and pseudonym of all that is found, in order."""
    other = not text.isascii() and _FAR.search(text) and _OTHER_DIGIT.search(text)
    tokens = any(p in text for p in _PREFIXES)
    if not other and not tokens and not _ANY.search(text):
        return []
    if other:
        text = text.translate(_DIGIT_TABLE)  # one character each, so places stay
    found: list[tuple[str, int, int, str]] = []
    if "@" in text:
        found += [("email", m.start(), m.start() + m[0].index("@"), alike(m[0][: m[0].index("@")], change, "email")) for m in _EMAIL.finditer(text)]
    if "AKIA" in text:
        found += [("access_key", *m.span(1), alike(m[1], change, "akia")) for m in _KEY.finditer(text)]
    if tokens:
        found += [("access_token", *m.span(1), alike(m[1], change, "token")) for m in _TOKEN.finditer(text)]
    if "=" in text or ":" in text:
        found += [("secret", a, b, _hidden(text[a:b], change, "secret")) for a, b in _secrets(text)]
    if text.count(":") > 1:
        found += [("ipv6", *m.span(), new) for m in _IPV6.finditer(text) if (new := wide_address(m[0], change)) is not None]
    taken = _Spans((a, b) for _, a, b, _ in found)
    at = 0
    while m := _START.search(text, at):
        at = m.start() + 1
        tried = ((kind, hit, replace) for kind, pattern, open_end, replace in KINDS for hit in _candidates(pattern, open_end, text, m.start()))
        for kind, hit, replace in tried:
            if (new := replace(hit, change)) is not None:
                if not taken.meets(*hit.span()):
                    found.append((kind, *hit.span(), new))
                at = hit.end()
                break
    out: list[tuple[str, int, int, str]] = []
    for x in sorted(found, key=lambda x: (x[1], -x[2])):
        if not out or x[1] >= out[-1][2]:
            out.append(x)
    return out


def apply(text: str, found: list[tuple[str, int, int, str]]) -> str:
    parts, at = [], 0
    for _, start, end, new in found:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]])


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", found: str | None = None) -> DataFrame:
    """docs with its text column replaced; with `found`, a column of that name tells kind, place
    in the old text and pseudonym of each value (an existing one is replaced)."""
    names = [c for c in docs.columns if c != found]
    fields = [T.StructField(f.name, T.StringType()) if f.name == text else f for f in docs.schema.fields if f.name != found]
    schema = T.StructType(fields + ([T.StructField(found, FOUND)] if found else []))
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = permutation(key)
        for batch in W.sliced(batches, place):
            new, hits = [], []
            for value in batch.column(place):
                value = value.as_py()
                got = find(value, change) if value else []
                new.append(apply(value, got) if got else value)
                hits.append([{"kind": k, "start": a, "end": b, "pseudonym": p} for k, a, b, p in got])
            columns = [batch.column(i) if i != place else pa.array(new, pa.string()) for i in range(len(names))]
            if found:
                columns.append(pa.array(hits, to_arrow_type(FOUND)))
            yield pa.RecordBatch.from_arrays(columns, [*names, *([found] if found else [])])

    return docs.select(*[F.col(c).cast("string").alias(c) if c == text else F.col(c) for c in names]).mapInArrow(run, schema)

"""Text encodings: choose one per file from its bytes, then decode with it.

Lines are kept as raw bytes until the encoding of the whole file is known.  Single-byte
encodings are decoded as ISO-8859-1 followed by ``translate`` with the code points that
differ; that table is derived from the codec, so any single-byte codec works.
"""

from __future__ import annotations

import codecs
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

def _char(data: bytes, encoding: str) -> str | None:
    try:
        return data.decode(encoding)
    except (UnicodeDecodeError, LookupError):
        return None


@lru_cache
def _single_byte_table(encoding: str) -> tuple[str, str, str] | None:
    """(Latin-1 characters to replace, their replacements, undefined characters).

    None unless every character of the encoding is one byte and ASCII stays ASCII, which
    delimiters, quotes and line breaks rely on.
    """
    chars = [_char(bytes([b]), encoding) for b in range(256)]
    undefined = [b for b, c in enumerate(chars) if c is None]
    if any(c is not None and len(c) != 1 for c in chars) or any(chars[b] != chr(b) for b in range(128)):
        return None
    if any(_char(bytes([lead, b]), encoding) is not None for lead in undefined for b in range(32, 256)):
        return None
    changed = [(chr(b), c) for b, c in enumerate(chars) if c is not None and c != chr(b)]
    return (
        "".join(old for old, _ in changed),
        "".join(new for _, new in changed),
        "".join(map(chr, undefined)),
    )


@lru_cache
def canonical(encoding: str) -> str:
    """Python's name for an encoding, so that spellings of one codec compare equal."""
    try:
        return codecs.lookup(encoding).name
    except LookupError:
        return encoding.lower()


def is_utf8(encoding: str) -> bool:
    return canonical(encoding) in ("utf-8", "utf-8-sig")


def is_supported_encoding(encoding: str) -> bool:
    try:
        codecs.lookup(encoding)
    except LookupError:
        return False
    return is_utf8(encoding) or _single_byte_table(canonical(encoding)) is not None


def undecodable(raw: Column, encoding: str) -> Column:
    """True for a raw line (BINARY) that ``encoding`` cannot decode."""
    if is_utf8(encoding):
        return ~F.is_valid_utf8(raw.cast("string"))
    _, _, undefined = _single_byte_table(canonical(encoding))
    if not undefined:
        return F.lit(False)
    pattern = "[" + "".join(f"\\x{ord(c):02x}" for c in undefined) + "]"
    return F.decode(raw, "ISO-8859-1").rlike(pattern)


def decode_as(raw: Column, encoding: str) -> Column:
    """Decode a raw line (BINARY) with a fixed encoding."""
    if is_utf8(encoding):
        return raw.cast("string")
    source, target, _ = _single_byte_table(canonical(encoding))
    text = F.decode(raw, "ISO-8859-1")
    return F.translate(text, source, target) if source else text


def decode_by(raw: Column, encoding: Column, candidates: list[str]) -> Column:
    """Decode a raw line with the encoding named in a column, out of a fixed list.

    ASCII lines, the usual case, take the first branch: every listed codec agrees on them.
    """
    others = [c for c in dict.fromkeys(candidates) if not is_utf8(c)]
    text = raw.cast("string")
    if not others:
        return text
    branch = F.when(encoding.isin("utf-8", "utf-8-sig"), text)
    for name in others:
        branch = branch.when(encoding == name, decode_as(raw, name))
    return branch


def detected_encoding(all_utf8: Column, all_cp1252: Column) -> Column:
    """First encoding of the chain that reads every line of a file.

    A BOM is dropped by Spark's text reader, so utf-8-sig never differs from utf-8; latin-1
    is iso-8859-1, which reads every byte.
    """
    return (
        F.when(all_utf8, F.lit("utf-8"))
        .when(all_cp1252, F.lit("cp1252"))
        .otherwise(F.lit("iso-8859-1"))
    )


def effective_encoding(declared: str, all_utf8: Column, all_cp1252: Column) -> Column:
    """Encoding used for a source: a declared one is binding unless it is utf-8."""
    if declared.lower() == "utf-8":
        return detected_encoding(all_utf8, all_cp1252)
    return F.lit("utf-8" if is_utf8(declared) else canonical(declared))

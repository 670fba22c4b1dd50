"""License scans: exact base phrases and a fuzzy search for short notices.

A notice of which k edits may be wrong is cut into k + 1 pieces; by the pigeonhole principle one
piece stands unchanged in every match.  One automaton finds all pieces of all notices; around the
hits the bounded-error matcher of the `regex` library verifies edits and gives the spans.

Words are runs of letters, digits and non-ASCII characters after A-Z went to lower case; notices
are matched against the words joined by one space.  Edits count bytes of UTF-8.  What names the
licence must stand exactly (its name, a version number at the end); edits are for the words around.
Words that follow and make it another licence are part of the label.  Work is linear in the text.

Defined cases: a null or empty text has no words, no matches and score 0.  Repeated rows are
scanned each.  Overlapping places of a base phrase all count; matches of one notice don't overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dockhand.llm import words as W
from dockhand.llm.store import record

# Phrases and the labels they stand for.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


@dataclass(frozen=True)
class Notice:
    """fuzzy is matched with up to `edits` errors, tail must follow it as it is.  The matcher's time
    grows steeply with the errors it allows, so a long text is told by one of its sentences.

    The words of `name`, which tell this licence from others, must stand in the match unchanged.
    `variants` are words after the match that make it another licence: their ending of the label."""

    label: str
    fuzzy: str
    tail: str = ""
    name: str = ""
    variants: tuple[tuple[str, str], ...] = ()

    @property
    def edits(self) -> int:
        return len(self.fuzzy) // 10


# How the notices of common licences read, in words.
_CC = (("sharealike", "-sa"), ("share alike", "-sa"), ("noderiv", "-nd"), ("no deriv", "-nd"))
NOTICES = (
    Notice("mit", " under the mit license ", name="mit"),
    Notice("mit", " permission is hereby granted free of charge to any person obtaining a copy of this software "),
    Notice("apache-2", " apache license version ", "2 ", name="apache"),
    Notice("cc-by-nc", " creative commons attribution noncommercial ", name="attribution noncommercial", variants=_CC),
    Notice("cc-by-sa", " creative commons attribution sharealike ", name="attribution sharealike"),
    Notice("gpl-3", " gnu general public license version ", "3 ", name="gnu general"),
    Notice("gpl-2", " gnu general public license version ", "2 ", name="gnu general"),
    Notice("lgpl-3", " gnu lesser general public license version ", "3 ", name="lesser"),
    Notice("lgpl-2.1", " gnu lesser general public license version ", "2 1 ", name="lesser"),
    Notice("agpl-3", " gnu affero general public license version ", "3 ", name="affero"),
    Notice("mpl-2", " mozilla public license version ", "2 ", name="mozilla"),
    Notice("isc", " copy modify and or distribute this software for any purpose "),
    Notice("unlicense", " this is free and unencumbered software released into the public domain "),
    Notice("bsd", " redistribution and use in source and binary forms with or without modification "),
)

# Letters, digits and bytes beyond ASCII; A-Z to lower case, all else to spaces.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

MATCH = record(label="string", notice="int", start_word="long", end_word="long", edits="int", matched="string")


def normal(text: bytes) -> tuple[bytes, int]:
    """Words joined and surrounded by one space, and their number."""
    words = text.translate(_NORMAL).split()
    return (b" " + b" ".join(words) + b" " if words else b""), len(words)


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """edits + 1 pieces of nearly equal length, with their offsets."""
    n, parts = len(notice.fuzzy), notice.edits + 1
    ends = [n * i // parts for i in range(parts + 1)]
    return [(a, notice.fuzzy[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans made one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


class Scanner:
    def __init__(self, notices: tuple[Notice, ...] = NOTICES, base: dict[str, str] = BASE):
        self.notices = notices
        self.base = [(b" " + k.encode() + b" ", v) for k, v in base.items()]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for at, piece in pieces(notice):
                seeds.setdefault(piece, []).append((i, at + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, tuple(uses))
        self.automaton.make_automaton()
        self.patterns = [
            regex.compile(f"(?e)(?:{regex.escape(n.fuzzy)}){{e<={n.edits}}}{regex.escape(n.tail)}".encode()) for n in notices
        ]

    def places(self, joined: bytes) -> list[tuple[int, str]]:
        """First word and label of every base place."""
        found = []
        for phrase, label in self.base:
            word, before, at = 0, 0, joined.find(phrase)
            while at >= 0:
                word, before = word + joined.count(b" ", before, at), at
                found.append((word, label))
                at = joined.find(phrase, at + 1)
        return found

    def matches(self, joined: bytes) -> list[tuple]:
        """Rows of MATCH."""
        near: dict[int, list[tuple[int, int]]] = {}
        for last, uses in self.automaton.iter(joined.decode("latin-1")):
            for i, end in uses:
                notice, start = self.notices[i], last + 1 - end
                reach = start + len(notice.fuzzy) + notice.edits + len(notice.tail)
                near.setdefault(i, []).append((max(0, start - notice.edits), reach))
        rows = []
        for i in sorted(near):
            notice, name = self.notices[i], f" {self.notices[i].name} ".encode()
            word, before = -1, 0  # spaces up to a place, less one, is the number of the word there
            for low, high in merged(near[i]):
                for m in self.patterns[i].finditer(joined, low, high):
                    inner = m.group().strip()
                    if notice.name and name not in b" " + inner + b" ":
                        continue
                    start = joined.find(inner, m.start())
                    word, before = word + joined.count(b" ", before, start), start
                    after = joined[m.end() : m.end() + 20].lstrip()
                    ending = next((e for text, e in notice.variants if after.startswith(text.encode())), "")
                    rows.append((
                        notice.label + ending, i, word, word + inner.count(b" "), sum(m.fuzzy_counts),
                        inner.decode("utf-8", "replace"),
                    ))
        return rows


_SCHEMA = record(
    doc_id="long", n_words="long", places=T.ArrayType(record(word="long", label="string")),
    matches=T.ArrayType(MATCH), score="double",
)


def scan(docs: DataFrame, text: str = "text", notices: tuple[Notice, ...] = NOTICES, base: dict[str, str] = BASE) -> DataFrame:
    """doc_id, n_words, places (base phrases: word, label), matches (fuzzy: label, notice, words
    from and to, edits, the text matched) and score: 1 less the share of wrong bytes in the best
    match, 1 with a base place, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, schema = Scanner(notices, base), to_arrow_schema(_SCHEMA)
        for batch in W.sliced(batches, 1):
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                joined, n = normal(value.as_buffer().to_pybytes() if value.is_valid else b"")
                places, found = scanner.places(joined), scanner.matches(joined)
                best = max((1 - m[4] / len(notices[m[1]].fuzzy) for m in found), default=0.0)
                names = [f.name for f in MATCH.fields]
                rows.append({
                    "doc_id": doc_id, "n_words": n, "places": [{"word": w, "label": k} for w, k in sorted(places)],
                    "matches": [dict(zip(names, m, strict=True)) for m in found], "score": 1.0 if places else best,
                })
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).cast("binary").alias("text")).mapInArrow(run, _SCHEMA)

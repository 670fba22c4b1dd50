"""Benchmark decontamination by spaced-seed hashing.

A mask is a row of token positions of which some are ignored.  Hashes of the kept positions at
every place of the benchmark items are joined with those of all documents, so that a passage with
single words replaced is still hit.  Around each hit item and document are aligned word by word;
a document is contaminated if some `overlap` consecutive aligned words differ in at most
`substitutions` places.  MASKS are chosen so that no such overlap escapes: whichever two of 13
words differ, one mask fits between them (tests prove it by trying all).

Benchmark items are a query set: they go in blocks of bounded size against all documents, each
block broadcast behind that bound; documents are never shuffled.  Tokens are runs of letters,
digits and non-ASCII characters, A-Z in lower case.

Defined cases: items shorter than `overlap` must occur whole, with substitutions in proportion to
their length: one word from 7 words on, found by their unchanged half.  Items of fewer than SHORTEST
words are found only where a text holds nothing else, as they are part of ordinary prose.  Null and
empty texts are clean; items without text are left out, those without id keep a null one, repeated
items count once.  Repeated documents are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from dockhand.llm import words as W
from dockhand.llm.store import record

OVERLAP, SUBSTITUTIONS = 13, 2
SHORTEST = 3  # tokens an item must have to be found inside a text
#: 1: the token counts, 0: it is ignored.
MASKS = ("11010011", "1110111", "11111")
BLOCK_BYTES = 8 << 20  # of benchmark text in one broadcast
MATCHES = T.ArrayType(record(item_id="long", start="long", length="long", differing="long"))

_PARTS = np.array([not (b > 127 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122) for b in range(256)])
_FILTER_BITS = 22


def tokens(column: pa.Array) -> W.Words:
    data, offsets = W.utf8(column)
    return W.cut(W.LOWER[data], offsets, _PARTS)


def _seeds(hashes: np.ndarray, mask: str, number: int) -> np.ndarray:
    """Hash of the kept tokens at each place where the mask fits."""
    n = max(0, len(hashes) - len(mask) + 1)
    out = np.full(n, number + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k, kept in enumerate(mask):
            if kept == "1":
                out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        return W.mix(out)


@dataclass
class Index:
    """Tokens of the items of one block and the sorted seeds of their places."""

    ids: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    overlap: int
    masks: tuple[str, ...]
    seeds: list[np.ndarray]
    places: list[np.ndarray]
    seen: np.ndarray
    short: list[tuple[int, int, int, np.ndarray, np.ndarray]]  # items of one length: that, where a seed begins, its width, sorted seeds, items


def allowed(n: int, overlap: int, substitutions: int) -> int:
    """Words of an item of n words that may differ."""
    return min(substitutions, n * substitutions // overlap)


def index(
    ids: list[int | None], texts: list[str | None], masks: tuple[str, ...] = MASKS, overlap: int = OVERLAP, substitutions: int = SUBSTITUTIONS,
) -> Index:
    found = tokens(pa.array(texts, pa.string()))
    hashes, bounds, counts = found.hashes(), found.bounds, found.counts
    seen, seeds, places = np.zeros(1 << _FILTER_BITS, bool), [], []
    owner = found.owners()
    for k, mask in enumerate(masks):
        s = _seeds(hashes, mask, k)
        ok = W.whole(found, len(mask)) & (counts[owner[: len(s)]] >= overlap)
        s, at = s[ok], np.flatnonzero(ok)
        order = np.argsort(s, kind="stable")
        seeds.append(s[order])
        places.append(at[order])
        seen[(s >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    short = []
    for n in sorted(set(counts[(counts > 0) & (counts < overlap)].tolist())):
        at = np.flatnonzero(counts == n)
        parts = allowed(n, overlap, substitutions) + 1  # one of as many parts is unchanged
        ends = [n * i // parts for i in range(parts + 1)]
        for begin, end in zip(ends, ends[1:], strict=False):
            value = W.windows(hashes, end - begin)[bounds[at] + begin]
            order = np.argsort(value, kind="stable")
            short.append((n, begin, end - begin, value[order], at[order]))
    return Index(np.asarray(ids, object), hashes, bounds, overlap, masks, seeds, places, seen, short)


def _joined(index: Index, hashes: np.ndarray, found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Places in the documents and in the items with a seed in common."""
    left, right = [], []
    for k, mask in enumerate(index.masks):
        s = _seeds(hashes, mask, k)
        at = np.flatnonzero(index.seen[(s >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        low, high = np.searchsorted(index.seeds[k], s[at], "left"), np.searchsorted(index.seeds[k], s[at], "right")
        at, low, n = at[high > low], low[high > low], (high - low)[high > low]
        left.append(np.repeat(at, n))
        right.append(index.places[k][W.ranges(low, n)])
    return np.concatenate(left), np.concatenate(right)


def overlaps(index: Index, found: W.Words, substitutions: int = SUBSTITUTIONS) -> list[tuple[int, int, int, int, int]]:
    """(document, item, first word, words, differing words) of every verified stretch: runs of
    aligned windows of `overlap` words with at most `substitutions` differences, made one."""
    hashes, owner, width = found.hashes(), found.owners(), index.overlap
    place, at = _joined(index, hashes, found)
    if len(place):
        item = np.searchsorted(index.bounds, at, "right") - 1
        start = place - (at - index.bounds[item])  # where the item's first word would lie
        pairs = np.unique(np.stack([owner[place], item, start], 1), axis=0)
    else:
        pairs = np.zeros((0, 3), np.int64)
    rows = []
    for d, i, s in pairs.tolist():
        low, high = max(s, int(found.bounds[d])), min(s + int(index.bounds[i + 1] - index.bounds[i]), int(found.bounds[d + 1]))
        if high - low < width:
            continue
        from_item = int(index.bounds[i]) + low - s
        wrong = hashes[low:high] != index.hashes[from_item : from_item + high - low]
        sums = np.concatenate([[0], np.cumsum(wrong)])
        good = np.flatnonzero(sums[width:] - sums[:-width] <= substitutions)
        if len(good):
            breaks = np.flatnonzero(np.diff(good) > 1)
            for a, b in zip(good[np.concatenate([[0], breaks + 1])], good[np.concatenate([breaks, [len(good) - 1]])], strict=True):
                rows.append((d, i, low + int(a) - int(found.bounds[d]), int(b - a) + width, int(sums[b + width] - sums[a])))
    return rows + _short_overlaps(index, found, hashes, owner, substitutions)


def _short_overlaps(index: Index, found: W.Words, hashes: np.ndarray, owner: np.ndarray, substitutions: int) -> list[tuple[int, int, int, int, int]]:
    """The same for items shorter than the overlap."""
    rows, counts = set(), found.counts
    for n, begin, width, values, items in index.short:
        w = W.windows(hashes, width)
        low, high = np.searchsorted(values, w, "left"), np.searchsorted(values, w, "right")
        hit = np.flatnonzero(high > low)
        for p, a, b in zip(hit.tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
            d = int(owner[p])
            start = p - begin
            if start < found.bounds[d] or start + n > found.bounds[d + 1] or (n < SHORTEST and counts[d] != n):
                continue
            for j in items[a:b].tolist():
                own = index.bounds[j]
                wrong = int((hashes[start : start + n] != index.hashes[own : own + n]).sum())
                if wrong <= allowed(n, index.overlap, substitutions):
                    rows.add((d, j, start - int(found.bounds[d]), n, wrong))
    return sorted(rows)


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[tuple[list[int], list[str]]]:
    """Items in blocks of at most block_bytes of text (one item at least)."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).cast("string").alias("t")).dropna(subset=["t"]).distinct()
    ids, texts, held = [], [], 0
    for row in items.orderBy("i", "t").toLocalIterator():
        if ids and held + len(row.t) > block_bytes:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(row.i)
        texts.append(row.t)
        held += len(row.t)
    yield ids, texts


def matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    overlap: int = OVERLAP, substitutions: int = SUBSTITUTIONS, masks: tuple[str, ...] = MASKS,
    block_bytes: int = BLOCK_BYTES, found: str = "contamination", only_clean: bool = False,
) -> DataFrame:
    """docs with a column of all verified overlaps (item, first word, words, differing); with
    only_clean, instead the rows of docs without any.  Blocks of items go one after the other."""
    if not only_clean:
        docs = docs.withColumn(found, F.array().cast(MATCHES))
    for ids, texts in _blocks(benchmark, item_id, item_text, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index(ids, texts, masks, overlap, substitutions))
        docs = _against(docs, sent, text, substitutions, None if only_clean else found)
    return docs


def _against(docs: DataFrame, sent, text: str, substitutions: int, found: str | None) -> DataFrame:
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.sliced(batches, len(names)):
            rows = overlaps(sent.value, tokens(batch.column(len(names))), substitutions)
            columns = [batch.column(i) for i in range(len(names))]
            if found is None:
                clean = np.ones(batch.num_rows, bool)
                clean[[r[0] for r in rows]] = False
                yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(clean))
                continue
            place = names.index(found)
            lists = columns[place].to_pylist()
            for d, i, start, n, wrong in rows:
                lists[d].append({"item_id": sent.value.ids[i], "start": start, "length": n, "differing": wrong})
            key = lambda x: (x["item_id"] is None, x["item_id"] or 0, x["start"], x["length"], x["differing"])
            columns[place] = pa.array([sorted(x, key=key) for x in lists], to_arrow_type(MATCHES))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*names, F.col(text).cast("string").alias(text + " ")).mapInArrow(run, docs.schema)

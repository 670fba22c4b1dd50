"""Substring deduplication against an index of all windows.

The reference is the corpus itself, indexed in blocks: each holds a range of the hashes of all
windows of `width` words with the smallest document that has the window.  Every document is
compared with all blocks; its duplicate spans are the words under windows that an earlier document
has.  `factors` are runs of neighbouring windows with the same smallest earlier document.

This stands in for a relative Lempel-Ziv parse.  Greedy longest factors need the place of each
window in its reference document, several documents per window, and the text around both; what the
windows alone send is close to the bound on disk already (README).  So a factor names the document
that holds each of its windows, not one stretch of that document: they may lie apart in it, and a
longer copy from a later document can be told as several factors from earlier ones.  Which words
are duplicates does not depend on that and is exact.

Windows are compared by 64-bit hashes: among n different ones about n*n/2**65 pairs agree by
chance (0.0005 for 140 million).

Defined cases: a null or empty text has no words.  A document without id comes after all others
and is no reference.  Rows with the same id are never duplicates of each other.  Texts of fewer
than `width` words keep all.  Only doc_id and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dockhand.llm import blocks as B
from dockhand.llm import words as W
from dockhand.llm.store import record

WIDTH = 13
FACTOR = record(start="long", length="long", reference="long")
RESULT = record(doc_id="long", n_words="long", n_removed="long", kept_sha256="string", factors=T.ArrayType(FACTOR))


class _Windows:
    """Windows of one batch: their distinct hashes, and of each the smallest document."""

    def __init__(self, table: pa.Table, width: int):
        data, offsets = W.utf8(table.column("text"))
        self.words = W.cut(data, offsets)
        self.ids = B.ids(table)
        self.at = np.flatnonzero(W.whole(self.words, width))
        hashes = W.windows(self.words.hashes(), width)[self.at]
        self.doc = self.ids[self.words.owners()[self.at]]
        order, head, self.group = B.grouped([hashes])
        self.keys, self.lowest = hashes[order[head]], self.doc[order[head]]  # documents ascend in a batch


def _index(width: int, n_blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                w = _Windows(B.unseal(payload), width)

                def documents(part: slice, w=w) -> bytes:
                    used, place = np.unique(w.lowest[part], return_inverse=True)
                    kind = np.uint16 if len(used) <= 1 << 16 else np.uint32
                    return len(used).to_bytes(4) + B.planes(used) + B.planes(place.astype(kind))

                yield from B.send(number, w.keys, n_blocks, documents)

    return run


def _documents(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4])
    used = B.unplanes(data[4 : 4 + 8 * n], np.int64)
    return used[B.unplanes(data[4 + 8 * n :], np.uint16 if n <= 1 << 16 else np.uint32)]


def _resolve(rows: pa.Table) -> pa.Table:
    """For each batch: which of its keys occur in an earlier document, and in which."""
    keys = [B.received(x) for x in rows.column("keys").to_pylist()]
    docs = [_documents(x) for x in rows.column("values").to_pylist()]
    order, head, group = B.grouped(keys)
    every = np.concatenate(docs)
    lowest = np.minimum.reduceat(every[order], head)[group]
    out, at = [], 0
    for d in docs:
        low = lowest[at : at + len(d)]
        out.append(np.packbits(low < d).tobytes() + B.planes(low[low < d]))
        at += len(d)
    return B.answer(rows, out)


def _factors(runs: np.ndarray, reference: np.ndarray, at: np.ndarray, base: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """First word, words and reference of the greedy factors; runs: duplicate windows, in order."""
    if not len(runs):
        return (np.zeros(0, np.int64),) * 3
    new = np.ones(len(runs), bool)
    new[1:] = (at[runs[1:]] != at[runs[:-1]] + 1) | (base[runs[1:]] != base[runs[:-1]]) | (reference[runs[1:]] != reference[runs[:-1]])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(runs)))
    return at[runs[first]], n + width - 1, reference[runs[first]]


def _parse(width: int, n_blocks: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("factors", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("reference", pa.int64())])))])
        parts = []
        for payload in left.column("payload"):
            table = B.unseal(payload)
            w = _Windows(table, width)
            edges, lowest = B.cuts(w.keys, n_blocks), w.lowest.copy()
            for block, found in zip(right.column("block").to_pylist(), right.column("found").to_pylist(), strict=True):
                low, high = int(edges[block]), int(edges[block + 1])
                bits = -(-(high - low) // 8)
                hit = np.flatnonzero(np.unpackbits(np.frombuffer(found, np.uint8, bits), count=high - low))
                lowest[low + hit] = B.unplanes(found[bits:], np.int64)
            reference = lowest[w.group]
            runs = np.flatnonzero(reference < w.doc)
            owners = w.words.owners()
            start, length, source = _factors(runs, reference, w.at, owners[w.at], width)
            marks = np.zeros(len(w.words) + 1, np.int64)
            np.add.at(marks, start, 1)
            np.add.at(marks, start + length, -1)
            removed = np.cumsum(marks[:-1]) > 0
            bounds = w.words.bounds
            gone = np.concatenate([[0], np.cumsum(removed)])
            n_removed = gone[bounds[1:]] - gone[bounds[:-1]]
            digests = []
            for d, text in enumerate(table.column("text")):
                kept = text.as_buffer().to_pybytes().split() if text.is_valid else []
                if n_removed[d]:
                    kept = compress(kept, (~removed[bounds[d] : bounds[d + 1]]).tolist())
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            of_doc = np.searchsorted(start, bounds)  # factors don't leave their document
            spans = pa.StructArray.from_arrays(
                [pa.array(start - bounds[np.searchsorted(bounds, start, "right") - 1]), pa.array(length), pa.array(source)], ["start", "length", "reference"]
            )
            parts.append(pa.table([
                table.column("doc_id"), pa.array(w.words.counts), pa.array(n_removed), pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(pa.array(of_doc, pa.int32()), spans),
            ], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return run


def deduplicate(docs: DataFrame, text: str = "text", width: int = WIDTH, batch_bytes: int = B.BATCH_BYTES, block_keys: int = B.BLOCK_KEYS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words kept, joined by one space) and
    factors: first word, number of words, reference document.

    On large executors larger batches and blocks make fewer and longer rows: a batch sends one row
    to each block."""
    batches = B.pack(docs, text, batch_bytes=batch_bytes)
    n = B.count_blocks(batches, block_keys)
    keys = batches.mapInArrow(_index(width, n), B.KEYS)
    found = keys.groupBy("block").applyInArrow(_resolve, B.FOUND)
    return batches.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(_parse(width, n), RESULT)

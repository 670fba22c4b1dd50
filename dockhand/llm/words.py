"""Words of many texts at once as numpy arrays: where they lie, and 64-bit hashes of them.

Texts stay in their Arrow buffer; cutting, lower-casing and hashing are array operations over
all documents of a batch, so that Python's own loop runs once per batch and not once per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_SLICE = 1 << 17  # bytes hashed at once, which fit into the cache; longer words make their slice longer

# The bytes \x20 and \x09-\x0D part words.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one run of bytes, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # several chunks remain only beyond 2 GB
        column = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks])
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_bytes(column: pa.Array) -> np.ndarray:
    """Length of each text in bytes; null has none."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


SLICE_BYTES = 1 << 20  # of text worked on at once; a longer text is a slice of its own


def sliced(batches: Iterable[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded text, as arrays over all words are many times as large."""
    for batch in batches:
        ends = np.cumsum(text_bytes(batch.column(column)))
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(low, high - low)
            low = high


@dataclass
class Words:
    """Words of a batch: bytes starts[i]:ends[i]; those of text d are bounds[d]:bounds[d + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return hash_pieces(self.data, self.starts, self.ends)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[data] for bytes and a table of 256 bytes or booleans, without an index of 8 bytes for each."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), table.dtype)


def _first(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes are inside words, which begin one, and where texts that are not empty begin."""
    inside = mapped(data, ~parts)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = inside[heads]
    return inside, first, heads


def count(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACES) -> int:
    """How many words cut finds."""
    return int(np.count_nonzero(_first(data, offsets, parts)[1]))


def cut(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACES) -> Words:
    """Longest runs of bytes that don't part words, no run reaching into the next text."""
    inside, first, heads = _first(data, offsets, parts)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = heads[1:] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        """Powers of the base and of its inverse up to n - 1."""
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                    x = np.full(n, base, np.uint64)
                    x[0] = 1
                    setattr(cls, name, np.cumprod(x, dtype=np.uint64))


def hash_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece of data: a polynomial over its bytes from prefix sums, mixed
    with its length.  starts ascend and pieces don't overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            low = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, low + _SLICE)))
            high = ends[j - 1]
            _Powers.reach(max(_SLICE, high - low))
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * _Powers.up[: high - low], out=sums[1:])
            s, e = starts[i:j] - low, ends[i:j] - low
            out[i:j] = mix((sums[e] - sums[s]) * _Powers.down[s] + (e - s).astype(np.uint64))
            i = j
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and for each key which of them it is; like np.unique, but only the
    distinct ones are sorted."""
    coded = pa.array(keys).dictionary_encode()
    found = coded.dictionary.to_numpy()
    order = np.argsort(found)
    rank = np.empty(len(found), np.int32)
    rank[order] = np.arange(len(found), dtype=np.int32)
    return found[order], rank[coded.indices.to_numpy()]


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of width consecutive values; run i starts at value i.  Runs that reach
    over the end of a text are for the caller to leave out (see whole)."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out *= np.uint64(_BASE)
            out += hashes[k : k + n]
        return mix(out)


def whole(words: Words, width: int) -> np.ndarray:
    """Of each run of width words: whether it lies in one text."""
    n = max(0, len(words) - width + 1)
    out = np.ones(n, bool)
    for b in words.bounds[1:-1]:
        out[max(0, b - width + 1) : b] = False
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each range, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)

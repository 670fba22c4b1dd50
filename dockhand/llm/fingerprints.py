"""Document fingerprints by consistent weighted sampling.

A text is the multiset of its lower-cased (A-Z) runs of `size` words; a term's weight is how often
it occurs.  In each of SAMPLES samples a hash of the term chooses two Gamma(2, 1) values r and c and
a uniform b (from a pool of 2**18 such triples), which quantize the weight to
t = floor(ln w / r + b) and give the term the key ln c - r * (t - b + 1); the term with the least
key is the sample, equal keys by further bits of the hash.  Two texts draw the same
(term, t) with probability equal to their generalised Jaccard similarity: the sum of the smaller
over the sum of the larger weights.  A fingerprint keeps 16 bits of each sample, and the share of
equal samples estimates the similarity (standard error 0.044 at most; unequal samples agree by
chance once in 65536).

Values depend on term and weight alone, so they are computed once for each distinct pair of a
block of rows, and equal texts have equal fingerprints wherever they are worked on.

`edit_next` compares each text with the next one and with a mixture of both.  It sorts documents
over the whole cluster and looks from row to row within a partition; only the first and last row of
each partition meet through a join.

Defined cases: a null text is empty.  A text with fewer words than `size` is one term of all its
words; without words its fingerprint is empty, which is like another empty one (1) and unlike all
others (0).  Documents go by descending doc_id, nulls last, repeated ids by a hash of their text;
equal rows follow each other in any order.  A single document is its own next one.  Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm import words as W
from dockhand.llm.store import record, written
from dockhand.session import small_table

SAMPLES = 128
_PAIRS = 1 << 17  # (text, term) rows whose values are drawn together
_ROWS = 8192  # of them gathered at once
_TERMS = 512  # terms drawn at once, small enough for a processor's cache
_STRIDE = np.uint64(0x9E3779B97F4A7C15)
_SALT = W.mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _STRIDE)
_POOL_BITS = 18


def _ordered(key: np.ndarray) -> np.ndarray:
    """Integers in the order of the keys, without their lowest 16 bits."""
    bits = key.view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))) & ~np.int64(0xFFFF)


def _key(c: np.ndarray, r: np.ndarray, b: np.ndarray, t: np.ndarray) -> np.ndarray:
    return _ordered(np.log(c) - r * (t - b + 1))


class _Pool:
    """The triples (r, c, b) that hashes of terms choose from, and the order of their keys for t = 0."""

    def __init__(self) -> None:
        n = np.arange(1 << _POOL_BITS, dtype=np.uint64)
        with np.errstate(over="ignore"):
            u = [((W.mix(n * np.uint64(5) + np.uint64(i) + _STRIDE) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53 for i in range(5)]
        self.r, self.c, self.b = -np.log(u[0]) - np.log(u[1]), -np.log(u[2]) - np.log(u[3]), u[4]
        self.single = _key(self.c, self.r, self.b, np.zeros(len(n)))


_POOL = _Pool()

PRINT = record(doc_id="long", fingerprint="binary")
EDITED = record(doc_id="long", n_chars="long", edited_sha256="string", fingerprint="binary", edited_fingerprint="binary", near_edited="double", near_next="double")
_STEP = record(**{f.name: f.dataType for f in EDITED.fields}, part="long", end="string", text="string")


def sampled(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of SAMPLES numbers for each term: the upper 48 bits order its keys, the lower 16
    name the sample, so that the least number over a text's terms is its sample."""
    out = np.empty((len(terms), SAMPLES), np.int64)
    with np.errstate(over="ignore"):
        for low in range(0, len(terms), _TERMS):
            x = W.mix(terms[low : low + _TERMS, None] + _SALT)
            place = (x >> np.uint64(64 - _POOL_BITS)).view(np.int64)
            weight = weights[low : low + _TERMS, None]
            if (weight == 1).all():  # then t is 0
                key = _POOL.single[place]
            else:
                r, c, b = _POOL.r[place], _POOL.c[place], _POOL.b[place]
                t = np.floor(np.log(weight) / r + b)
                key = _key(c, r, b, t)
                x = x + t.astype(np.uint64) * _STRIDE
            out[low : low + _TERMS] = key | ((x >> np.uint64(8)) & np.uint64(0xFFFF)).view(np.int64)
    return out


def _weighted(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and weight of all distinct terms, ordered by text."""
    data, offsets = W.utf8(column)
    words = W.cut(W.LOWER[data], offsets)
    hashes, counts = words.hashes(), words.counts
    text, term = words.owners(), hashes
    if size > 1:
        inside = np.flatnonzero(W.whole(words, size))
        short = np.flatnonzero((counts > 0) & (counts < size))
        alone = [W.windows(hashes[words.bounds[d] : words.bounds[d + 1]], counts[d])[0] ^ np.uint64(counts[d]) for d in short]
        text = np.concatenate([text[inside], short])
        term = np.concatenate([W.windows(hashes, size)[inside], np.array(alone, np.uint64)])
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    head = np.ones(len(text), bool)
    head[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
    first = np.flatnonzero(head)
    return text[first], term[first], np.diff(np.append(first, len(text)))


def signatures(column: pa.Array, size: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Samples of each text (texts x SAMPLES, 16 bits), and which texts have any word."""
    text, term, weight = _weighted(column, size)
    best = np.full((len(column), SAMPLES), np.iinfo(np.int64).max)
    with np.errstate(over="ignore"):
        pair = W.mix(term + weight.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for low in range(0, len(text), _PAIRS):
        _, example, kind = np.unique(pair[low : low + _PAIRS], return_index=True, return_inverse=True)
        single = np.argsort(weight[low + example] > 1, kind="stable")  # most terms occur once, which is quicker
        place = np.empty(len(example), np.int64)
        place[single] = np.arange(len(example))
        values, kind = sampled(term[low + example[single]], weight[low + example[single]]), place[kind]
        for start in range(0, len(kind), _ROWS):
            owner = text[low + start : low + min(start + _ROWS, len(kind))]
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            best[owner[heads]] = np.minimum(best[owner[heads]], np.minimum.reduceat(values[kind[start : start + _ROWS]], heads))
    filled = np.zeros(len(column), bool)
    filled[text] = True
    return (best & 0xFFFF).astype(np.uint16), filled


def likeness(a: np.ndarray, b: np.ndarray, has_a: np.ndarray, has_b: np.ndarray) -> np.ndarray:
    """Share of equal samples of each pair of fingerprints."""
    return np.where(has_a & has_b, (a == b).mean(-1), (has_a == has_b).astype(float))


def _binary(prints: np.ndarray, filled: np.ndarray) -> pa.Array:
    return pa.array([p.tobytes() if f else b"" for p, f in zip(prints, filled, strict=True)], pa.binary())


def fingerprint(docs: DataFrame, text: str = "text", size: int = 1) -> DataFrame:
    """doc_id and fingerprint for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.sliced(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(*signatures(batch.column(1), size))], PRINT.names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, PRINT)


def _compared(table: pa.Table, share: int, size: int) -> list[pa.Array]:
    """Columns of EDITED for all rows of (doc_id, text) but the last, which is only a next one."""
    texts = [x or "" for x in table.column("text").to_pylist()]
    lengths = [len(x) for x in texts]
    edited = [x[: n - n // share] + y[: n // share] for x, y, n in zip(texts, texts[1:], lengths, strict=False)]
    every = [x for both in zip(texts, edited, strict=False) for x in both] + texts[-1:]  # equal terms side by side
    prints, filled = signatures(pa.array(every, pa.large_string()), size)
    n = len(edited)
    own, mixed, after = slice(0, -1, 2), slice(1, None, 2), slice(2, None, 2)
    return [
        table.column("doc_id").combine_chunks().slice(0, n), pa.array(lengths[:n], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
        _binary(prints[own], filled[own]), _binary(prints[mixed], filled[mixed]),
        pa.array(likeness(prints[own], prints[mixed], filled[own], filled[mixed]), pa.float64()),
        pa.array(likeness(prints[own], prints[after], filled[own], filled[after]), pa.float64()),
    ]


def _walk(share: int, size: int):
    """Compares neighbours within a sorted partition; its first and last row go on for the rest."""
    given = pa.schema([("doc_id", pa.int64()), ("text", pa.large_string())])

    def ends(part: int, end: str, table: pa.Table) -> pa.RecordBatch:
        empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        columns = [table.column("doc_id").combine_chunks(), *empty, pa.array([part], pa.int64()), pa.array([end], pa.string()), table.column("text").combine_chunks().cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, _STEP.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in W.sliced(batches, 1):
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).cast(given)
            if held is None:
                yield ends(part, "first", table.slice(0, 1))
            else:
                table = pa.concat_tables([held, table])
            held = table.slice(table.num_rows - 1)
            if table.num_rows > 1:
                rest = [pa.nulls(table.num_rows - 1, t) for t in (pa.int64(), pa.string(), pa.string())]
                yield pa.RecordBatch.from_arrays(_compared(table, share, size) + rest, _STEP.names)
        if held is not None:
            yield ends(part, "last", held)

    return run


def _meet(share: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts = pa.chunked_array([pa.array([batch.column(k)[i].as_py() for k in (1, 2)], pa.large_string())])
                ids = pa.chunked_array([pa.array([batch.column(0)[i].as_py(), None], pa.int64())])
                yield pa.RecordBatch.from_arrays(_compared(pa.table([ids, texts], ["doc_id", "text"]), share, size), EDITED.names)

    return run


def edit_next(docs: DataFrame, text: str = "text", share: int = 3, size: int = 1) -> DataFrame:
    """Every document beside its edited text, of which the last floor(n_chars / share) characters
    are the first as many of the next document: doc_id, n_chars, edited_sha256, both fingerprints
    and the likeness to the edited text and to the next document."""
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").desc(), F.xxhash64("text"), F.col("place")]
    placed = given.withColumn("place", F.monotonically_increasing_id())  # spreads equal rows over partitions
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    steps = written(ordered.mapInArrow(_walk(share, size), _STEP), "fingerprints")
    inner = steps.where("end is null").select(*EDITED.names)
    ends = steps.where("end is not null").select("doc_id", "text", "part", "end")
    parts = sorted(row.part for row in ends.where("end = 'first'").select("part").collect())  # one number per partition
    after = small_table(docs.sparkSession, list(zip(parts, parts[1:] + parts[:1], strict=True)), "part bigint, next bigint")
    lasts = ends.where("end = 'last'").join(F.broadcast(after), "part").select("doc_id", "text", "next")
    firsts = ends.where("end = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    outer = lasts.join(firsts, "next").select("doc_id", "text", "next_text").mapInArrow(_meet(share, size), EDITED)
    return inner.unionByName(outer)

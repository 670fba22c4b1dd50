"""Importance resampling towards a target distribution.

Features are runs of words, hashed to buckets (CRC-32 of their UTF-8 bytes).  Bucket counts of the
documents and of a target corpus give every bucket a gain, 1000 times the log of the ratio of its
smoothed shares; a document's weight is the floored mean of its features' gains.  A seeded Gumbel
value by document turns weights into scores whose largest ones are a draw without replacement.

The draw is an exact selection without a global sort.  Every chunk of remaining keys tells the
median of its keys; the median of these, weighted by what each chunk still holds, parts the rest
so that at least a quarter of it is discarded, until few keys are left, which are sorted.  What
remains is written anew whenever it has halved, so that all rounds together read a small multiple
of the narrow table of keys.  Only the winners are sorted.

Keys are (score descending, doc_id ascending, number of features, a number given to each row), so
there are no ties; rows that share all but the last are alike in every column of the result.

Defined cases: a null or empty text has no features, weight 0 and no draw; a doc_id that is null
is seeded by the empty string and comes after all others; repeated rows each count and each take
part in the draw; empty tables give gains from the smoothing alone.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.llm import words as W
from dockhand.llm.store import record, written
from dockhand.session import small_table

# Bytes that part words, all of ASCII but digits and a-z.
PARTS = np.zeros(256, bool)
PARTS[0x00:0x30] = PARTS[0x3A:0x61] = PARTS[0x7B:0x80] = True

CHUNK = 1_000_000  # keys of which one median is taken
FEW = 20_000  # keys that are sorted on the driver in the end
NO_ID = np.iinfo(np.int64).max

COUNTS = record(bucket="int", n="long")
SCORES = record(doc_id="long", n_words="long", n_features="long", weight="long", score="long")
_KEY = ("minus", "id", "features", "row")
_MEDIAN = record(before="string", **{k: "long" for k in _KEY}, n="long")


@dataclass(frozen=True)
class Plan:
    """Features are runs of shortest to longest words; `percent` of the documents of at least
    `least_words` words are drawn."""

    buckets: int = 10000
    shortest: int = 1
    longest: int = 1
    seed: int = 2024
    percent: int = 10
    least_words: int = 20


def features(column: pa.Array, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every feature, and the number of words of each text."""
    data, offsets = W.utf8(column)
    words = W.cut(W.LOWER[data], offsets, PARTS)
    owners, hashes, texts, buckets = words.owners(), words.hashes(), [], []
    for size in range(plan.shortest, plan.longest + 1):
        at = np.flatnonzero(W.whole(words, size))
        _, example, kind = np.unique(W.windows(hashes, size)[at], return_index=True, return_inverse=True)
        spelled = (b" ".join(words.text(i) for i in range(a, a + size)) for a in at[example].tolist())
        crc = np.fromiter((zlib.crc32(x) % plan.buckets for x in spelled), np.int64, len(example))
        texts.append(owners[at])
        buckets.append(crc[kind])
    return np.concatenate(texts), np.concatenate(buckets), words.counts


def bucket_counts(rows: DataFrame, plan: Plan, text: str = "text") -> np.ndarray:
    """Features per bucket over all rows; every task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(plan.buckets, np.int64)
        for batch in W.sliced(batches, 0):
            sums += np.bincount(features(batch.column(0), plan)[1], minlength=plan.buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used])], COUNTS.names)

    counted = rows.select(F.col(text).cast("string").alias("text")).mapInArrow(run, COUNTS).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(plan.buckets, np.int64)
    sums[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    return sums


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) of each bucket."""
    n, many, few = len(documents), float(documents.sum() + len(documents)), float(target.sum() + len(target))
    ratio = ((target + 1.0) * many) / ((documents + 1.0) * few)
    return np.fromiter((math.floor(1000 * math.log(x)) for x in ratio.tolist()), np.int64, n)


def gumbel(doc_id: int | None, seed: int) -> int:
    """floor(1000 * a Gumbel value) that follows from seed and document."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gain: np.ndarray, plan: Plan, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.sliced(batches, 1):
            owner, bucket, n_words = features(batch.column(1), plan)
            n = np.bincount(owner, minlength=batch.num_rows)
            sums = np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, owner, gain[bucket])
            weight = sums // np.maximum(n, 1)
            noise = np.fromiter((gumbel(d, plan.seed) for d in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            columns = (n_words, n, weight, weight + noise)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], SCORES.names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, SCORES)


def _medians(pivot: tuple | None, chunk: int):
    """Of each chunk the (lower) median and the number of its keys up to the pivot, and beyond it."""

    def tell(side: str, keys: list[np.ndarray]) -> pa.RecordBatch:
        middle = np.lexsort(keys[::-1])[(len(keys[0]) - 1) // 2]
        columns = [[side], *([int(k[middle])] for k in keys), [len(keys[0])]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), *[pa.int64()] * 5), strict=True)], _MEDIAN.names)

    def both(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        before = np.ones(len(keys[0]), bool)
        for k, p in zip(reversed(keys), reversed(pivot or ()), strict=False):
            before = (k < p) | ((k == p) & before)
        for side, chosen in (("yes", before), ("no", ~before)):
            if chosen.any():
                yield tell(side, [k[chosen] for k in keys])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            n += batch.num_rows
            if n >= chunk:
                yield from both([np.concatenate(c) for c in zip(*held, strict=True)])
                held, n = [], 0
        if n:
            yield from both([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def _until(pivot: tuple) -> Column:
    """Whether a key is the pivot or comes before it."""
    return F.struct(*_KEY) <= F.struct(*[F.lit(int(x)).cast("bigint").alias(k) for k, x in zip(_KEY, pivot, strict=True)])


def cutoff(keys: DataFrame, wanted: int, chunk: int = CHUNK, few: int = FEW) -> tuple | None:
    """The wanted-th of the keys (columns of _KEY, no two alike) in ascending order; None for the 0th."""
    if wanted <= 0:
        return None
    rest, rest_rows, remaining, pivot = keys, None, keys, None
    while True:
        told = remaining.mapInArrow(_medians(pivot, chunk), _MEDIAN).collect()  # two small rows a chunk
        sides = {side: [(tuple(r[k] for k in _KEY), r.n) for r in told if r.before == side] for side in ("yes", "no")}
        sizes = {side: sum(n for _, n in rows) for side, rows in sides.items()}
        if pivot is None:
            side, rest_rows = "yes", sizes["yes"]
            if wanted > rest_rows:
                raise ValueError(f"{wanted} keys are wanted of {rest_rows}")
        elif wanted <= sizes["yes"]:
            side, remaining = "yes", remaining.where(_until(pivot))
        else:
            side, remaining, wanted = "no", remaining.where(~_until(pivot)), wanted - sizes["yes"]
        if sizes[side] <= few:
            return sorted(tuple(r) for r in remaining.select(*_KEY).collect())[wanted - 1]
        if 2 * sizes[side] <= rest_rows:
            rest, rest_rows = written(remaining, "selection"), sizes[side]
            remaining = rest
        above = 0
        for pivot, n in sorted(sides[side]):  # the weighted median of the medians
            above += n
            if 2 * above >= sizes[side]:
                break


def draw(scored: DataFrame, wanted: int, among: Column, chunk: int = CHUNK, few: int = FEW) -> DataFrame:
    """The rows of scored with a rank: 1, 2, 3... for the `wanted` first ones among those given, else null."""
    keyed = scored.withColumn("row", F.monotonically_increasing_id())
    keyed = keyed.withColumns({"minus": -F.col("score"), "id": F.coalesce("doc_id", F.lit(int(NO_ID))), "features": F.col("n_features")})
    keyed = written(keyed, "scores")
    among = F.coalesce(among, F.lit(False))
    last = cutoff(keyed.where(among).select(*_KEY), wanted, chunk, few)
    if last is None:
        return keyed.withColumn("rank", F.lit(None).cast("bigint")).select(*scored.columns, "rank")
    winners = keyed.where(among & _until(last)).select(*_KEY)
    placed = winners.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY).withColumn("place", F.monotonically_increasing_id())
    placed = written(placed, "winners").select("row", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("at"))
    sizes = sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())  # one row a partition
    offsets, before = [], 0
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    offsets = small_table(scored.sparkSession, offsets, "part bigint, before bigint")
    ranks = placed.join(F.broadcast(offsets), "part").select("row", (F.col("before") + F.col("at") + 1).alias("rank"))
    return keyed.join(ranks, "row", "left").select(*scored.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, plan: Plan | None = None, text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; target: rows of text."""
    plan = plan or Plan()
    gain = gains(bucket_counts(docs, plan, text), bucket_counts(target, plan, target_text))
    scored = written(score(docs, gain, plan, text), "weights")
    long_enough = F.col("n_words") >= plan.least_words
    return draw(scored, plan.percent * scored.where(long_enough).count() // 100, long_enough)

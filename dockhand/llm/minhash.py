"""MinHash near-deduplication with HyperMinHash sketches.

A document is the set of its distinct word shingles.  Each of REGISTERS buckets keeps of its
smallest hash the number of leading zeros and the bits after the first one (6 + 10 bits); empty
buckets borrow the register of a bucket found by a fixed sequence of probes.  BANDS of ROWS
registers each are hashed; documents that share a band are candidates.  Pairs whose estimated
similarity, corrected for registers that agree by chance, is too low by five standard errors are
left; the others are confirmed on the full sets.  A pair of similarity 0.8 shares no band with
probability 3e-6.

Documents with equal sets are one class and compared once.  Only components are asked for, so
pairs are never expanded: in every band all members are first compared with one of them.  Where a
band still holds several components - if many members, after another one, drawn by hash, was
compared with all - these are compared in full, tile by tile within bounded groups, from which
only what unites members is sent on.  So no link is lost between members of a band, and a group of
copies sends about a pair per member.

Defined cases: a text with fewer words than a shingle is one shingle of all its words; without
words (null, empty) the set is empty and links with nothing.  A row without doc_id links with
nothing, has no component and is kept.  Rows with one id are one document: all sets link through
it.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.llm import words as W
from dockhand.llm.store import components, record, spread, written

REGISTERS = 256
ROWS, BANDS = 6, 42
MANTISSA = 10  # bits; 6 more for the leading zeros
TILE = 512  # members of a band compared with as many others in one group
DRAW = 4  # tiles of a band beyond which a drawn member is compared first; results don't depend on it
_COLUMNS = 4096  # of the membership matrix at once
BROADCAST_ROWS = 2_000_000  # ids of 8 bytes

SKETCH = record(doc_id="long", n="long", set_id="binary", registers="binary")
SET = record(doc_id="long", set_id="binary", shingles=T.ArrayType(T.LongType()))


def shingles(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data, offsets = W.utf8(column)
    words = W.cut(W.LOWER[data], offsets)
    hashes, b = words.hashes(), words.bounds
    runs = W.windows(hashes, size)
    for low, high in zip(b[:-1].tolist(), b[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(runs[low : high - size + 1])
        elif high > low:
            yield W.windows(hashes[low:high], high - low) ^ np.uint64(high - low)
        else:
            yield np.zeros(0, np.uint64)


def _probes() -> np.ndarray:
    """For each bucket the order in which others are asked when it is empty."""
    order = np.random.default_rng(7)
    return np.stack([order.permutation(REGISTERS) for _ in range(REGISTERS)])


_PROBES = _probes()


def sketch(values: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set of hashes, as 16-bit numbers.

    Of a bucket's smallest hash the 56 bits below the bucket's own are kept as leading zeros and
    the MANTISSA bits after the first one: a floating-point number with a short mantissa."""
    values = W.mix(values)
    bucket = (values >> np.uint64(56)).astype(np.int64)
    rest = (values << np.uint64(8)) >> np.uint64(8)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bucket, rest)
    full = least != np.iinfo(np.uint64).max
    exponent = np.frexp(np.maximum(least, 1).astype(np.float64))[1].astype(np.int64)  # 1..56
    shift = exponent - 1 - MANTISSA
    after = np.where(shift >= 0, least >> np.maximum(shift, 0).astype(np.uint64), least << np.maximum(-shift, 0).astype(np.uint64))
    register = ((56 - exponent).astype(np.uint16) << np.uint16(MANTISSA)) | (after & np.uint64((1 << MANTISSA) - 1)).astype(np.uint16)
    if not full.all():
        empty = np.flatnonzero(~full)
        register[empty] = register[_PROBES[empty, full[_PROBES[empty]].argmax(1)]]
    return register


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers, less those expected to agree by chance."""
    chance = 0.169919487159739 * REGISTERS / (1 << MANTISSA) * 4.0 * n_a * n_b / np.maximum(n_a + n_b, 1) ** 2
    return np.maximum((a == b).sum(-1) - chance, 0) / REGISTERS


def least_estimate(n: np.ndarray, threshold: float) -> np.ndarray:
    """Five standard errors below the threshold; small sets fill few registers of their own."""
    return threshold - 5 * np.sqrt(threshold * (1 - threshold) / np.minimum(np.maximum(n, 1), REGISTERS))


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.sliced(batches, 1):
            n, names, registers = [], [], []
            for s in shingles(batch.column(1), size):
                n.append(len(s))
                names.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                registers.append(sketch(s).tobytes() if len(s) else None)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(names, pa.binary()), pa.array(registers, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, SKETCH.names)

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.sliced(batches, 1):
            every = list(shingles(batch.column(1), size))
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in every]
            ends = np.cumsum([0] + [len(s) for s in every])
            values = pa.array(np.concatenate(every).view(np.int64) if every else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), lists], SET.names)

    return run


class _Search:
    """Candidates and confirmed links between classes; a class is named by its smallest doc_id
    and its set, as a document with several rows may have several sets."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.size, self.percent = size, percent
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.sketches = written(self.docs.mapInArrow(_sketches(size), SKETCH), "minhash-sketches", compression="none")
        linked = self.sketches.where("doc_id is not null and n > 0")
        self.classes = linked.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
        own = linked.join(self.classes.withColumnRenamed("rep", "doc_id"), ["set_id", "doc_id"])
        self.reps = own.select(F.col("doc_id").alias("rep"), "set_id", "n", "registers").dropDuplicates(["rep", "set_id"])

    def bands(self) -> DataFrame:
        """(band, rep) of all bands with two members or more, with the smallest as hub."""
        width = 2 * ROWS
        keys = F.array(*[F.xxhash64(F.lit(b), F.substring("registers", width * b + 1, width)) for b in range(BANDS)])
        rows = self.reps.select("rep", F.explode(keys).alias("band"))
        shared = rows.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("other")).where("hub < other")
        return written(rows.join(shared.select("band", "hub"), "band"), "minhash-bands")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose estimate is near or above the threshold."""
        of = lambda end: self.reps.select(F.col("rep").alias(end), F.col("n").alias(f"n_{end}"), F.col("registers").alias(f"r_{end}"))
        threshold = self.percent / 100

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in ("r_a", "r_b"))
                n_a, n_b = (batch.column(k).to_numpy() for k in ("n_a", "n_b"))
                near = estimate(a, b, n_a, n_b) >= least_estimate(np.minimum(n_a, n_b), threshold)
                near &= 100 * np.minimum(n_a, n_b) >= self_percent * np.maximum(n_a, n_b)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(near))

        self_percent = self.percent
        sized = pairs.join(of("a"), "a").join(of("b"), "b")
        return sized.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, record(a="long", b="long"))

    def sets_of(self, needed: DataFrame) -> DataFrame:
        """doc_id, set_id and shingles of the documents with the ids given."""
        if needed.count() <= BROADCAST_ROWS:
            needed = F.broadcast(needed)
        sets = self.docs.join(needed, "doc_id").mapInArrow(_sets(self.size), SET)
        return written(sets.dropDuplicates(["doc_id", "set_id"]), "minhash-sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with 100 * intersection >= percent * union of the full sets."""
        pairs = written(pairs.distinct(), "minhash-pairs")
        sets = self.sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
        of = lambda end: sets.select(F.col("doc_id").alias(end), F.col("shingles").alias(f"s_{end}"))
        both = pairs.join(of("b"), "b").join(of("a"), "a")
        shared = F.size(F.array_intersect("s_a", "s_b")).cast("bigint")
        enough = 100 * shared >= self.percent * (F.size("s_a") + F.size("s_b") - shared)
        return written(both.where(enough).select("a", "b"), "minhash-links")

    def labelled(self, bands: DataFrame, links: DataFrame) -> DataFrame:
        """Members of bands that still hold several components, with these."""
        labels = components(links, "minhash-components").select(F.col("node").alias("rep"), "root")
        rows = bands.join(labels, "rep", "left").select("band", "hub", "rep", F.coalesce("root", "rep").alias("root"))
        mixed = rows.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        return rows.join(mixed.select("band"), "band")

    def tiled(self, rows: DataFrame) -> DataFrame:
        """Confirmed links between different components within the bands.  A large component of a
        band has tiles of its own; the others share tiles, each whole in one.  Two tiles of one
        component have nothing to compare, so a member is sent once per tile of other components.
        Each pair of tiles is one group of at most about 2 * TILE members, in which likely pairs are
        confirmed on the full sets.  Only what unites members leaves the group."""
        rows = written(self.dealt(rows), "minhash-dealt")
        tiles = written(rows.select("band", "own", "tile").distinct(), "minhash-tiles")
        other = tiles.select("band", F.col("own").alias("other_own"), F.col("tile").alias("other"))
        differ = ~F.col("own").eqNullSafe(F.col("other_own")) | F.col("own").isNull()
        pairs = tiles.join(other, "band").where(differ & (F.col("tile") <= F.col("other"))).select("band", F.col("tile").alias("low"), F.col("other").alias("high"))
        uses = pairs.select("band", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("tile"))
        known = self.sets_of(rows.select(F.col("rep").alias("doc_id")).distinct()).withColumnRenamed("doc_id", "rep")
        members = self.reps.join(known, ["rep", "set_id"]).select("rep", "registers", "shingles")
        rows = rows.join(uses, ["band", "tile"]).select("band", "low", "high", "tile", "rep", "root").join(members, "rep")
        rows = rows.select("band", "low", "high", "tile", "rep", "root", "registers", "shingles")
        links = rows.groupBy("band", "low", "high").applyInArrow(_within_tiles(self.percent), record(a="long", b="long"))
        return written(links.distinct(), "minhash-links")

    @staticmethod
    def dealt(rows: DataFrame) -> DataFrame:
        """rows with `own`, the root of a component with tiles of its own (else null), and `tile`."""
        sizes = rows.groupBy("band", "root").agg(F.count("*").alias("size"))
        large = F.col("size") > TILE
        shared = sizes.groupBy("band").agg(F.greatest(F.ceil(F.sum(F.when(large, 0).otherwise(F.col("size"))) / TILE), F.lit(1)).alias("shared"))
        sizes = sizes.join(shared, "band").withColumn("own", F.when(large, F.col("root")))
        rows = rows.join(sizes, ["band", "root"])
        place = F.when(large, F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / TILE))).otherwise(F.pmod(F.xxhash64("root"), F.col("shared")))
        return rows.select("band", "rep", "root", "own", F.xxhash64("own", place).alias("tile"))

    def links(self) -> DataFrame:
        bands = self.bands()
        links = self.confirmed(self.likely(bands.where("hub < rep").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()))
        left = written(self.labelled(bands, links).where("hub <> rep"), "minhash-left")  # pairs with the hub are done
        sizes = left.groupBy("band").count()
        if not sizes.where(F.col("count") > DRAW * TILE).isEmpty():
            drawn = left.groupBy("band").agg(F.min_by(F.struct("rep", "root"), F.xxhash64("band", "rep")).alias("hub"))
            pairs = left.drop("hub").join(drawn, "band").where("root <> hub.root")
            pairs = pairs.select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct()
            links = links.unionAll(self.confirmed(self.likely(pairs)))
            left = written(self.labelled(left.select("band", "hub", "rep"), links), "minhash-left")
        return links if left.isEmpty() else links.unionAll(self.tiled(left))


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets."""
    sets = [*left, *right]
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(column, minlength=len(values)) > 1
    use = shared[column]
    row, column = row[use], (np.cumsum(shared) - 1)[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        matrix = np.zeros((len(sets), _COLUMNS), np.float32)
        matrix[row[a:b], column[a:b] - low] = 1
        out += matrix[: len(left)] @ matrix[len(left) :].T
    return out.astype(np.int64)


def _within_tiles(percent: int):
    def run(group: pa.Table) -> pa.Table:
        rep, root, tile = (group.column(k).to_numpy() for k in ("rep", "root", "tile"))
        sets = [x.values.to_numpy() for x in group.column("shingles")]
        n = np.array([len(s) for s in sets])
        registers = np.frombuffer(b"".join(group.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        left = np.flatnonzero(tile == group.column("low")[0].as_py())
        right = np.flatnonzero(tile == group.column("high")[0].as_py())
        likely = np.zeros((len(left), len(right)), bool)
        for i, x in enumerate(left):
            near = estimate(registers[x], registers[right], n[x], n[right]) >= least_estimate(np.minimum(n[x], n[right]), percent / 100)
            likely[i] = near & (root[right] != root[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))
        left, right, likely = left[likely.any(1)], right[likely.any(0)], likely[likely.any(1)][:, likely.any(0)]
        if not len(left):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        common = _common([sets[i] for i in left], [sets[i] for i in right])
        link = np.zeros((len(rep), len(rep)), bool)
        link[np.ix_(left, right)] = likely & (100 * common >= percent * (n[left][:, None] + n[right][None, :] - common))
        label = spread(link | link.T)
        moved = label != np.arange(len(label))
        return pa.table({"a": np.minimum(rep[moved], rep[label[moved]]), "b": np.maximum(rep[moved], rep[label[moved]])})

    return run


def near_duplicates(docs: DataFrame, size: int, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (columns doc_id, text).

    Documents link if 100 * intersection >= percent * union of their sets of `size`-word
    shingles; component_id is the smallest doc_id reachable."""
    search = _Search(docs, size, percent)
    links = search.links()
    known = search.sketches.where("doc_id is not null and n > 0").select("doc_id", "set_id").join(search.classes, "set_id")
    several = known.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("doc_id")
    bridges = known.join(several, "doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    roots = components(links.unionAll(bridges), "minhash-components")
    rows = search.sketches.select("doc_id", "n", "set_id").join(search.classes, "set_id", "left")
    rows = rows.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    found = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "rep", "doc_id")).alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

"""Near-duplicate embeddings by sorted projection passes.

In each pass vectors are ordered by 64 concatenated sign bits of random projections, so that
vectors of a small angle tend to stand close; every vector is compared in double precision with
all others in its window of the order and in the next.  The links found in a window are united
there, and the unions of all passes become components.  Links only join vectors of one component,
so counting them in full within components, tile by tile, makes the number of links of a vector
complete even where a group is larger than a window.

A pass brings two vectors of cosine 0.95 into one window if they agree in as many leading bits as
it takes to part the vectors into windows.  A first round has the passes that evenly spread vectors
need.  Then the bits that it took around each vector are measured, which tells how likely a vector
at the threshold has met it; in a dense cloud they are many.  Vectors for which a miss is likelier
than MISS go to further rounds, sorted among themselves by fresh projections around their own
mean, until none is left or comparing all that are left with each other, in tiles, sends less.

Equal vectors are one class and compared once; copies count as links.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component link
with nothing.  Vectors of different lengths don't link.  Rows without vec_id link with nothing,
have no component and are kept.  Repeated rows are copies of each other.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.store import components, record, spread, written

WINDOW = 1024
MISS = 0.01
TILE = 1024
ROUND = 32  # most passes between two measurements after the first

VECTOR = record(vec_id="long", set_id="binary", vector="binary")


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors as unit vectors in double precision, with a digest of their components."""
    for batch in batches:
        names, units = [], []
        for value in batch.column(1):
            v = value.values.to_numpy(zero_copy_only=False).astype(np.float64) if value.is_valid else np.zeros(0)
            top = np.abs(v).max(initial=0.0)
            if not 0 < top < np.inf:  # also false for NaN, which a null component becomes
                names.append(None)
                units.append(None)
                continue
            v = v / top + 0.0
            names.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest())
            units.append((v / np.sqrt(v @ v)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), pa.array(units, pa.binary())], VECTOR.names)


def passes_for(n: int, cosine: float, window: int) -> int:
    """Passes after which at most MISS of the pairs at the threshold are expected apart, where the
    vectors are spread evenly."""
    bits = math.log2(max(2.0, n / window))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return max(4, math.ceil(math.log(MISS) / math.log1p(-meet)))


def _means(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector of each length: one row per task and length comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for value in batch.column(0):
                v = np.frombuffer(value.as_buffer(), np.float64)
                n, total = sums.get(len(v), (0, 0.0))
                sums[len(v)] = n + 1, total + v
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in sums.values()], pa.int64()), pa.array([x.tobytes() for _, x in sums.values()], pa.binary())], ["n", "total"])

    found: dict[int, tuple[int, np.ndarray]] = {}
    for row in vectors.select("vector").mapInArrow(run, record(n="long", total="binary")).toLocalIterator():
        v = np.frombuffer(row.total, np.float64)
        n, total = found.get(len(v), (0, 0.0))
        found[len(v)] = n + row.n, total + v
    return {dim: total / n for dim, (n, total) in found.items()}


def _keys(passes: int, seed: int, number: int, cosine: float, means: dict[int, np.ndarray]):
    """(rep, pass, dim, key, agree): sign bits of 64 projections around the mean as a number that
    sorts like them; agree is the logarithm of the chance that a vector at the threshold has the
    same bit."""
    apart = math.sqrt(2 - 2 * cosine)  # distance at the threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            reps = batch.column(0).to_numpy()
            dims = np.array([len(x.as_buffer()) // 8 for x in batch.column(1)])
            for dim in np.unique(dims):
                every = np.flatnonzero(dims == dim)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim), number]).standard_normal((int(dim), 64 * passes))
                for at in np.array_split(every, -(-len(every) * passes // (1 << 16))):
                    units = np.frombuffer(b"".join(batch.column(1).take(pa.array(at)).to_pylist()), np.float64).reshape(len(at), dim)
                    units = units - means.get(int(dim), 0.0)
                    sine = apart / (2 * np.maximum(np.sqrt((units * units).sum(1)), apart / 2))
                    agree = np.log(np.maximum(1 - 2 * np.arcsin(sine) / math.pi, 1e-9))
                    bits = np.packbits((units @ planes[dim] > 0).reshape(len(at), passes, 64), axis=2)
                    keys = (bits.view(">u8").reshape(-1).astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(reps[at], passes)), pa.array(np.tile(np.arange(passes), len(at))),
                        pa.array(np.full(len(keys), dim, np.int64)), pa.array(keys), pa.array(np.repeat(agree, passes)),
                    ], ["rep", "pass", "dim", "key", "agree"])

    return run


def _units(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("vector").to_pylist()), np.float64).reshape(group.num_rows, -1)


def _unite(cosine: float):
    """Of one window and the next of one pass, or of two tiles: (a, b), each linked vector with the
    first of its component there."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        rep, units = group.column("rep").to_numpy(), _units(group)
        label = spread(units @ units.T >= cosine)
        moved = label != np.arange(len(label))
        return pa.table({"a": rep[moved], "b": rep[label[moved]]})

    return run


def _count(cosine: float):
    """Of two tiles of a component: the number of linked copies of other vectors, per vector."""

    def run(group: pa.Table) -> pa.Table:
        rep, copies, tile, units = group.column("rep").to_numpy(), group.column("copies").to_numpy(), group.column("tile").to_numpy(), _units(group)
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        a, b = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        link = units[a] @ units[b].T >= cosine
        if low == high:
            np.fill_diagonal(link, False)
            return pa.table({"rep": rep[a], "n": link @ copies[b]})
        return pa.table({"rep": np.concatenate([rep[a], rep[b]]), "n": np.concatenate([link @ copies[b], link.T @ copies[a]])})

    return run


def _windows(classes: DataFrame, passes: int, window: int, keys) -> DataFrame:
    """(rep, pass, dim, key, agree, window): the place of each vector in the order of each pass."""
    spark = classes.sparkSession
    keys = written(classes.select("rep", "vector").mapInArrow(keys, _KEYED), "vector-keys")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(parts, "dim", "pass", "key", "rep").sortWithinPartitions("dim", "pass", "key", "rep")
    ordered = written(ordered.select("*", F.monotonically_increasing_id().alias("id")), "vector-order")
    ordered = ordered.withColumn("part", F.shiftright("id", 33)).withColumn("row", F.col("id").bitwiseAND((1 << 33) - 1))
    sizes = ordered.groupBy("dim", "pass", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = F.sum("n").over(Window.partitionBy("dim", "pass").orderBy("part")) - F.col("n")
    sizes = sizes.select("dim", "pass", "part", (before - F.col("first")).alias("shift"))
    placed = ordered.join(sizes, ["dim", "pass", "part"])
    return placed.select("rep", "pass", "dim", "key", "agree", F.floor((F.col("row") + F.col("shift")) / window).alias("window"))


_KEYED = record(**{"rep": "long", "pass": "long", "dim": "long", "key": "long", "agree": "double"})


def _missed(placed: DataFrame) -> DataFrame:
    """(rep, miss): logarithm of the chance that a vector at the threshold was never compared.

    A vector is compared with its window and both neighbours.  The last key before these and the
    first one after them tell how many leading bits a key must share with its own to lie between."""
    at = ["pass", "dim", "window"]
    ends = placed.groupBy(*at).agg(F.min("key").alias("above"), F.max("key").alias("below"))
    placed = placed.join(ends.select("pass", "dim", (F.col("window") + 2).alias("window"), "below"), at, "left")
    placed = placed.join(ends.select("pass", "dim", (F.col("window") - 2).alias("window"), "above"), at, "left")

    def bits(other: str):
        differ = F.col("key").bitwiseXOR(F.col(other))
        return F.coalesce(F.when(differ == 0, F.lit(65)).otherwise(65 - F.length(F.bin(differ))), F.lit(0))

    meet = F.exp(F.greatest(bits("below"), bits("above")) * F.col("agree"))
    return placed.groupBy("rep").agg(F.sum(F.log(F.greatest(1 - meet, F.lit(1e-300)))).alias("miss"))


def _tiled(vectors: DataFrame, tiles: int, cosine: float) -> DataFrame:
    """Links among all vectors, two tiles at a time."""
    vectors = vectors.select("rep", "vector", F.length("vector").alias("dim"), F.pmod(F.xxhash64("rep"), F.lit(tiles)).alias("tile"))
    vectors = vectors.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    vectors = vectors.select("rep", "vector", "dim", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    return vectors.groupBy("dim", "low", "high").applyInArrow(_unite(cosine), _PAIRS)


_PAIRS = record(a="long", b="long")


def _pairs(classes: DataFrame, cosine: float, window: int, tile: int, seed: int, passes: int) -> DataFrame:
    """(a, b): links of classes, and links that follow from them."""
    found, todo, before, done, number = [], classes, None, 0, 0
    while True:
        placed = _windows(todo, passes, window, _keys(passes, seed, number, cosine, _means(todo) if number else {}))
        near = placed.select("rep", "pass", "dim", F.explode(F.array("window", F.col("window") - 1)).alias("window"))
        near = near.join(todo.select("rep", "vector"), "rep").groupBy("pass", "dim", "window").applyInArrow(_unite(cosine), _PAIRS)
        found.append(written(near, "vector-pairs"))
        done, number = done + passes, number + 1
        missed = _missed(placed)
        if before is not None:
            missed = missed.join(before.withColumnRenamed("miss", "earlier"), "rep").select("rep", (F.col("miss") + F.col("earlier")).alias("miss"))
        before = written(missed.where(F.col("miss") > math.log(MISS)), "vector-missed")
        more = done * (math.log(MISS) / F.least("miss", F.lit(-1e-9)) - 1)
        left, more = before.agg(F.count("*"), F.percentile_approx(more, 0.5)).first()
        if not left:
            break
        todo = written(classes.join(before.select("rep"), "rep"), "vector-todo", compression="none")
        tiles = -(-left // tile)
        if tiles <= 2 * more:  # a pass sends each vector twice, comparing all sends it to each tile
            found.append(written(_tiled(todo, tiles, cosine), "vector-pairs"))
            break
        passes = max(1, min(ROUND, math.ceil(more)))
    out = found[0]
    for pairs in found[1:]:
        out = out.unionAll(pairs)
    return out


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, window: int = WINDOW, tile: int = TILE, seed: int = 5, passes: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors (vec_id, embedding)."""
    given = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = written(given.mapInArrow(_clean, VECTOR), "vectors", compression="none")
    valid = rows.where("vec_id is not null and set_id is not null")
    groups = valid.groupBy("set_id").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = valid.join(groups.withColumnRenamed("rep", "vec_id"), ["set_id", "vec_id"]).dropDuplicates(["set_id"])
    # A vec_id may stand for several vectors, so a class is named by a number of its own.
    classes = written(classes.select(F.xxhash64("set_id", "vec_id").alias("rep"), "set_id", "vec_id", "copies", "vector"), "vector-classes", compression="none")
    n = classes.count()
    pairs = _pairs(classes, cosine, window, tile, seed, passes or passes_for(n, cosine, window))
    roots = written(components(pairs, "vector-components"), "vector-roots")
    sizes = roots.groupBy("root").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    tiles = roots.select(F.col("node").alias("rep"), "root").join(sizes, "root").join(classes.select("rep", "copies", "vector"), "rep")
    tiles = tiles.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiles = tiles.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    counts = tiles.select("root", "low", "high", "tile", "rep", "copies", "vector").groupBy("root", "low", "high").applyInArrow(_count(cosine), record(rep="long", n="long"))
    counts = counts.groupBy("rep").agg(F.sum("n").alias("n"))
    named = classes.select("rep", "set_id", "vec_id", "copies").join(roots.withColumnRenamed("node", "rep"), "rep", "left").join(counts, "rep", "left")
    named = written(named.select("set_id", "vec_id", F.coalesce("root", "rep").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-named")
    least = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    named = named.join(least, "root").select("set_id", "n_links", "component_id")
    found = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("set_id")).alias("set_id")).join(named, "set_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))

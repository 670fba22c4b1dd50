"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams are summed by Spark over a bounded, seeded sample of labelled rows; the
log-probability matrix (buckets x languages) has a size fixed by its parameters and is broadcast.
Batches of whole texts are scored as a sparse product: gather the matrix rows of a text's n-grams
and sum them per text.  Texts are lower-cased; everything but letters counts as a space.

Defined cases: a text that is null or has no letter gets `und` and score 0; so does every text if
nothing was learned.  Equal scores go to the alphabetically first language.  Rows with a null
text or language teach nothing.  Repeated rows count as often as they occur.  Columns of the
input that have the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.llm import words as W

UNKNOWN = "und"
MATRIX_BYTES = 64 << 20  # most that is broadcast: 8 bytes for each bucket and language
_SPACE = 32


@dataclass(frozen=True)
class Model:
    """languages ascend; scores[bucket, language] are log probabilities, the last row is zero."""

    languages: tuple[str, ...]
    orders: tuple[int, ...]
    scores: np.ndarray
    prior: np.ndarray


class _Letters:
    table: np.ndarray | None = None

    @classmethod
    def of(cls, points: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        return cls.table[points]


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts with spaces for non-letters; where texts begin; which
    points are letters."""
    column = pc.utf8_lower(pc.fill_null(column, ""))
    offsets = np.concatenate([[0], np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False))]).astype(np.int64)
    points = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _Letters.of(points)
    return np.where(letter, points, np.uint32(_SPACE)), offsets, letter


def _features(points: np.ndarray, offsets: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram at each point; `buckets` where it would reach over the text's end."""
    key = points.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, order):
            key[:-k] = key[:-k] * np.uint64(0x100000001B3) + points[k:]
        key = (key + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        out = ((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % buckets
    for k in range(1, order):
        last = offsets[1:] - k
        out[last[last >= offsets[:-1]]] = buckets
    return out


def fit(
    docs: DataFrame, text: str = "text", label: str = "lang", orders: tuple[int, ...] = (1, 2, 3),
    buckets: int = 1 << 16, docs_per_language: int = 3000, max_languages: int = 1000, seed: int = 17,
) -> Model:
    """Learn from labelled rows.

    Of each language about docs_per_language different whole texts are used (all, if there are no
    more), chosen by a seeded hash of the text; copies of a text are counted as its weight, so they
    neither fill the sample nor push a language out of it.  The class shares come from all rows.
    buckets shrinks where the matrix would outgrow MATRIX_BYTES; more than max_languages labels are
    an error.
    """
    known = docs.select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("lang")).dropna()
    known = known.withColumn("mark", F.xxhash64(F.lit(seed), "text"))
    found = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("mark").alias("texts"))
    found = found.orderBy("lang").limit(max_languages + 1).collect()
    shares = {r.lang: r.n for r in found}
    if len(shares) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not shares:
        return Model((), orders, np.zeros((1, 0), np.float32), np.zeros(0))
    while buckets * 8 * len(shares) > MATRIX_BYTES and buckets > 256:
        buckets //= 2
    below = F.create_map(*[F.lit(x) for r in found for x in (r.lang, min(1.0, docs_per_language / max(1, r.texts)))])
    place = F.pmod(F.col("mark"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = known.where(place < below[F.col("lang")]).groupBy("lang", "mark").agg(F.any_value("text").alias("text"), F.count("*").alias("weight"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in W.sliced(batches, 0):
            langs, weights = np.asarray(batch.column("lang").to_pylist(), object), batch.column("weight").to_numpy()
            for lang in sorted(set(langs)):
                mine = langs == lang
                points, offsets, _ = _points(batch.column("text").filter(pa.array(mine)))
                total, weight = sums.setdefault(lang, np.zeros(buckets + 1, np.int64)), np.repeat(weights[mine], np.diff(offsets))
                for order in orders:
                    total += np.bincount(_features(points, offsets, order, buckets), weight, buckets + 1).astype(np.int64)
        for lang, total in sums.items():
            used = np.flatnonzero(total[:-1])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(total[used])], ["lang", "bucket", "n"])

    def column(rows: pa.Table) -> pa.Table:
        total = np.zeros(buckets, np.int64)
        total[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
        return pa.table({"lang": rows.column("lang").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    counts = sample.select("text", "lang", "weight").mapInArrow(count, "lang string, bucket bigint, n bigint")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = counts.groupBy("lang").applyInArrow(column, "lang string, counts binary").collect()  # a row per language
    languages = tuple(sorted(shares))
    table = np.zeros((buckets, len(languages)))
    for row in counts:
        table[:, languages.index(row.lang)] = np.frombuffer(row.counts, np.int64)
    scores = np.log(table + 0.5) - np.log(table.sum(0) + 0.5 * buckets)
    prior = np.log(np.array([shares[k] for k in languages], float)) - np.log(sum(shares.values()))
    return Model(languages, orders, np.vstack([scores, np.zeros(len(languages))]).astype(np.float32), prior)


def _score(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray]:
    points, offsets, letter = _points(column)
    n, width = len(offsets) - 1, len(model.languages)
    sums = np.zeros((n, width)) + model.prior
    readable = np.zeros(n, bool)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        readable[full] = np.logical_or.reduceat(letter, offsets[full])
    step = max(1 << 12, (1 << 20) // max(1, width))
    for order in model.orders if width else ():
        feature = _features(points, offsets, order, len(model.scores) - 1)
        for low in range(0, len(points), step):
            high = min(low + step, len(points))
            first, last = np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, high, "left")
            some = np.arange(first, last)
            some = some[(offsets[some + 1] > low) & (offsets[some + 1] > offsets[some])]
            sums[some] += np.add.reduceat(model.scores[feature[low:high]], np.maximum(offsets[some], low) - low, axis=0, dtype=np.float64)
    if not width:
        return [UNKNOWN] * n, np.zeros(n)
    best = sums.argmax(1)
    share = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
    return [model.languages[b] if r else UNKNOWN for b, r in zip(best, readable, strict=True)], np.where(readable, share, 0.0)


def predict(
    docs: DataFrame, model: Model, text: str = "text", language: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """The rows of docs with the predicted language and its probability."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    carried = [f for f in docs.schema.fields if f.name not in (language, score)]
    schema = T.StructType([*carried, T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())])
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.sliced(batches, len(names)):
            found, share = _score(sent.value, batch.column(len(names)))
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array(share)], [*names, language, score])

    given = docs.select(*names, F.col(text).cast("string").alias("text "))
    return given.mapInArrow(run, schema)


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text, modulo parts; null ids are."""
    place = F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
    return F.coalesce(place == part, F.lit(True))

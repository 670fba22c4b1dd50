"""LM scoring: log10 probability of whole texts by a causal self-attention model (attention.py)
and, beside it, by unigram counts of words.

Texts are lower-cased (A-Z) and cut into subwords by a public byte-level vocabulary, each word
with the white space before it on its own.  Subwords are made once and written as 16-bit numbers.

What the model knows comes from all training texts.  Words are counted by blocks of the hash
space, so the vocabulary is nowhere gathered.  Subwords are counted, which also gives them their
input rows and classes, and so are pairs of subword and next class.  The attention head takes
ROUNDS steps of Adam, in which each training text takes part once and as a whole.  Which step that
is follows from a hash of doc_id, so training does not depend on how texts are dealt to tasks.  The
gradient of a step is summed over all its texts: in tasks, in groups of GROUP tasks, these in
groups again, and the rest on the driver.

Defined cases: a null or empty text is one end token.  Without training texts the model falls back
to its smoothing and N is 0.  Rows without doc_id are not learned from.  Repeated rows count each.
For subwords (not for words) a NUL character counts as \\x01.  Only doc_id and the text are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.llm import attention as A
from dockhand.llm import blocks as B
from dockhand.llm import words as W
from dockhand.llm.store import record, written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_PIECE_BYTES = 4096  # longer words are cut
_SLICE_BYTES = 4 << 20  # of text cut into subwords at once; a longer text is a slice of its own
_NO_NUL = np.arange(256, dtype=np.uint8)
_NO_NUL[0] = 1

ROUNDS = 12
HELD_OUT, COUNTS = -1, -2  # instead of a round: texts that are not learned from, and rows of counts
GROUP = 32  # gradients added up by one task

COUNTED = record(batch="long", block="long", found="binary", total="long", distinct="long")
TOKENS = record(batch="long", turn="int", payload="binary", code="long", n="long")
SUMS = record(part="long", targets="long", gradient="binary")
SCORED = record(batch="long", place="int", score="double")
RESULT = record(batch="long", place="int", doc_id="long", train="string", n_tokens="long", n_known="long", base="double")


@cache
def tokenizer(path: str) -> tuple[tiktoken.Encoding, int, int]:
    """The encoding, the subword that stands for NUL, and the number of subwords."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pattern = r"[^\x00]+|\x00"  # subwords() gives it pieces that are cut already
    return tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), ranks[b"\x00"], max(ranks.values()) + 1


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = W.utf8(column)
    return W.mapped(data, W.LOWER), offsets


def _sorted_union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = np.sort(np.concatenate([a, b]), kind="stable")  # a merge, where both are sorted
    return both[np.diff(both, prepend=-1) > 0]


class Known:
    """Subwords of short pieces that were met before: those of keys[i] are the count[i] ids from
    first[i].  When it is full no more are taken in, which costs time only."""

    MOST, BYTES = 250_000, 32  # pieces, and bytes of one

    def __init__(self) -> None:
        self.keys, self.first, self.count, self.ids = np.zeros(0, np.uint64), *np.zeros((2, 0), np.int64), np.zeros(0, np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sorted keys are known, and where these are."""
        at = np.searchsorted(self.keys, keys)
        found = at < len(self.keys)
        found[found] = self.keys[at[found]] == keys[found]
        return found, at[found]

    def add(self, keys: np.ndarray, ids: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        room = self.MOST - len(self.keys)
        if room <= 0:
            return
        keys, first, count = keys[:room], first[:room], count[:room]
        begin = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, ids[W.ranges(first, count)]])
        every = np.concatenate([self.keys, keys])
        order = np.argsort(every)
        self.keys, self.first, self.count = every[order], np.concatenate([self.first, begin])[order], np.concatenate([self.count, count])[order]


def _encoded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, path: str, known: Known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subwords of pieces with distinct sorted keys: ids, and for each piece the first of its own and how many."""
    found, at = known.find(keys)
    new, raw = np.flatnonzero(~found), data.tobytes()
    text = b"\x00".join([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]).decode("utf-8", "replace")
    encoding, nul, _ = tokenizer(path)
    ids = encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
    parts = np.flatnonzero(ids == nul)
    begin = np.concatenate([[0], parts + 1])[: len(new)]
    length = np.concatenate([parts, [len(ids)]])[: len(new)] - begin
    first, count = np.empty((2, len(keys)), np.int64)
    first[found], count[found] = known.first[at], known.count[at]
    first[new], count[new] = begin + len(known.ids), length
    every, short = np.concatenate([known.ids, ids]), np.flatnonzero(ends[new] - starts[new] <= known.BYTES)
    known.add(keys[new[short]], ids, begin[short], length[short])
    return every, first, count


def subwords(data: np.ndarray, offsets: np.ndarray, words: W.Words, path: str, known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Subwords of all texts in a row, and how many each text has.  Each distinct piece (a word
    with the space before it, or space at the end) is encoded once, and not at all if it is known."""
    data = W.mapped(data, _NO_NUL)
    points = _sorted_union(offsets, words.ends)
    long = np.flatnonzero(np.diff(points) > _PIECE_BYTES)
    if len(long):
        more = np.concatenate([np.arange(points[i] + _PIECE_BYTES, points[i + 1], _PIECE_BYTES) for i in long])
        for _ in range(3):  # to the first byte of a character
            more = more - ((data[more] & 0xC0) == 0x80)
        points = _sorted_union(points, more)
    starts, ends = points[:-1], points[1:]
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
    keys, kind = W.distinct(W.hash_pieces(data, starts, ends))
    example = np.empty(len(keys), np.int64)
    example[kind] = np.arange(len(kind))
    ids, first, count = _encoded(data, starts[example], ends[example], keys, path, known or Known())
    first, count = first[kind], count[kind]
    sums = np.concatenate([[0], np.cumsum(count)])
    per_text = np.diff(sums[np.searchsorted(starts, offsets)])
    return ids[W.ranges(first, count)], per_text


def _index(blocks: int):
    """Distinct words of each batch with their counts in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                table = B.unseal(payload)
                words = W.cut(*_lowered(table.column("text")))
                keys, kind = W.distinct(words.hashes())
                train = table.column("train").to_numpy()[words.owners()]
                counts = np.bincount(kind[train], minlength=len(keys)).astype(np.uint32)
                yield from B.send(number, keys, blocks, lambda part, counts=counts: B.planes(counts[part]))

    return run


def _resolve(rows: pa.Table) -> pa.Table:
    """Counts of the whole corpus for each batch's words; the block's totals with its first row."""
    keys = [B.received(x) for x in rows.column("keys").to_pylist()]
    counts = np.concatenate([B.unplanes(x, np.uint32) for x in rows.column("values").to_pylist()]).astype(np.int64)
    order, head, group = B.grouped(keys)
    sums = np.add.reduceat(counts[order], head)
    every, ends = sums[group], np.cumsum([len(k) for k in keys])
    found = [B.planes(every[e - len(k) : e]) for k, e in zip(keys, ends, strict=True)]
    rest = [0] * (rows.num_rows - 1)
    return pa.table({
        "batch": rows.column("batch"), "block": rows.column("block"), "found": pa.array(found, pa.binary()),
        "total": pa.array([int(sums.sum()), *rest], pa.int64()), "distinct": pa.array([int((sums > 0).sum()), *rest], pa.int64()),
    })


def _tokenize(path: str):
    """The subwords of each batch by round, and the counts of those in a task's training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boundary = tokenizer(path)[2]
        sums, known = np.zeros(boundary + 1, np.int64), Known()
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                table = B.unseal(payload)
                parts = [(np.zeros(0, np.int32), np.zeros(0, np.int64))]
                for part in W.sliced(table.select(["text"]).to_batches(), 0, _SLICE_BYTES):
                    data, offsets = _lowered(part.column(0))
                    parts.append(subwords(data, offsets, W.cut(data, offsets), path, known))
                tokens, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
                train = table.column("train").to_numpy()
                sums += np.bincount(tokens[np.repeat(train, counts)], minlength=boundary + 1)
                sums[boundary] += train.sum()
                turns = np.where(train, (W.mix(B.ids(table).astype(np.uint64)) % np.uint64(ROUNDS)).astype(np.int64), HELD_OUT)
                begin = np.cumsum(counts) - counts
                for turn in np.unique(turns).tolist():
                    places = np.flatnonzero(turns == turn)
                    packed = _packed(tokens[W.ranges(begin[places], counts[places])], counts[places], places)
                    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([turn], pa.int32()), pa.array([packed], pa.binary()), *[pa.nulls(1, pa.int64())] * 2], TOKENS.names)
        pa.default_memory_pool().release_unused()  # the worker stays and so would its memory
        used = np.flatnonzero(sums)
        turn = pa.array(np.full(len(used), COUNTS, np.int32))
        yield pa.RecordBatch.from_arrays([pa.nulls(len(used), pa.int64()), turn, pa.nulls(len(used), pa.binary()), pa.array(used), pa.array(sums[used])], TOKENS.names)

    return run


_CODEC = pa.Codec("zstd")


def _packed(tokens: np.ndarray, counts: np.ndarray, places: np.ndarray) -> bytes:
    kind = np.uint16 if not len(tokens) or tokens.max() < 1 << 16 else np.uint32
    head = np.array([len(counts), len(tokens), np.dtype(kind).itemsize], np.int64).tobytes()
    body = counts.astype(np.int64).tobytes() + places.astype(np.int32).tobytes() + tokens.astype(kind).tobytes()
    return head + _CODEC.compress(body, asbytes=True)


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subwords, how many each text has, and the places of the texts in their batch."""
    texts, n, width = np.frombuffer(payload, np.int64, 3).tolist()
    body = _CODEC.decompress(payload[24:], 12 * texts + n * width, asbytes=True)
    tokens = np.frombuffer(body, f"u{width}", n, 12 * texts)
    return tokens, np.frombuffer(body, np.int64, texts), np.frombuffer(body, np.int32, texts, 8 * texts)


def _blocks(payload: bytes, path: str):
    tokens, counts, _ = _unpacked(payload)
    return A.blocked(tokens, counts, tokenizer(path)[2])


def _count(layout: A.Layout, path: str):
    """(row, next class) pairs of the training texts of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(A.ROWS * A.CLASSES, np.int64)
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                x, y, _, _ = _blocks(payload, path)
                x, y = x[y >= 0], y[y >= 0]
                sums += np.bincount(layout.row[x] * A.CLASSES + layout.cls[y], minlength=len(sums))
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["code", "n"])

    return run


def _gradient(model, path: str):
    """The sum of a task's gradients in one round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, targets = 0.0, 0
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                x, y, first, _ = _blocks(payload, path)
                found, seen = model.value.gradient(x, None, y, first)
                total, targets = total + found, targets + seen
        if targets:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([targets]), pa.array([total.tobytes()], pa.binary())], SUMS.names)

    return run


def _add_up(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.float64) for x in rows.column("gradient").to_pylist())
    targets = int(rows.column("targets").to_numpy().sum())
    return pa.table([rows.column("part").slice(0, 1), pa.array([targets]), pa.array([total.tobytes()], pa.binary())], SUMS.names)


def fit(tokens: DataFrame, path: str, seed: int) -> A.Model:
    """The model of all training texts, from the table of subwords."""
    spark, boundary = tokens.sparkSession, tokenizer(path)[2]
    known = np.zeros(boundary + 1)
    rows = tokens.where(F.col("turn") == COUNTS).groupBy("code").agg(F.sum("n").alias("n")).toArrow()  # the vocabulary at most
    known[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    layout = A.Layout.of(known)
    payloads = tokens.where("turn >= 0").select("turn", "payload")
    pairs = np.zeros(A.ROWS * A.CLASSES)
    rows = payloads.select("payload").mapInArrow(_count(layout, path), record(code="long", n="long")).groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    pairs[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    model, adam = A.Model.start(layout, known, pairs.reshape(A.ROWS, A.CLASSES), seed), A.Adam(ROUNDS)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        sums = payloads.where(F.col("turn") == turn).select("payload").mapInArrow(_gradient(shared, path), SUMS)
        for _ in range(2):
            sums = sums.withColumn("part", F.floor(F.col("part") / GROUP)).groupBy("part").applyInArrow(_add_up, SUMS)
        found = sorted(sums.collect(), key=lambda r: r["part"])  # a row for GROUP * GROUP tasks
        if found:
            model = adam.step(model, sum(np.frombuffer(r["gradient"], np.float64) for r in found) / sum(r["targets"] for r in found))
        shared.unpersist()
    return model


def _base(blocks: int, tokens_in_all: int, distinct: int, ends: int):
    """Unigram scores of each batch's texts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        size = np.log10(tokens_in_all + distinct + 1)
        schema = pa.schema([("batch", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("train", pa.string()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64())])
        parts = [schema.empty_table()]
        for number, payload in zip(left.column("batch").to_pylist(), left.column("payload"), strict=True):
            table = B.unseal(payload)
            words = W.cut(*_lowered(table.column("text")))
            keys, kind = W.distinct(words.hashes())
            edges, known = B.cuts(keys, blocks), np.zeros(len(keys), np.int64)
            for block, found in zip(right.column("block").to_pylist(), right.column("found").to_pylist(), strict=True):
                known[edges[block] : edges[block + 1]] = B.unplanes(found, np.int64)
            owner, texts = words.owners(), table.num_rows
            base = np.bincount(owner, np.log10(known + 1.0)[kind], texts) + np.log10(ends + 1.0) - (words.counts + 1) * size
            n_known = np.bincount(owner, (known > 0)[kind], texts).astype(np.int64) + (ends > 0)
            columns = [pa.array([number] * texts, pa.int64()), pa.array(np.arange(texts), pa.int32()), table.column("doc_id"), table.column("train").cast(pa.string()), pa.array(words.counts + 1), pa.array(n_known), pa.array(base)]
            parts.append(pa.table(columns, schema=schema))
        return pa.concat_tables(parts)

    return run


def _score(model, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boundary = tokenizer(path)[2]
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens, counts, places = _unpacked(payload)
                x, y, first, starts = A.blocked(tokens, counts, boundary)
                found = model.value.log_probabilities(x, y, first).sum(1)
                score = np.add.reduceat(found, starts[:-1]) / np.log(10) if len(found) else found
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(score), pa.int64()), pa.array(places), pa.array(score)], SCORED.names)

    return run


def score(
    docs: DataFrame, train: Column, text: str = "text", path: str = VOCABULARY, seed: int = 11,
    batch_bytes: int = B.BATCH_BYTES, block_keys: int = B.BLOCK_KEYS,
) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score for every row.

    train tells which rows to learn from; rows without doc_id never are."""
    train = F.coalesce(train & F.col("doc_id").isNotNull(), F.lit(False))
    docs = docs.withColumn("text", F.col(text).cast("string"))
    batches = B.pack(docs, "text", {"train": train}, batch_bytes)
    blocks = B.count_blocks(batches, block_keys)
    keys = batches.mapInArrow(_index(blocks), B.KEYS)
    found = written(keys.groupBy("block").applyInArrow(_resolve, COUNTED), "word-counts")
    totals = found.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    ends = docs.where(train).count()
    n, v = (totals.n or 0) + ends, (totals.v or 0) + (ends > 0)
    tokens = written(batches.select("batch", "payload").mapInArrow(_tokenize(path), TOKENS), "subwords", compression="none", by="turn")
    model = docs.sparkSession.sparkContext.broadcast(fit(tokens, path, seed))
    scored = tokens.where(F.col("turn") != COUNTS).select("batch", "payload").mapInArrow(_score(model, path), SCORED)
    given = batches.groupBy("batch").cogroup(found.select("batch", "block", "found").groupBy("batch"))
    rows = given.applyInArrow(_base(blocks, n, v, ends), RESULT).join(scored, ["batch", "place"])
    return rows.select(
        "doc_id", (F.col("train") == "true").alias("train"), "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )

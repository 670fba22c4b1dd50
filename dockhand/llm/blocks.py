"""Look-ups of very many 64-bit keys by blocks.

Documents are packed into batches of bounded size and written once.  Each batch sorts its keys and
sends them, every key once, to blocks: ranges of the key space, as many as the corpus needs to
keep a block small.  A block sees each key at most once per batch, however often it occurs, so no
key makes a block hot.  What the block finds goes back to the batches, one small row for each
batch and block.  Keys travel as byte planes of their differences, which the shuffle's own
compression shrinks to the bits that differ.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm import words as W
from dockhand.llm.store import record, written

BATCH_BYTES = 8 << 20  # of text in a batch; a longer document is a batch of its own
BLOCK_KEYS = 2_000_000  # aimed at in a block
NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id and comes after all others

PACKED = record(batch="long", n_words="long", payload="binary")
KEYS = record(block="long", batch="long", keys="binary", values="binary")
FOUND = record(batch="long", block="long", found="binary")


def planes(values: np.ndarray) -> bytes:
    """Fixed-width integers, all first bytes, then all second ones and so on."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not data:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def pack(docs: DataFrame, text: str = "text", extra: dict[str, object] | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Written batches of (doc_id, text, extra columns), in the order of doc_id."""
    given = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"),
        *[c.alias(k) for k, c in (extra or {}).items()],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0
        for batch in batches:
            ends = np.cumsum(W.text_bytes(batch.column(1)))
            low = 0
            while low < batch.num_rows:
                before = ends[low - 1] if low else 0
                high = int(np.searchsorted(ends, before + max(1, batch_bytes - size)))
                high = min(max(high, low + 1), batch.num_rows)
                held.append(batch.slice(low, high - low))
                size += int(ends[high - 1] - before)
                low = high
                if size >= batch_bytes:
                    yield seal(first + number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield seal(first + number, held)

    return written(given.mapInArrow(run, PACKED), "batches", compression="none")


def seal(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).sort_by([("doc_id", "ascending")])  # nulls last
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    n = W.count(*W.utf8(table.column("text")))
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
        PACKED.names,
    )


def unseal(payload: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(payload.as_buffer()).read_all().combine_chunks()


def ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(NO_ID).to_numpy()


def count_blocks(batches: DataFrame, block_keys: int = BLOCK_KEYS) -> int:
    """Blocks for about one key per word."""
    total = batches.agg(F.sum("n_words")).first()[0] or 0
    return max(1, math.ceil(total / block_keys))


def cuts(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Where each block begins in sorted keys; one more for the end."""
    edges = np.array([(b << 64) // blocks for b in range(blocks)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def send(number: int, keys: np.ndarray, blocks: int, values: Callable[[slice], bytes]) -> Iterator[pa.RecordBatch]:
    """Rows of KEYS for the sorted distinct keys of one batch."""
    edges = cuts(keys, blocks)
    used = np.flatnonzero(np.diff(edges))
    rows: list[list] = [[], [], [], []]
    for b in used:
        part = slice(int(edges[b]), int(edges[b + 1]))
        for column, x in zip(rows, (int(b), number, planes(np.diff(keys[part], prepend=np.uint64(0))), values(part)), strict=True):
            column.append(x)
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], KEYS.names)


def received(values: bytes) -> np.ndarray:
    return np.cumsum(unplanes(values, np.uint64), dtype=np.uint64)


def grouped(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of all keys, where each distinct one begins in it, and the group of each key."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    head = np.ones(len(ordered), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    group = np.empty(len(ordered), np.int64)
    group[order] = np.cumsum(head) - 1
    return order, np.flatnonzero(head), group


def answer(rows: pa.Table, found: list[bytes]) -> pa.Table:
    return pa.table({"batch": rows.column("batch"), "block": rows.column("block"), "found": pa.array(found, pa.binary())})

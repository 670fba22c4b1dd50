"""Target tables as Parquet parts plus a log of committed parts.

A run writes its part first and the log entry last, so readers see all of a run or nothing,
and a run that is repeated after a failure finds its own entry and changes nothing.  The log
also holds the fields of the table; who comes with other ones is refused.

A table with a key is laid out in buckets of the key's hash.  The log tells which buckets a part
holds and whether it adds to them or takes the place of what they held, so a load reads and
rewrites only the buckets of its own keys.  Rows whose key is incomplete never meet others; they
go to a bucket that is only added to.  A table of an earlier layout, without buckets, is read as
it is and goes into buckets when it is replaced.

Several writers may publish at once: a log entry is a file named by its version that must not
exist yet, so one of them gets the version and the others take the next one.  A run whose rows
follow from what it has read is refused if one of its buckets has changed since, and can be
repeated; others just add their rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.session import publish_file, small_table

_LOG = "version int, run_id string, action string, part string, fields string, buckets int, touched array<int>"
APPEND, REPLACE, MERGE = "append", "replace", "merge"
PART_OF = "~"  # between the name of a run and that of a part of it
BUCKET = "_bucket"
BUCKETS = 32  # of a new table
KEYLESS = -1  # bucket of rows with an incomplete key


class ConcurrentChange(RuntimeError):
    """Another run has changed what this one was about to replace."""


@dataclass
class _State:
    """What a reader of the table sees: whole parts, and parts by bucket."""

    buckets: int | None = None
    whole: list[str] = field(default_factory=list)
    parts: dict[int, list[str]] = field(default_factory=dict)
    versions: dict[int, int] = field(default_factory=dict)  # last entry that touched a bucket

    def take(self, entry) -> None:
        if entry["action"] == REPLACE:
            self.whole, self.parts = [], {}
        if entry["buckets"] is None:
            self.whole.append(entry["part"])
            return
        self.buckets = entry["buckets"]
        for b in entry["touched"]:
            if entry["action"] == MERGE and b != KEYLESS:
                self.parts[b] = []
            self.parts.setdefault(b, []).append(entry["part"])
            self.versions[b] = entry["version"]


class SnapshotTable:
    def __init__(
        self, spark: SparkSession, root: str, name: str, schema: T.StructType, key: Iterable[str] = (), buckets: int = BUCKETS
    ) -> None:
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{name}"
        self.schema = schema
        self.key = list(key)
        self._new_buckets = buckets

    # --- log -----------------------------------------------------------------------

    def _entries(self) -> list:
        try:
            log = self.spark.read.schema(_LOG).json(f"{self.path}/log")
            entries = sorted(log.collect(), key=lambda e: e["version"])
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        for entry in entries:
            if entry["fields"] not in (None, self.schema.simpleString()):
                raise ValueError(f"table holds other fields: {entry['fields']}")
        return entries

    def state(self, before_run: str | None = None) -> _State:
        """What the table holds now, or held before a run."""
        state = _State()
        for entry in self._entries():
            if entry["run_id"] == before_run:
                break
            state.take(entry)
        return state

    def has_run(self, run_id: str) -> bool:
        return any(e["run_id"] == run_id for e in self._entries())

    def parts_of(self, run_id: str) -> list[str]:
        """Names of the parts of a run that was split, as far as they are there (see PART_OF)."""
        return [e["run_id"] for e in self._entries() if e["run_id"].startswith(run_id + PART_OF)]

    def note_path(self, run_id: str) -> str:
        """Where a run may leave what it did, before it is published."""
        return f"{self.path}/notes/{run_id}"

    # --- read ----------------------------------------------------------------------

    def read(self, before_run: str | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Current rows, or the rows as they were before a run; of some buckets or of all.

        Parts without buckets are always read."""
        return self.rows(self.state(before_run), buckets)

    def rows(self, state: _State, buckets: Iterable[int] | None = None) -> DataFrame:
        chosen = state.parts if buckets is None else set(buckets) & state.parts.keys()
        paths = [f"{self.path}/{p}" for p in state.whole]
        paths += [f"{self.path}/{p}/{BUCKET}={b}" for b in sorted(chosen) for p in state.parts[b]]
        if not paths:
            return small_table(self.spark, [], self.schema)
        reader = self.spark.read.schema(self.schema).option("recursiveFileLookup", True)
        return reader.parquet(*paths).select(*self.schema.names)

    # --- write ---------------------------------------------------------------------

    def part_path(self, run_id: str) -> str:
        return f"{self.path}/parts/{run_id}"

    def bucket(self, buckets: int | None = None) -> Column:
        """Bucket of a row."""
        hashed = F.pmod(F.xxhash64(*self.key), F.lit(buckets or self._new_buckets)).cast("int")
        complete = F.concat(*[F.col(k).cast("string") for k in self.key]).isNotNull()
        return F.when(complete, hashed).otherwise(F.lit(KEYLESS))

    def write_part(self, rows: DataFrame, run_id: str, add: bool = False) -> DataFrame:
        """Write the part of a run, or add to it; it stays invisible until :meth:`publish`."""
        path = self.part_path(run_id)
        if not self.has_run(run_id):
            mode = "append" if add else "overwrite"
            if self.key:
                # Few files per bucket; a large bucket is split again.
                placed = rows.withColumn(BUCKET, self.bucket(self._layout()))
                placed.hint("rebalance", BUCKET).write.mode(mode).partitionBy(BUCKET).parquet(path)
            else:
                rows.write.mode(mode).parquet(path)
        return self.spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(path)

    def _layout(self) -> int:
        return self.state().buckets or self._new_buckets

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Buckets that the keys of some rows fall into (a number per bucket at most)."""
        found = rows.select(self.bucket(self._layout()).alias(BUCKET)).distinct().collect()
        return sorted(r[BUCKET] for r in found if r[BUCKET] != KEYLESS)

    @staticmethod
    def touched(part: DataFrame) -> list[int]:
        """Buckets that a written part holds."""
        mark = f"/{BUCKET}="
        found = (unquote(f) for f in part.inputFiles())
        return sorted({int(f.rsplit(mark, 1)[1].split("/", 1)[0]) for f in found if mark in f})

    def merge(self, incoming: DataFrame, run_id: str) -> None:
        """Rows that replace those of the same key, at most one per key; only the buckets of
        incoming keys are read and rewritten."""
        if self.has_run(run_id):
            return
        state = self.state()
        part = self.write_part(incoming, run_id)
        touched = self.touched(part)
        if state.whole:  # an earlier layout
            before, action = self.rows(state), REPLACE
        else:
            before, action = self.rows(state, [b for b in touched if b != KEYLESS]), MERGE
        kept = before.join(part.select(*self.key), self.key, "left_anti").select(*self.schema.names)
        whole = self.write_part(kept, run_id, add=True)
        self.publish(run_id, action, self.touched(whole) if action == REPLACE else touched, state)

    def publish(self, run_id: str, action: str, touched: list[int] | None = None, seen: _State | None = None) -> None:
        """Make the part of a run visible.  ``seen`` is the state that its rows follow from."""
        part = f"parts/{run_id}"
        if self.key and touched is None:
            reader = self.spark.read.schema(self.schema).option("recursiveFileLookup", True)
            touched = self.touched(reader.parquet(f"{self.path}/{part}"))
        while True:
            entries = self._entries()
            if any(e["run_id"] == run_id for e in entries):
                return
            state = _State()
            for e in entries:
                state.take(e)
            if seen is not None:
                self._check(state, seen, action, touched or [])
            version = entries[-1]["version"] + 1 if entries else 1
            entry = {
                "version": version, "run_id": run_id, "action": action, "part": part, "fields": self.schema.simpleString(),
                "buckets": (state.buckets or self._new_buckets) if self.key else None, "touched": touched if self.key else None,
            }
            if publish_file(self.spark, f"{self.path}/log/{version:010d}.json", json.dumps(entry)):
                return

    @staticmethod
    def _check(state: _State, seen: _State, action: str, touched: list[int]) -> None:
        changed = {b for b, v in state.versions.items() if v != seen.versions.get(b)} - {KEYLESS}
        if state.whole != seen.whole or (changed if action == REPLACE else changed & set(touched)):
            raise ConcurrentChange("another run has changed the same rows; repeat this one")

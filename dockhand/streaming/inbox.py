"""Continuous inbox: new files run through the same pipeline in micro-batches.

The file source hands a file to one batch as a whole, so verdicts per file are sound.  The
first batches hold the files that are already there.  A batch that is retried after a failure
carries the run id it had before and changes nothing it has already written.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockhand.plans.pipeline import REFUSED_NAME, ImportEngine
from dockhand.session import small_table
from dockhand.sources import delivery

UNFINISHED = "Datei nicht lesbar: sie wird noch geschrieben"

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _not_reported(engine: ImportEngine, name: str, run_id: str, paths: list[str]) -> list[str]:
    """Of the files that no scan shows those without a result so far, or with one of this very
    batch, if it is retried.  What is new is noted beside the tables."""
    if not paths:
        return []
    log = f"{engine.store}/unread_files/{name}"
    now = small_table(engine.spark, [(p,) for p in paths], "path string")
    try:  # of the history only what concerns these files reaches the driver
        known = {r["path"]: r["run_id"] for r in engine.spark.read.parquet(log).join(now, "path", "left_semi").collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        known = {}
    new = [(p, run_id) for p in paths if p not in known]
    if new:
        small_table(engine.spark, new, "path string, run_id string").write.mode("append").parquet(log)
    return [p for p in paths if known.get(p, run_id) == run_id]


def _noted(engine: ImportEngine, name: str, which: Column, paths: list[str] | None = None) -> list[str]:
    """Paths of the log of :func:`_not_reported` for which a condition holds, of some or of all."""
    try:
        rows = engine.spark.read.parquet(f"{engine.store}/unread_files/{name}").filter(which)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if paths is not None:
        rows = rows.join(small_table(engine.spark, [(p,) for p in paths], "path string"), "path", "left_semi")
    return [r["path"] for r in rows.select("path").distinct().collect()]


def settled(
    look: Callable[[], dict[str, tuple[int, int]]], paths: list[str], settle: float, patience: float,
    now: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep,
) -> set[str]:
    """Wait until none of the files has changed for ``settle`` seconds; those that still do at the end
    of the patience.  ``look`` gives time of change (in milliseconds) and length by path; a path that
    is not listed any more has nothing to wait for.

    A file is done when two looks ``settle`` apart agree, whatever the clock of the store says; one
    that is older than that by its own time is done at once, unless it is empty."""
    begun, seen = now(), {}
    waiting = {_plain_path(p) for p in paths}
    names = {_plain_path(p): p for p in paths}
    while waiting:
        at, state = now(), look()
        for path in list(waiting):
            current = state.get(path)
            if current is None:
                waiting.discard(path)
                continue
            since, before = seen.get(path, (at, None))
            if before != current:
                since = at
            seen[path] = (since, current)
            old = current[1] > 0 and at - current[0] / 1000 >= settle
            if old or at - since >= settle:
                waiting.discard(path)
        if not waiting or at - begun >= patience:
            break
        sleep(min(settle / 2, 1.0))
    return {names[p] for p in waiting}


def _plain_path(path: str) -> str:
    """As the listing writes paths: without escapes."""
    return unquote(delivery.plain(path))


def stream_inbox(
    engine: ImportEngine,
    inbox: str,
    checkpoint: str,
    name: str = "inbox",
    max_files_per_batch: int | None = None,
    available_now: bool = False,
    interval: str = "10 seconds",
    source: str | None = None,
    archive_folder: str | None = None,
    settle: float | None = None,
    patience: float = 600,
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and ends.

    Producers should move finished files into the inbox: the source takes a file as soon as it
    appears.  If they write into it, ``settle`` says for how many seconds a file must not have
    changed; a batch then waits for its files, also for those that are empty yet.  Files that still
    change after ``patience`` seconds are refused.  With ``archive_folder`` Spark moves completed
    files there.
    """
    # The stream only carries names; a batch then reads its files like any others.
    reader = engine.spark.readStream.format("binaryFile").schema(_FILES)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if archive_folder is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_folder)
    # Only files of the folder itself, not of folders in it.
    names = reader.option("recursiveFileLookup", True).load(inbox).select("path")

    def process(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{name}-{batch_id}"
        listed = [r["path"] for r in batch.select("path").distinct().collect()]
        unfinished: set[str] = set()
        if settle:
            # The source has passed over files that were empty, so those that fill now are taken here.
            blank = delivery.unread_files(engine.spark, inbox)[0]
            look = lambda: delivery.changes(engine.spark, inbox)
            unfinished = settled(look, listed + blank, settle, patience)
            state = look()
            filled = [p for p in blank if p not in unfinished and state.get(_plain_path(p), (0, 0))[1]]
            log = f"{name}-filled"
            filled = {*_not_reported(engine, log, run_id, filled), *_noted(engine, log, F.col("run_id") == run_id)}
            before = {_plain_path(p) for p in _noted(engine, log, F.col("run_id") != run_id, [delivery.plain(p) for p in listed])}
            known = {_plain_path(p) for p in listed}
            listed = [p for p in listed if _plain_path(p) not in before] + sorted(unquote(p) for p in filled if _plain_path(p) not in known)
        listed = [p for p in listed if p not in unfinished]
        found = delivery.open_files(engine.spark, inbox, listed)
        empty, hidden = (_not_reported(engine, name, run_id, x) for x in delivery.unread_files(engine.spark, inbox))
        empty = [p for p in empty if p not in unfinished]
        refused = {p: REFUSED_NAME for p in hidden} | dict.fromkeys(sorted(unfinished), UNFINISHED)
        paths = sorted([*found.paths, *empty], key=lambda p: p.rsplit("/", 1)[-1])
        if paths or refused:
            own = engine.at(datetime.now())
            prepared = own.prepare_files(found, paths, source=source, run_id=run_id, refused=refused)
            own.commit(prepared)
            prepared.release()

    writer = names.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()

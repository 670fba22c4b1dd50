"""The import pipeline: classify, validate, map, load, audit, for a whole inbox at once.

``prepare`` has no effect on the targets; ``commit`` writes.  The steps exchange written
working tables, so a lost executor costs the running step only, and the driver sees per-file
facts at most, never data rows.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.catalog import Catalog, SourceDef, refused_patterns
from dockhand.functions.text import file_name
from dockhand.operators import audit, classify, load, report, validate
from dockhand.operators.mapping import preview, target_columns
from dockhand.operators.tables import APPEND, PART_OF, ConcurrentChange, SnapshotTable
from dockhand.plans.isolate import isolate, message
from dockhand.session import bounded_broadcast, configure, new_work_folder, remove_folder, small_table
from dockhand.sources import archive, delivery, quoting
from dockhand.sources.encoding import decode_as, decode_by, effective_encoding

logger = logging.getLogger(__name__)

# Final status of a file.
LOADED = "geladen"
INVALID = "abgelehnt_ungueltig"
KEY_CONFLICT = "abgelehnt_pk_konflikt"
LOAD_ERROR = "abgelehnt_ladefehler"
# Added here: the content of the file was loaded before.
REPEATED = "abgelehnt_wiederholt"

# Reasons of refusals.
REFUSED_NAME = "Datei nicht lesbar: Name beginnt mit '_'"
REFUSED_ARCHIVE = "Archiv nicht lesbar: {}"
UNREADABLE_REASON = "Datei nicht lesbar: Kodierung {} passt nicht"
BROKEN_FILE = "Datei nicht lesbar: {}"
LOAD_FAILED = "Fehler beim Laden: {}"

# With more matched sources than this, lines are first written apart by source; up to it,
# scanning the landing table once per source is cheaper than writing it a second time.
SCANS_BEFORE_ROUTING = 3
# Jobs of different sources run side by side, so a small one does not leave executors idle.
PARALLEL_SOURCES = 4
# A load starts anew if another run has changed the buckets it had read.
LOAD_ATTEMPTS = 5


class LandingFailed(RuntimeError):
    """The lines of a delivery could not be written; the cause tells why."""


@dataclass(frozen=True)
class Prepared:
    """Result of the side-effect-free half of a run."""

    run_id: str
    folder: str
    files: DataFrame  # one row per delivered file
    ranking: DataFrame | None  # (file, source, score, ko_reason, rank, place)
    decisions: DataFrame  # one row per file: source, score, decision, category, reason
    outcome: DataFrame  # decisions plus row counts and validation verdict
    sources: tuple[SourceDef, ...]  # sources that files were assigned to
    spark: SparkSession
    pieces: DataFrame | None = None  # lines of records too long for one value
    unpacked: str | None = None  # folder of what archives were expanded to

    def release(self) -> None:
        """Remove the working tables of the run.  What :meth:`ImportEngine.commit` wrote and returned
        stays; the frames of this object can't be read any more."""
        for folder in (self.folder, self.unpacked):
            if folder is not None:
                remove_folder(self.spark, folder)

    def staged(self, source: SourceDef) -> DataFrame:
        schema = T.StructType(
            [
                T.StructField("file", T.StringType()),
                T.StructField("file_seq", T.IntegerType()),
                T.StructField("nr", T.LongType()),
                T.StructField("n_errors", T.IntegerType()),
                T.StructField("overflow", T.BooleanType()),
                T.StructField("cells", T.ArrayType(T.StringType())),
            ]
            + source.target_schema().fields
            + [T.StructField("bad", T.BooleanType())]
        )
        return self.spark.read.schema(schema).parquet(f"{self.folder}/staged/{source.name}")

    def good(self, source: SourceDef) -> DataFrame:
        """Typed rows without errors: (file, file_seq, nr, *target fields)."""
        rows = self.staged(source).filter(~F.col("bad"))
        return rows.select("file", "file_seq", "nr", *source.target_fields())

    def bad(self, source: SourceDef) -> DataFrame:
        return self.staged(source).filter("bad").select("file", "nr", "cells")

    def errors(self, sources: Iterable[SourceDef] | None = None) -> DataFrame:
        """All findings, of all sources or of some."""
        none = small_table(
            self.spark, [], "file string, nr bigint, position int, column string, value string, "
            "code string, reason string",
        )
        return reduce(
            DataFrame.unionByName,
            [validate.errors(self.bad(s), s) for s in (self.sources if sources is None else sources)],
            none,
        )

    def quarantine(self) -> DataFrame:
        """Bad rows of partially loaded sources with their reasons."""
        none = small_table(
            self.spark, [], "file string, zeile_nr bigint, fehler_grund string, original_zeile string"
        )
        parts = [validate.quarantine(self.bad(s), s) for s in self.sources if s.partial]
        return reduce(DataFrame.unionByName, parts, none)

    def preview(self, source: SourceDef, rows: int = 5) -> DataFrame:
        return preview(self.good(source), source.target_fields(), rows)


class ImportEngine:
    """Runs deliveries against a catalog; ``store`` holds the tables it writes."""

    def __init__(
        self,
        spark: SparkSession,
        catalog: Catalog,
        store: str,
        load_time: datetime | None = None,
        user_mode: str = "batch",
        jdbc: dict[str, str] | None = None,
        checked: dict[str, list[str]] | None = None,
        refuse_repeats: bool | None = None,
    ) -> None:
        """``refuse_repeats``: whether a file whose content was loaded before is refused.  If not
        said, files for tables without a key are: a key settles repeated rows, without one they
        would double."""
        self.spark = configure(spark)
        # Sources whose patterns the JVM refuses are left out; they don't stop the others.
        self.refused = refused_patterns(self.spark, catalog.values()) if checked is None else checked
        self.catalog = Catalog.of(*(s for s in catalog.values() if s.name not in self.refused))
        if not self.catalog:
            raise ValueError("the catalog holds no usable source")
        for name, problems in self.refused.items():
            logger.warning("source '%s' is left out: %s", name, "; ".join(problems))
        self.store = store.rstrip("/")
        self.load_time = load_time or datetime.now()
        self.user_mode = user_mode
        self.jdbc = jdbc
        self.refuse_repeats = refuse_repeats

    def at(self, load_time: datetime) -> ImportEngine:
        """The same engine with another load time."""
        return ImportEngine(
            self.spark, self.catalog, self.store, load_time, self.user_mode, self.jdbc, self.refused,
            self.refuse_repeats,
        )

    # --- prepare -----------------------------------------------------------------

    def prepare(
        self,
        inbox: str,
        source: str | None = None,
        require_unambiguous: bool = False,
        min_lead: float | None = None,
        changed_before: datetime | None = None,
        run_id: str | None = None,
    ) -> Prepared:
        """Classify (or take ``source``), validate and map every file of a folder."""
        found = delivery.open_inbox(self.spark, inbox, changed_before)
        refused = {p: REFUSED_NAME for p in found.hidden}
        return self.prepare_files(found, found.paths, source, require_unambiguous, min_lead, run_id, refused)

    def prepare_files(
        self,
        found: delivery.Inbox,
        paths: list[str],
        source: str | None = None,
        require_unambiguous: bool = False,
        min_lead: float | None = None,
        run_id: str | None = None,
        refused: dict[str, str] | None = None,
    ) -> Prepared:
        """Same for the files of an inbox that was opened; ``paths`` may name empty ones besides.

        If they can't be landed, the files that can't be read to their end are refused and the
        others are landed without them."""
        options = (source, require_unambiguous, min_lead)
        run_id = run_id or uuid.uuid4().hex
        try:
            return self.prepare_lines(delivery.raw_lines(found), paths, *options, run_id, refused)
        except LandingFailed as e:
            read = lambda group: delivery.read_through(self.spark, group)
            broken = isolate(read, found.paths)[1]
            if not broken:
                raise e.__cause__ from None
        found = delivery.only(self.spark, found, [p for p in found.paths if p not in broken])
        reasons = {p: BROKEN_FILE.format(why) for p, why in broken.items()}
        paths = [p for p in paths if p not in broken]
        return self.prepare_lines(delivery.raw_lines(found), paths, *options, run_id, {**(refused or {}), **reasons})

    def prepare_archives(
        self, archives: str | DataFrame, source: str | None = None,
        min_lead: float | None = None, run_id: str | None = None,
    ) -> Prepared:
        """Same for the members of archives: a folder, or a table (path, content).

        Only unambiguous files are accepted.  An archive that fails a check contributes no
        member; it has a row of its own in the results, with the reason.
        """
        run_id = run_id or uuid.uuid4().hex
        path = f"{new_work_folder(self.spark, f'archives-{run_id}')}/expanded"
        if isinstance(archives, str):
            archives = self.spark.read.format("binaryFile").load(archives)
        expanded = self._saved(archive.expand(archives.select("path", "content")), path)
        names = [r["file"] for r in archive.members(expanded).orderBy("archive", "member_seq").collect()]
        refused = {
            r["archive"]: REFUSED_ARCHIVE.format(r["error"])
            for r in archive.failures(expanded).orderBy("archive").collect()
        }
        prepared = self.prepare_lines(archive.lines(expanded), names, source, True, min_lead, run_id, refused)
        return replace(prepared, unpacked=path.rsplit("/", 1)[0])

    def prepare_lines(
        self,
        raw: DataFrame | None,
        paths: list[str],
        source: str | None = None,
        require_unambiguous: bool = False,
        min_lead: float | None = None,
        run_id: str | None = None,
        refused: dict[str, str] | None = None,
    ) -> Prepared:
        """Same for raw lines (file, block, rid, raw) of the given files, in that order.

        ``refused`` names further deliveries that can't be read, with the reason of each; they
        come after the others."""
        if source is not None and source not in self.catalog:
            raise ValueError(f"source '{source}' is not in the catalog")
        run_id = run_id or uuid.uuid4().hex
        folder = new_work_folder(self.spark, f"run-{run_id}")
        refused = refused or {}
        files = delivery.file_table(self.spark, [*paths, *refused])
        try:
            landing = delivery.land(
                self.spark, raw, files, f"{folder}/landing", self.catalog.delimiters(),
                self._single_byte_encodings(),
            )
        except Exception as e:
            raise LandingFailed from e
        return self._prepare_landed(
            landing, run_id, folder, source, require_unambiguous, min_lead, refused
        )

    def _single_byte_encodings(self) -> tuple[str, ...]:
        declared = {s.datei.encoding for s in self.catalog.values()}
        return tuple(sorted(e for e in declared if e.lower() != "utf-8"))

    def _prepare_landed(
        self, landing, run_id, folder, source, require_unambiguous, min_lead, refused
    ) -> Prepared:
        spanning, pieces = self._spanning_records(landing, folder)
        files = self._with_unreadable(landing.files)
        ranking = None
        if source is None:
            ranking = self._saved(self._ranking(landing, files, spanning), f"{folder}/ranking")
            decisions = classify.decide(ranking, require_unambiguous, min_lead)
        else:
            decisions = files.select(
                "file", F.lit(source).alias("source"), F.lit(None).cast("double").alias("score"),
                F.lit(classify.ACCEPTED).alias("decision"), F.lit(None).cast("string").alias("reason"),
            )
        if refused:
            why = small_table(self.spark, list(refused.items()), "file string, why string")
            told = F.col("why").isNotNull()
            decisions = decisions.join(why, "file", "left").withColumns({
                "decision": F.when(told, F.lit(classify.UNKNOWN)).otherwise(F.col("decision")),
                "source": F.when(~told, F.col("source")),
                "score": F.when(~told, F.col("score")),
                "reason": F.when(told, F.col("why")).otherwise(F.col("reason")),
            }).drop("why")
        decisions = self._saved(self._without_repeats(landing, decisions, run_id), f"{folder}/decisions")
        accepted = decisions.filter(F.col("decision") == classify.ACCEPTED)
        names = sorted(r["source"] for r in accepted.select("source").distinct().collect())
        sources = tuple(self.catalog[n] for n in names)
        failed = self._stage(landing, files, accepted, sources, spanning, folder)
        prepared = Prepared(
            run_id, folder, landing.files, ranking, decisions, decisions, sources, self.spark
        )
        outcome = self._outcome(prepared, failed).join(self._unreadable(files, decisions), "file", "left")
        return Prepared(
            run_id, folder, landing.files, ranking, decisions,
            self._saved(outcome, f"{folder}/outcome"), sources, self.spark, pieces,
        )

    def _without_repeats(self, landing, decisions: DataFrame, run_id: str) -> DataFrame:
        """Decisions in which files of contents that were loaded before are refused."""
        names = [s.name for s in self.catalog.values() if self._refuses_repeats(s)]
        if not names:
            return decisions
        mine = (F.col("decision") == classify.ACCEPTED) & F.col("source").isin(names)
        files = landing.files.filter("n_lines > 0").select("file", "name", "file_seq", "dateihash")
        files = files.join(decisions.filter(mine).select("file"), "file")
        runs = audit.read_runs(self.spark, f"{self.store}/import_runs")
        found = audit.repeated(files, runs, run_id, landing.index_bytes).withColumnRenamed("reason", "why")
        told = F.col("why").isNotNull()
        return decisions.join(found, "file", "left").withColumns({
            "decision": F.when(told, F.lit(REPEATED)).otherwise(F.col("decision")),
            "reason": F.when(told, F.col("why")).otherwise(F.col("reason")),
        }).drop("why")

    def _refuses_repeats(self, source: SourceDef) -> bool:
        return not source.zielsystem.upsert_key if self.refuse_repeats is None else self.refuse_repeats

    def _saved(self, frame: DataFrame, path: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _dialect(self, source: SourceDef) -> int:
        pair = (source.datei.trennzeichen, source.datei.encoding)
        return classify.dialects(self.catalog).index(pair)

    def _with_unreadable(self, files: DataFrame) -> DataFrame:
        """Add the dialects whose encoding cannot read a file."""
        failed = [F.lit(None).cast("int")]
        for i, (_, encoding) in enumerate(classify.dialects(self.catalog)):
            if encoding.lower() != "utf-8":
                failed.append(F.when(F.col(delivery.undecodable_name(encoding)), F.lit(i)))
        return files.withColumn("unreadable", F.array_compact(F.array(*failed)))

    def _spanning_records(
        self, landing, folder: str
    ) -> tuple[dict[str, DataFrame], DataFrame | None]:
        """Records of the files with quoted line breaks, per delimiter that sees them so.

        Quotes, delimiters and line feeds are ASCII bytes in every supported encoding, so
        the work is done on the bytes read as Latin-1, which loses nothing.  The second
        result holds the lines of records too long to put together, if there are any.
        """
        found, pieces = {}, None
        for i, delimiter in enumerate(self.catalog.delimiters()):
            files = landing.files.filter(delivery.spans_name(i)).select("file")
            if files.isEmpty():
                continue
            lines = landing.lines.join(
                bounded_broadcast(files, landing.index_bytes), "file", "left_semi"
            )
            as_text = lines.select(
                "file", "block", "rid", F.decode("raw", "ISO-8859-1").alias("line")
            )
            numbered = quoting.number_records(as_text, delimiter, f"{folder}/numbered-{i}")
            widths = tuple(sorted({s.width for s in self.catalog.values() if s.datei.trennzeichen == delimiter}))
            long = self._saved(quoting.long_records(numbered, delimiter, widths), f"{folder}/long-{i}")
            records = quoting.join_lines(numbered, delimiter, widths, long).select(
                "file", "nr", F.encode("line", "ISO-8859-1").alias("raw")
            )
            if not long.isEmpty():
                lines = quoting.pieces(numbered, long).withColumn("line", F.encode("line", "ISO-8859-1"))
                lines = lines.withColumnRenamed("line", "raw").withColumn("delimiter", F.lit(delimiter))
                pieces = lines if pieces is None else pieces.unionByName(lines)
            found[delimiter] = self._saved(records, f"{folder}/records-{i}")
        return found, pieces

    def _ranking(self, landing, files: DataFrame, spanning: dict[str, DataFrame]) -> DataFrame:
        rows = max(s.klassifikation.stichprobe_zeilen for s in self.catalog.values())
        heads = delivery.head_lines(landing, rows)
        encodings = files.select("file", delivery.file_encoding().alias("detected"))
        side = bounded_broadcast(encodings, landing.index_bytes)
        cut = self._cut(heads.join(side, "file"))
        for delimiter, records in spanning.items():
            i = self.catalog.delimiters().index(delimiter)
            ids = [n for n, (d, _) in enumerate(classify.dialects(self.catalog)) if d == delimiter]
            mine = F.col("dialect").isin(ids)
            affected = files.filter(delivery.spans_name(i)).select("file", F.lit(True).alias("_spans"))
            plain = cut.join(affected, "file", "left").filter(F.col("_spans").isNull() | ~mine)
            first = records.filter(F.col("nr") <= rows).join(side, "file")
            cut = plain.drop("_spans").unionByName(self._cut(first).filter(mine))
        table = classify.scoring_table(self.spark, self.catalog)
        return classify.rank(classify.score_files(files, cut, table, self.catalog))

    def _cut(self, samples: DataFrame) -> DataFrame:
        text = {}
        for _, declared in classify.dialects(self.catalog):
            if declared.lower() == "utf-8":
                text[declared] = _decoded(F.col("detected"))
            else:
                text[declared] = decode_as(F.col("raw"), declared)
        return classify.cut_samples(samples, self.catalog, text)

    def _stage(self, landing, files, accepted, sources, spanning, folder: str) -> dict[str, str]:
        """Parse, check and convert the accepted files; one written table per source.

        A file that fails does not stop the others; the result names each with the reason."""
        assigned = self._saved(
            reduce(DataFrame.unionByName, [self._assigned(files, accepted, s) for s in sources])
            if sources else files.select("file").limit(0),
            f"{folder}/assigned",
        )
        carried = ("file_seq", "encoding", "spans")
        routed = None
        if len(sources) > SCANS_BEFORE_ROUTING:
            lines = delivery.number_lines(landing, assigned, ("source", *carried))
            lines.write.mode("overwrite").partitionBy("source").parquet(f"{folder}/routed")
            routed = self.spark.read.parquet(f"{folder}/routed")

        def stage(source: SourceDef) -> dict[str, str]:
            every = assigned.filter(F.col("source") == source.name).drop("source")
            try:
                stage_files(source, every, True)
                return {}
            except Exception as e:  # noqa: BLE001  the files tell
                logger.warning("staging of '%s' is split: %s", source.name, message(e))
            names = [r["file"] for r in every.select("file", "file_seq").orderBy("file_seq").collect()]
            work = lambda group: stage_files(source, every.filter(F.col("file").isin(group)), False)
            failed = isolate(work, names, split_first=True)[1]
            if len(failed) == len(names):
                small_table(self.spark, [], "file string").write.mode("append").parquet(f"{folder}/staged/{source.name}")
            return failed

        def stage_files(source: SourceDef, mine: DataFrame, every: bool) -> None:
            if routed is None:
                lines = delivery.number_lines(landing, mine, carried)
            else:
                lines = routed.filter(F.col("source") == source.name).drop("source")
                lines = lines if every else lines.join(mine.select("file"), "file", "left_semi")
            records = spanning.get(source.datei.trennzeichen)
            if records is not None:
                side = bounded_broadcast(mine.filter("spans"), landing.index_bytes)
                lines = lines.filter(~F.col("spans")).unionByName(records.join(side, "file"))
            self._stage_source(lines, source, folder)

        failed: dict[str, str] = {}
        for of_source in _side_by_side(stage, sources):
            failed |= of_source
        return failed

    def _assigned(self, files: DataFrame, accepted: DataFrame, source: SourceDef) -> DataFrame:
        """Readable files of one source: (file, file_seq, source, encoding, spans)."""
        encoding = effective_encoding(source.datei.encoding, F.col("all_utf8"), F.col("all_cp1252"))
        spans = delivery.spans_name(self.catalog.delimiters().index(source.datei.trennzeichen))
        mine = accepted.filter(F.col("source") == source.name).select("file", "source")
        readable = files.filter(~F.array_contains("unreadable", F.lit(self._dialect(source))))
        return readable.join(mine, "file").select(
            "file", "file_seq", "source", encoding.alias("encoding"), F.col(spans).alias("spans")
        )

    def _stage_source(self, lines: DataFrame, source: SourceDef, folder: str) -> None:
        text = (
            _decoded(F.col("encoding")) if source.datei.encoding.lower() == "utf-8"
            else decode_as(F.col("raw"), source.datei.encoding)
        )
        records = lines.select("file", "file_seq", "nr", text.alias("line"))
        checked = validate.check(validate.parse(records, source), source)
        bad = F.col("n_errors") > 0
        staged = checked.select(
            "file", "file_seq", "nr", "n_errors", "overflow",
            F.when(bad, F.col("cells")).alias("cells"),
            *(
                F.when(~bad, value).alias(name)
                for name, value in zip(
                    source.target_fields(), target_columns(source, self.load_time), strict=True
                )
            ),
            bad.alias("bad"),
        )
        staged.write.mode("append").partitionBy("bad").parquet(f"{folder}/staged/{source.name}")

    def _unreadable(self, files: DataFrame, decisions: DataFrame) -> DataFrame:
        """Files that the encoding of their source can't read: (file, unreadable_as)."""
        encodings = [
            F.when((F.col("source") == s.name) & F.array_contains("unreadable", F.lit(self._dialect(s))), F.lit(s.datei.encoding))
            for s in self.catalog.values()
        ]
        found = decisions.select("file", "source").join(files.select("file", "unreadable"), "file")
        return found.select("file", F.coalesce(*encodings).alias("unreadable_as")).filter("unreadable_as is not null")

    def _outcome(self, prepared: Prepared, failed: dict[str, str]) -> DataFrame:
        """Row counts and validation verdict of each file; ``failed`` names those whose staging
        failed."""
        counts = small_table(
            self.spark, [], "file string, rows_total bigint, rows_bad bigint, n_errors bigint, rows_overflow bigint"
        )
        for s in prepared.sources:
            counts = counts.unionByName(validate.file_counts(prepared.staged(s)))
        partial = [s.name for s in prepared.sources if s.partial]
        flags = prepared.decisions.withColumn(
            "partial", F.coalesce(F.col("source").isin(partial), F.lit(False))
        )
        judged = validate.verdicts(flags, counts, F.col("partial"))
        why = small_table(self.spark, list(failed.items()), "file string, stage_failure string")
        judged = judged.join(why, "file", "left") if failed else judged.withColumn(
            "stage_failure", F.lit(None).cast("string")
        )
        return prepared.files.select("file", "name", "file_seq").join(judged, "file", "left")

    # --- commit ------------------------------------------------------------------

    def run(self, inbox: str, **options) -> DataFrame:
        """Prepare and commit without a look in between; the working tables go afterwards."""
        prepared = self.prepare(inbox, **options)
        results = self.commit(prepared)
        prepared.release()
        return results

    def commit(self, prepared: Prepared, hashes: DataFrame | None = None) -> DataFrame:
        """Load the accepted files, write quarantine, dispositions and audit; return results."""
        effects = self._load(prepared)
        results = self._saved(
            self._results(prepared, effects, hashes), f"{self.store}/results/run_id={prepared.run_id}"
        )
        self._write_side_tables(prepared, results)
        audit.append_runs(
            self.spark, f"{self.store}/import_runs", results, prepared.run_id, self.user_mode,
            datetime.now(),
        )
        return results

    def table(self, source: SourceDef) -> SnapshotTable:
        target = source.zielsystem
        return SnapshotTable(
            self.spark, f"{self.store}/tables", target.tabelle, source.target_schema(), target.upsert_key
        )

    def _load(self, prepared: Prepared) -> DataFrame:
        """Load every target; returns (file_seq, loaded, skipped, conflicts, failure)."""
        none = small_table(
            self.spark, [],
            "file_seq int, loaded bigint, skipped bigint, conflicts bigint, failure string",
        )

        def load_one(source: SourceDef) -> DataFrame:
            ready = prepared.outcome.filter(
                (F.col("source") == source.name) & F.col("valid") & (F.col("rows_overflow") == 0) & F.col("stage_failure").isNull()
            ).select("file_seq", (F.col("rows_total") - F.col("rows_bad")).alias("rows_good"))
            return self._load_files(prepared, source, ready)

        def load_table(group: list[SourceDef]) -> list[DataFrame]:
            return [load_one(s) for s in group]

        by_table: dict[str, list[SourceDef]] = {}
        for source in prepared.sources:
            by_table.setdefault(source.zielsystem.tabelle, []).append(source)
        effects = sum(_side_by_side(load_table, by_table.values()), [])
        return self._saved(
            reduce(DataFrame.unionByName, effects, none), f"{prepared.folder}/effects"
        )

    def _load_files(self, prepared: Prepared, source: SourceDef, ready: DataFrame) -> DataFrame:
        """Load the files of a source as one run; if that fails, as several, in the order of the
        files, so that only those fail that have to."""
        name = f"{prepared.run_id}-{source.name}"
        before: list[str] = []
        try:
            if source.zielsystem.typ != "oracle":
                before = self.table(source).parts_of(name)
            if not before:
                return self._load_source(prepared, source, ready, name)
        except Exception as e:  # noqa: BLE001  the files tell
            logger.warning("load into '%s' is split: %s", source.zielsystem.tabelle, message(e))
        done: list[DataFrame] = []
        if before:  # an earlier attempt of this run was split, too: its files are loaded
            notes = self.spark.read.parquet(*(self.table(source).note_path(r) for r in before))
            noted = notes.join(prepared.files.select("file", "file_seq"), "file")
            done.append(_effect(noted, *(F.col(c) for c in ("loaded", "skipped", "conflicts", "failure"))))
            ready = ready.join(noted.select("file_seq"), "file_seq", "left_anti")
        numbers = [r["file_seq"] for r in ready.select("file_seq").orderBy("file_seq").collect()]

        def load(group: list[int]) -> DataFrame:
            some = ready.filter(F.col("file_seq").isin(group))
            return self._load_source(prepared, source, some, f"{name}{PART_OF}{uuid.uuid4().hex}")

        loaded, failed = isolate(load, numbers, split_first=not before)
        for number, why in failed.items():
            loaded.append(_effect(ready.filter(F.col("file_seq") == number), failure=F.lit(why)))
        return reduce(DataFrame.unionByName, done + loaded) if done or loaded else _effect(ready)

    def _note(self, prepared: Prepared, table: SnapshotTable, run_id: str, effect: DataFrame) -> DataFrame:
        """Leaves what a part of a split run does to each file, for a repetition of the run."""
        if PART_OF in run_id:
            files = prepared.files.select("file", "file_seq")
            effect.join(files, "file_seq").drop("file_seq").write.mode("overwrite").parquet(table.note_path(run_id))
        return effect

    def _load_source(self, prepared: Prepared, source: SourceDef, ready: DataFrame, run_id: str) -> DataFrame:
        target = source.zielsystem
        rows = prepared.good(source).join(ready.select("file_seq"), "file_seq", "left_semi")
        rows = rows.select("file_seq", "nr", *source.target_fields())
        if ready.isEmpty():
            return _effect(ready)
        if target.typ == "oracle":
            return self._load_jdbc(rows, source, ready)
        table = self.table(source)
        key = list(target.upsert_key)
        for attempt in range(LOAD_ATTEMPTS):
            try:
                return self._load_table(prepared, source, rows, ready, table, key, run_id)
            except ConcurrentChange:
                if attempt == LOAD_ATTEMPTS - 1:
                    raise
        raise AssertionError("not reached")

    def _load_table(self, prepared, source, rows, ready, table, key, run_id) -> DataFrame:
        mode = source.zielsystem.pk_konflikt
        if not key:
            effect = self._note(prepared, table, run_id, _effect(ready, F.col("rows_good")))
            table.write_part(rows.drop("nr"), run_id)
            table.publish(run_id, APPEND)
            return effect
        if mode == "update":
            effect = self._note(prepared, table, run_id, _effect(ready, F.col("rows_good")))
            table.merge(load.rows_to_update_load(rows, key).select(*source.target_fields()), run_id)
            return effect
        seen = table.state(before_run=run_id)
        before = table.rows(seen, table.buckets_of(rows)).select(*key)
        if mode == "reject":
            return self._load_or_reject(prepared, source, rows, ready, table, before, run_id, seen)
        written = table.write_part(load.rows_to_skip_load(rows, before, key).drop("nr"), run_id)
        kept = written.groupBy("file_seq").agg(F.count(F.lit(1)).alias("loaded"))
        effect = ready.join(kept, "file_seq", "left").withColumn("loaded", F.coalesce("loaded", F.lit(0)))
        effect = self._note(prepared, table, run_id, _effect(effect, F.col("loaded"), F.col("rows_good") - F.col("loaded")))
        table.publish(run_id, APPEND, seen=seen)
        return effect

    def _load_or_reject(self, prepared, source, rows, ready, table, before, run_id, seen) -> DataFrame:
        key = list(source.zielsystem.upsert_key)
        folder = f"{prepared.folder}/reject-{run_id}"
        found = load.reject_verdicts(
            self.spark, load.rows_per_key(rows, key), before, key, folder
        )
        names = ", ".join(f"{source.zielsystem.tabelle}.{k}" for k in key)
        repeated = (F.col("repeats") > 0) & (F.col("conflicts") == 0)
        judged = ready.join(found, "file_seq", "left").fillna(0, ["conflicts", "repeats"])
        failure = F.when(repeated, F.lit(f"UNIQUE constraint failed: {names}"))
        accepted = (F.col("conflicts") == 0) & (F.col("repeats") == 0)
        loaded = F.when(accepted, F.col("rows_good")).otherwise(F.lit(0))
        effect = self._saved(
            _effect(judged, loaded, conflicts=F.col("conflicts"), failure=failure), f"{folder}/effect"
        )
        clean = effect.filter("conflicts = 0 and failure is null").select("file_seq")
        table.write_part(rows.join(clean, "file_seq", "left_semi").drop("nr"), run_id)
        self._note(prepared, table, run_id, effect)
        table.publish(run_id, APPEND, seen=seen)
        return effect

    def _load_jdbc(self, rows: DataFrame, source: SourceDef, ready: DataFrame) -> DataFrame:
        """Append to a staging table of a database; the database merges from there."""
        if not self.jdbc:
            raise ConnectionError("no JDBC options are configured for this target")
        writer = rows.select(*source.target_fields()).write.format("jdbc").mode("append")
        writer.options(**self.jdbc, dbtable=f"{source.zielsystem.tabelle}_staging").save()
        return _effect(ready, F.col("rows_good"))

    def _results(self, prepared: Prepared, effects: DataFrame, hashes: DataFrame | None) -> DataFrame:
        """One final row per file."""
        conflicts = F.coalesce("conflicts", F.lit(0))
        overflow = F.col("rows_overflow")
        steps: list[tuple[Column, Column, Column]] = [
            (F.col("decision") != classify.ACCEPTED, F.col("decision"), F.col("reason")),
            (
                F.col("stage_failure").isNotNull(), F.lit(LOAD_ERROR),
                F.concat(F.lit(LOAD_FAILED.format("")), F.col("stage_failure")),
            ),
            (
                F.col("unreadable_as").isNotNull(), F.lit(INVALID),
                F.replace(F.lit(UNREADABLE_REASON), F.lit("{}"), F.col("unreadable_as")),
            ),
            (~F.col("valid"), F.lit(INVALID), F.col("invalid_reason")),
            (
                overflow > 0, F.lit(LOAD_ERROR),
                F.concat(
                    F.lit("Fehler beim Laden: Ganzzahl ausserhalb von 64 Bit in "),
                    overflow.cast("string"), F.lit(" Zeilen"),
                ),
            ),
            (
                conflicts > 0, F.lit(KEY_CONFLICT),
                F.concat(
                    conflicts.cast("string"),
                    F.lit(" Datensatz/-saetze existieren bereits (pk_konflikt=reject)"),
                ),
            ),
            (
                F.col("failure").isNotNull(), F.lit(LOAD_ERROR),
                F.concat(F.lit("Fehler beim Laden: "), F.col("failure")),
            ),
        ]
        status, reason = F.lit(LOADED), F.lit("")
        for condition, value, text in reversed(steps):
            status = F.when(condition, value).otherwise(status)
            reason = F.when(condition, text).otherwise(reason)
        joined = prepared.outcome.join(effects, "file_seq", "left")
        own = prepared.files.select("file", "dateihash") if hashes is None else hashes
        joined = joined.join(own, "file", "left")
        return joined.select(
            "file", "file_seq", F.col("name").alias("dateiname"), "dateihash",
            F.col("source").alias("quelle"), "score", status.alias("status"),
            F.col("rows_total").alias("zeilen_gesamt"),
            F.coalesce("loaded", F.lit(0)).alias("zeilen_geladen"),
            F.coalesce("skipped", F.lit(0)).alias("zeilen_uebersprungen"),
            F.when(F.col("partial"), F.col("rows_bad")).otherwise(F.lit(0)).alias("zeilen_quarantaene"),
            reason.alias("fehler_grund"),
        )

    def export_quarantine(self, run_id: str, folder: str) -> None:
        """Bad rows of a run as text for those who correct them: see :func:`report.quarantine_csv`."""
        rows = self.spark.read.parquet(f"{self.store}/quarantine/run_id={run_id}")
        report.quarantine_csv(rows, folder, self.load_time)

    def _write_side_tables(self, prepared: Prepared, results: DataFrame) -> None:
        """Quarantine, dispositions and reject reports, one folder per run."""
        run = f"run_id={prepared.run_id}"
        named = prepared.quarantine().withColumn("dateiname", file_name(F.col("file")))
        named.write.mode("overwrite").parquet(f"{self.store}/quarantine/{run}")
        if prepared.pieces is not None:
            of_source = [F.when(F.col("quelle") == s.name, F.lit(s.datei.trennzeichen)) for s in prepared.sources]
            used = results.select("file", F.coalesce(*of_source, F.lit(None).cast("string")).alias("delimiter"))
            lines = prepared.pieces.join(used, ["file", "delimiter"])
            lines.write.mode("overwrite").parquet(f"{self.store}/quarantine_pieces/{run}")
        moves = report.dispositions(results, "archive", "reject", self.load_time)
        moves.write.mode("overwrite").parquet(f"{self.store}/dispositions/{run}")
        text = report.reject_report(results, self._details(prepared, results), self.load_time)
        text.write.mode("overwrite").parquet(f"{self.store}/reject_reports/{run}")

    def _details(self, prepared: Prepared, results: DataFrame) -> DataFrame:
        """Detail lines for the reject reports: (file, line_nr, text)."""
        refused = {
            r["quelle"] for r in
            results.filter(F.col("status") == INVALID).select("quelle").distinct().collect()
        }
        found = prepared.errors([s for s in prepared.sources if s.name in refused])
        partial = [s.name for s in prepared.sources if s.partial]
        kinds = results.select("file", F.col("quelle").isin(partial).alias("partial"))
        rejected = found.join(kinds, "file")
        listed = rejected.filter("partial").unionByName(
            validate.error_report(rejected.filter(~F.col("partial")))
        )
        text = validate.error_line(F.col("nr"), F.col("column"), F.col("value"), F.col("reason"))
        # Several findings of one row share a line number and sort by column position.
        line_nr = F.col("nr") * 100_000 + F.col("position") + 1
        details = listed.select("file", line_nr.alias("line_nr"), text.alias("text"))
        unreadable = F.startswith(F.col("fehler_grund"), F.lit(UNREADABLE_REASON.split("{}")[0]))
        empty = results.filter(
            (F.col("status") == INVALID) & (F.col("zeilen_gesamt") == 0)
        ).select(
            "file", F.lit(0).cast("bigint").alias("line_nr"),
            F.concat(
                F.lit("Zeile 0: "),
                F.when(unreadable, F.col("fehler_grund")).otherwise(F.lit(validate.NO_ROWS_REASON)),
            ).alias("text"),
        )
        details = details.unionByName(empty)
        if prepared.ranking is not None:
            open_files = prepared.decisions.filter(F.col("decision") != classify.ACCEPTED)
            ranked = prepared.ranking.join(open_files.select("file", "decision"), "file")
            plain = F.concat(F.col("source"), F.lit(": "), F.col("ko_reason"))
            lines = classify.ranking_lines(ranked.filter(F.col("decision") == classify.UNSURE))
            unknown = ranked.filter(F.col("decision") == classify.UNKNOWN).select(
                "file", "rank", plain.alias("text")
            )
            ranked_text = lines.unionByName(unknown).select(
                "file", F.col("rank").cast("bigint").alias("line_nr"), "text"
            )
            details = details.unionByName(ranked_text)
        return details


def _side_by_side(work: Callable, items: Iterable) -> list:
    """Run the Spark jobs of several items from threads; results in item order."""
    with ThreadPoolExecutor(max_workers=PARALLEL_SOURCES) as pool:
        return list(pool.map(work, items))


def _decoded(encoding: Column) -> Column:
    """Text of ``raw`` for sources that leave the encoding to detection."""
    return decode_by(F.col("raw"), encoding, ["utf-8", "cp1252", "iso-8859-1"])


def _effect(
    ready: DataFrame,
    loaded: Column | None = None,
    skipped: Column | None = None,
    conflicts: Column | None = None,
    failure: Column | None = None,
) -> DataFrame:
    zero = F.lit(0)
    return ready.select(
        F.col("file_seq").cast("int").alias("file_seq"),
        (zero if loaded is None else loaded).cast("bigint").alias("loaded"),
        (zero if skipped is None else skipped).cast("bigint").alias("skipped"),
        (zero if conflicts is None else conflicts).cast("bigint").alias("conflicts"),
        (F.lit(None) if failure is None else failure).cast("string").alias("failure"),
    )

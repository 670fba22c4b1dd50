"""Audit table of import runs and the questions it answers."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from dockhand.session import bounded_broadcast, small_table

logger = logging.getLogger(__name__)

LOADED = "geladen"

# Wording of the reasons why a repeated delivery is refused.
REPEATED_BEFORE = "Inhalt wurde bereits geladen: {} am "
REPEATED_HERE = "Inhalt gleicht {} derselben Lieferung"

# Columns of the audit table.
AUDIT_SCHEMA = (
    "id bigint, zeitstempel string, dateiname string, dateihash string, quelle string, "
    "score double, status string, zeilen_gesamt bigint, zeilen_geladen bigint, "
    "zeilen_uebersprungen bigint, zeilen_quarantaene bigint, fehler_grund string, "
    "dauer_ms bigint, benutzer_modus string, run_id string"
)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(AUDIT_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return small_table(spark, [], AUDIT_SCHEMA)
        raise


def append_runs(
    spark: SparkSession, path: str, results: DataFrame, run_id: str, mode: str, at: datetime
) -> bool:
    """Append one row per file; a failure is logged and never fails the import.

    A run that is already in the table is not appended again.
    """
    try:
        runs = read_runs(spark, path)
        if not runs.filter(F.col("run_id") == run_id).isEmpty():
            return True
        last = runs.agg(F.max("id").alias("id")).first()["id"] or 0
        rows = results.select(
            (F.lit(last + 1) + F.col("file_seq")).cast("bigint").alias("id"),
            F.lit(f"{at:%Y-%m-%dT%H:%M:%S}").alias("zeitstempel"),
            "dateiname", "dateihash", "quelle", "score", "status", "zeilen_gesamt",
            "zeilen_geladen", "zeilen_uebersprungen", "zeilen_quarantaene", "fehler_grund",
            F.lit(None).cast("bigint").alias("dauer_ms"),
            F.lit(mode).alias("benutzer_modus"),
            F.lit(run_id).alias("run_id"),
        )
        rows.coalesce(1).write.mode("append").parquet(path)
        return True
    except Exception:
        logger.exception("audit rows of run %s could not be written", run_id)
        return False


def latest_runs(runs: DataFrame, n: int = 20, order: str = "id") -> DataFrame:
    """The last ``n`` runs, newest first (a top-n, no full sort)."""
    return runs.orderBy(F.desc(order)).limit(n)


def already_loaded(incoming: DataFrame, runs: DataFrame, hash_column: str = "dateihash") -> DataFrame:
    """Incoming rows whose content hash was loaded before."""
    loaded = runs.filter((F.col("status") == LOADED) & F.col("dateihash").isNotNull())
    return incoming.join(
        loaded.select(F.col("dateihash").alias(hash_column)), hash_column, "left_semi"
    )


def not_yet_loaded(incoming: DataFrame, runs: DataFrame, hash_column: str = "dateihash") -> DataFrame:
    """Incoming rows whose content was never loaded (repeated deliveries drop out)."""
    loaded = runs.filter((F.col("status") == LOADED) & F.col("dateihash").isNotNull())
    return incoming.join(
        loaded.select(F.col("dateihash").alias(hash_column)), hash_column, "left_anti"
    )


def repeated(
    files: DataFrame, runs: DataFrame, run_id: str, index_bytes: int = 0
) -> DataFrame:
    """(file, reason) of the files whose content was loaded by another run, or which repeat an
    earlier one of the same delivery.

    ``files``: file, name, file_seq, dateihash.  Of the history only runs of these contents take
    part, so its size costs a scan and no shuffle of it where the delivery can be broadcast.
    """
    hashes = files.select("dateihash").distinct()
    loaded = runs.filter((F.col("status") == LOADED) & (F.col("run_id") != run_id))
    loaded = loaded.join(bounded_broadcast(hashes, index_bytes), "dateihash", "left_semi")
    before = loaded.groupBy("dateihash").agg(F.min_by(F.struct("dateiname", "zeitstempel"), "id").alias("before"))
    first = files.groupBy("dateihash").agg(F.min(F.struct("file_seq", "name")).alias("first"))
    earlier = F.when(
        F.col("first.file_seq") < F.col("file_seq"), F.replace(F.lit(REPEATED_HERE), F.lit("{}"), F.col("first.name"))
    )
    ever = F.when(
        F.col("before").isNotNull(),
        F.concat(F.replace(F.lit(REPEATED_BEFORE), F.lit("{}"), F.col("before.dateiname")), F.col("before.zeitstempel")),
    )
    found = files.join(first, "dateihash").join(before, "dateihash", "left")
    return found.select("file", F.coalesce(ever, earlier).alias("reason")).filter("reason is not null")


def run_stats(runs: DataFrame) -> DataFrame:
    """Files per status."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


def loaded_and_rejected(runs: DataFrame) -> DataFrame:
    """One row: loaded against rejected files."""
    loaded = F.col("status") == LOADED
    return runs.agg(F.count_if(loaded).alias("loaded"), F.count_if(~loaded).alias("rejected"))


def loads_per_month(runs: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Loaded files and rows per month."""
    at = timestamp if timestamp is not None else F.to_timestamp("zeitstempel")
    return (
        runs.filter(F.col("status") == LOADED)
        .groupBy(F.date_format(F.date_trunc("month", at), "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("zeilen_geladen").alias("n_rows"))
    )


def rejects_per_source(runs: DataFrame) -> DataFrame:
    """Rejected and total files per source."""
    return runs.groupBy("quelle").agg(
        F.count_if(F.col("status") != LOADED).alias("n_rejected"),
        F.count(F.lit(1)).alias("n_files"),
    )

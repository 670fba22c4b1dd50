"""Reports over findings, decisions and dispositions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockhand.functions.text import archive_path, quarantine_path, reject_path
from dockhand.operators.audit import LOADED

TOP_CATEGORIES = 5


def error_groups(found: DataFrame, by: tuple[str, ...] = ("file",)) -> DataFrame:
    """Findings per category (column and reason) with the first value as example."""
    first = F.struct("nr", "position", "value")
    return found.groupBy(*by, "column", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.min(first).alias("_first")
    ).select(
        *by, "column", "reason", "n",
        F.col("_first.nr").alias("first_nr"), F.col("_first.position").alias("first_position"),
        F.col("_first.value").alias("example"),
    )


def top_error_groups(
    groups: DataFrame, by: tuple[str, ...] = ("file",), top: int = TOP_CATEGORIES
) -> DataFrame:
    """The most frequent categories, and one last row that sums up the others.

    Ties keep the order of first appearance.  Categories are bounded by the catalog and the
    distinct column counts, not by the number of findings.
    """
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    order = window.orderBy(F.desc("n"), "first_nr", "first_position", "reason")
    ranked = groups.withColumn("place", F.least(F.row_number().over(order), F.lit(top + 1)))
    rest = F.col("place") > top
    return ranked.groupBy(*by, "place").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("n_categories"),
        F.max(F.when(~rest, F.col("column"))).alias("column"),
        F.max(F.when(~rest, F.col("reason"))).alias("reason"),
        F.max(F.when(~rest, F.col("example"))).alias("example"),
    )


def category_overview(decisions: DataFrame) -> DataFrame:
    """Files per category of an archive delivery."""
    return decisions.groupBy("category").agg(F.count(F.lit(1)).alias("n_files"))


def dispositions(
    results: DataFrame, archive: str, reject: str, when: datetime
) -> DataFrame:
    """Where each file goes: (file, status, target_path)."""
    name = F.col("dateiname")
    target = F.when(
        F.col("status") == LOADED, archive_path(archive, F.col("quelle"), name, when)
    ).otherwise(reject_path(reject, name, when))
    return results.select("file", "status", target.alias("target_path"))


def reject_report(results: DataFrame, details: DataFrame, when: datetime) -> DataFrame:
    """Text of the reject reports as rows: (file, part, line_nr, text).

    ``details`` has (file, line_nr, text).  The lines of a report sort by (part, line_nr);
    a file may have any number of them, so they are never collected into one value.
    """
    rejected = results.filter(F.col("status") != LOADED)
    head = rejected.select(
        "file", F.lit(0).alias("part"),
        F.posexplode(F.array(
            F.concat(F.lit("Datei:     "), F.col("dateiname")),
            F.lit(f"Rejected:  {when:%Y-%m-%d %H:%M:%S}"),
            F.concat(F.lit("Grund:     "), F.col("fehler_grund")),
            F.lit(""),
        )).alias("line_nr", "text"),
    ).withColumn("line_nr", F.col("line_nr").cast("bigint"))
    own = details.join(rejected.select("file"), "file", "left_semi")
    title = own.select("file").distinct().select(
        "file", F.lit(1).alias("part"), F.lit(0).cast("bigint").alias("line_nr"),
        F.lit("Details:").alias("text"),
    )
    body = own.select(
        "file", F.lit(2).alias("part"), F.col("line_nr").cast("bigint").alias("line_nr"),
        F.concat(F.lit("  - "), F.col("text")).alias("text"),
    )
    return head.unionByName(title).unionByName(body)


def quarantine_csv(rows: DataFrame, folder: str, when: datetime) -> None:
    """Quarantined rows (dateiname, zeile_nr, fehler_grund, original_zeile) as CSV with ``;``.

    Each delivered file has a folder named as its quarantine file, with rows in the order of their
    numbers; a file with very many bad rows has several parts, in order too."""
    name = F.substring(quarantine_path("", F.col("dateiname"), when), 2, 1000).alias("datei")
    placed = rows.select(name, "zeile_nr", "fehler_grund", "original_zeile")
    ordered = placed.repartitionByRange("datei", "zeile_nr").sortWithinPartitions("datei", "zeile_nr")
    options = {"sep": ";", "header": True, "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    ordered.write.mode("overwrite").partitionBy("datei").options(**options).csv(folder)

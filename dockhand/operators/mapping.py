"""Mapping: checked rows to typed target rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockhand.catalog import SourceDef
from dockhand.functions.derived import DERIVED_FIELDS, LoadContext
from dockhand.operators.validate import check, good_rows, parse, stripped_name, value_name


def target_columns(source: SourceDef, load_time: datetime) -> list[Column]:
    """One expression per target field, over the columns of a checked row."""
    by_name = {c.name: c for c in source.spalten}
    values: dict[str, Column] = {}
    for rule in source.mapping.regeln:
        c = by_name[rule.quelle]
        cell = F.nullif(F.col(stripped_name(c.position)), F.lit(""))
        values[rule.ziel] = cell if c.typ == "string" else F.col(value_name(c.position))
    context = LoadContext(load_time, F.col("file"))
    for d in source.mapping.abgeleitete_felder:
        values[d.ziel] = DERIVED_FIELDS[d.funktion](context)
    return [values[name].alias(name) for name in source.target_fields()]


def map_rows(
    checked: DataFrame, source: SourceDef, load_time: datetime, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Good rows of a checked frame as target rows; ``keep`` carries columns along."""
    return good_rows(checked).select(*keep, *target_columns(source, load_time))


def import_rows(
    records: DataFrame, source: SourceDef, load_time: datetime, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Records of one source to target rows, leaving the bad rows out."""
    return map_rows(check(parse(records, source), source), source, load_time, keep)


def preview(mapped: DataFrame, fields: list[str], rows: int = 5) -> DataFrame:
    """First mapped rows per file plus ``more``, the number of rows not shown."""
    order = Window.partitionBy("file").orderBy("nr")
    shown = mapped.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= rows)
    total = mapped.groupBy("file").agg(F.count(F.lit(1)).alias("_total"))
    return shown.join(total, "file").select(
        "file", "nr", *fields, F.greatest(F.col("_total") - rows, F.lit(0)).alias("more")
    )

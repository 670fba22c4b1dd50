"""Row and file validation.

A *record frame* has the columns ``file``, ``nr`` (record number in the file) and ``line``;
further columns are carried along.  ``parse`` turns lines into cells, ``check`` counts the
errors of each row with flat expressions, and only the bad rows pay for error details.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockhand.catalog import ColumnDef, SourceDef
from dockhand.functions.cells import (
    above_maximum,
    below_minimum,
    cell_at,
    filled_fits,
    has_odd_space,
    overflows,
    pattern_fits,
    strip,
    tokenize,
    typed_value,
    value_fits,
)

# Fixed value: errors listed per file in the all-or-nothing report.
MAX_REPORTED_ERRORS = 50

# Wording of the reasons.
NO_ROWS_REASON = "Datei enthaelt keine Datenzeilen."
REQUIRED_REASON = "Pflichtfeld ist leer"

ERROR_COLUMNS = ("position", "column", "value", "code", "reason")


def stripped_name(position: int) -> str:
    """Name of the working column that holds the stripped cell."""
    return f"_c{position}"


def value_name(position: int) -> str:
    """Name of the working column that holds the typed value; strings have none."""
    return f"_v{position}"


def parse(records: DataFrame, source: SourceDef) -> DataFrame:
    """Records to cells: drops blank records and the header, which still were numbered."""
    rows = records.filter(F.col("line") != "")
    if source.datei.hat_header:
        rows = rows.filter(F.col("nr") > 1)
    kept = [c for c in records.columns if c != "line"]
    line, delimiter = F.col("line"), source.datei.trennzeichen
    return rows.select(
        *kept,
        tokenize(line, delimiter).alias("cells"),
        has_odd_space(line, delimiter).alias("odd_space"),
    )


def check(parsed: DataFrame, source: SourceDef) -> DataFrame:
    """Add the stripped cells, their typed values, ``n_errors`` and ``overflow`` to every parsed row.

    ``inline`` of one struct keeps the row as it is, but stops the optimizer from copying what
    stands below into every later filter and projection: each cell is cut, stripped and converted
    once per row, and checks, bounds and mapping use the same value.
    """
    odd_space = F.col("odd_space") if "odd_space" in parsed.columns else None
    stripped = (
        strip(cell_at(F.col("cells"), c.position), odd_space).alias(stripped_name(c.position))
        for c in source.columns
    )
    wide = parsed.select("*", F.inline(F.array(F.struct(*stripped))))
    values = ((c, typed_value(F.col(stripped_name(c.position)), c.typ)) for c in source.columns)
    values = [v.alias(value_name(c.position)) for c, v in values if v is not None]
    if values:
        wide = wide.select("*", F.inline(F.array(F.struct(*values))))
    per_cell = [_cell_error_count(c) for c in source.columns]
    n_errors = F.when(F.size("cells") != source.width, F.lit(1)).otherwise(
        reduce(lambda a, b: a + b, per_cell)
    )
    return wide.select("*", n_errors.alias("n_errors"), _row_overflow(source).alias("overflow"))


def _cell_error_count(c: ColumnDef) -> Column:
    cell, value = F.col(stripped_name(c.position)), None if c.typ == "string" else F.col(value_name(c.position))
    bounds = [b for b in (below_minimum(cell, c, value), above_maximum(cell, c, value)) if b is not None]
    in_range = reduce(lambda a, b: a + b, [b.cast("int") for b in bounds], F.lit(0))
    fits = value_fits(cell, value, c.typ)
    if c.muster is not None:
        fits = fits & pattern_fits(cell, c.muster)
    if c.typ == "string" and c.muster is None:
        return F.when(cell == "", F.lit(int(c.pflicht))).otherwise(F.lit(0)) if c.pflicht else F.lit(0)
    return (
        F.when(cell == "", F.lit(int(c.pflicht)))
        .when(~fits, F.lit(1))
        .otherwise(in_range)
    )


def _row_overflow(source: SourceDef) -> Column:
    """True when a mapped integer of the row does not fit 64 bits: the file cannot be loaded."""
    mapped = {r.quelle for r in source.mapping.regeln}
    tests = [
        F.col(value_name(c.position)).isNull() & overflows(F.col(stripped_name(c.position)), c.typ)
        for c in source.columns
        if c.name in mapped and c.typ == "integer"
    ]
    if not tests:
        return F.lit(False)
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("n_errors") == 0)


def bad_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("n_errors") > 0)


def type_reason(c: ColumnDef) -> str:
    return f"passt nicht zu Typ '{c.typ}'" + (f" / Muster '{c.muster}'" if c.muster else "")


def _findings(source: SourceDef) -> list[tuple[Column, ColumnDef | None, str, Column]]:
    """Every possible finding of a row, in report order: (condition, column, code, reason)."""
    n = F.size("cells")
    arity_ok = n == source.width
    found = [(
        ~arity_ok, None, "COLUMN_COUNT",
        F.concat(F.lit("Spaltenanzahl "), n.cast("string"), F.lit(f" statt {source.width}")),
    )]
    for c in source.columns:
        cell = F.col(stripped_name(c.position))
        filled = arity_ok & (cell != "")
        if c.pflicht:
            found.append((arity_ok & (cell == ""), c, "REQUIRED_EMPTY", F.lit(REQUIRED_REASON)))
        fits = filled_fits(cell, c)
        found.append((filled & ~fits, c, "TYPE_OR_PATTERN", F.lit(type_reason(c))))
        for test, code, word, bound in (
            (below_minimum(cell, c), "BELOW_MIN", "kleiner als Minimum", c.minimum),
            (above_maximum(cell, c), "ABOVE_MAX", "groesser als Maximum", c.maximum),
        ):
            if test is not None:
                found.append((filled & fits & test, c, code, F.lit(f"{word} {float(bound)}")))
    return found


def errors(parsed: DataFrame, source: SourceDef) -> DataFrame:
    """One row per finding: (file, nr, position, column, value, code, reason).

    ``value`` is the untrimmed cell; a wrong column count has position -1 and no column.
    """
    slots = []
    for condition, c, code, reason in _findings(source):
        position = -1 if c is None else c.position
        value = F.lit(None).cast("string") if c is None else cell_at(F.col("cells"), c.position)
        entry = F.struct(
            F.lit(position).alias("position"),
            F.lit(None if c is None else c.name).cast("string").alias("column"),
            value.alias("value"),
            F.lit(code).alias("code"),
            reason.alias("reason"),
        )
        slots.append(F.when(condition, entry))
    kept = [c for c in parsed.columns if c not in ("cells", "odd_space")]
    return (
        bad_rows(check(parsed, source))
        .select(*kept, F.inline(F.array(*slots)))
        .filter(F.col("code").isNotNull())
    )


def row_reasons(source: SourceDef) -> Column:
    """All reasons of a checked row as one text: ``column: reason`` joined by `` | ``."""
    return F.concat_ws(
        " | ",
        *(
            F.when(cond, reason if c is None else F.concat(F.lit(f"{c.name}: "), reason))
            for cond, c, _, reason in _findings(source)
        ),
    )


def quarantine(parsed: DataFrame, source: SourceDef) -> DataFrame:
    """Bad rows for the quarantine: (file, zeile_nr, fehler_grund, original_zeile)."""
    return bad_rows(check(parsed, source)).select(
        "file",
        F.col("nr").alias("zeile_nr"),
        row_reasons(source).alias("fehler_grund"),
        F.concat_ws("|", "cells").alias("original_zeile"),
    )


def file_counts(checked: DataFrame) -> DataFrame:
    """Per file: data rows, bad rows, findings, rows with an integer overflow."""
    good = F.col("n_errors") == 0
    return checked.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(~good).alias("rows_bad"),
        F.sum("n_errors").alias("n_errors"),
        F.count_if(good & F.col("overflow")).alias("rows_overflow"),
    )


def verdicts(files: DataFrame, counts: DataFrame, partial: bool | Column) -> DataFrame:
    """Decide per file whether it (or its good part) may be loaded.

    ``files`` lists every file, so a file without rows gets its verdict too.  ``partial`` is
    a flag or a boolean column of ``files``.
    """
    partial = F.lit(partial) if isinstance(partial, bool) else partial
    names = ("rows_total", "rows_bad", "n_errors", "rows_overflow")
    joined = files.join(counts, "file", "left").withColumns(
        {n: F.coalesce(F.col(n), F.lit(0)) for n in names}
    )
    total, bad = F.col("rows_total"), F.col("rows_bad")
    valid = F.when(partial, total > bad).otherwise((bad == 0) & (total > 0))
    capped = ~partial & (F.col("n_errors") >= MAX_REPORTED_ERRORS)
    reason = F.when(
        partial,
        F.concat(
            F.lit("Alle "), total.cast("string"),
            F.lit(" Zeilen fehlerhaft (partieller Modus, aber nichts zu laden)"),
        ),
    ).otherwise(
        F.concat(
            bad.cast("string"), F.lit(" von "), total.cast("string"), F.lit(" Zeilen fehlerhaft"),
            F.when(capped, F.lit(" (Anzeige nach 50 Fehlern abgebrochen)")).otherwise(F.lit("")),
        )
    )
    return joined.select(
        "*",
        capped.alias("report_capped"),
        valid.alias("valid"),
        F.when(~valid, reason).alias("invalid_reason"),
    )


def error_report(found: DataFrame, limit: int | None = MAX_REPORTED_ERRORS) -> DataFrame:
    """The first errors of each file in row and column order; all of them with ``limit=None``.

    Spark pushes the limit below the shuffle (window group limit), so a file with a billion
    bad rows sends at most ``limit`` of them per task.
    """
    if limit is None:
        return found
    order = Window.partitionBy("file").orderBy("nr", "position", "code")
    ranked = found.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")


def error_line(nr: Column, column: Column, value: Column, reason: Column) -> Column:
    """Report text of one finding."""
    row = F.concat(F.lit("Zeile "), nr.cast("string"))
    return F.when(column.isNull(), F.concat(row, F.lit(": "), reason)).otherwise(
        F.concat(row, F.lit(", Spalte '"), column, F.lit("': '"), value, F.lit("' — "), reason)
    )

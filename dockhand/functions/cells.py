"""Cell semantics as Column expressions: the single definition of every cell type.

Classification, validation and mapping all use these builders, so the three stages cannot
disagree about what a valid cell is.  Everything is a built-in expression that stays inside
whole-stage code generation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockhand.catalog import NUMERIC_TYPES, ColumnDef, java_pattern

# Cell syntax per type, and the words that are booleans.  The common form of a
# decimal stands first and repeats are possessive, as a failed match then gives up at once.
INTEGER = r"^-?\d+$"
DECIMAL_DE = r"^-?\d++(?:,\d++)?$|^-?\d{1,3}(?:\.\d{3})++(?:,\d++)?$"
DECIMAL_EN = r"^-?\d++(?:\.\d++)?$|^-?\d{1,3}(?:,\d{3})++(?:\.\d++)?$"
DATE_DMY = r"^\d{1,2}\.\d{1,2}\.\d{4}$"
DATE_ISO = r"^\d{4}-\d{2}-\d{2}$"
TRUE_WORDS = ("1", "ja", "true", "y", "j")
FALSE_WORDS = ("0", "nein", "false", "n")

WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1


def strip(cell: Column, odd_space: Column | None = None) -> Column:
    """Remove Unicode whitespace at both ends.

    Trimming a set of characters is slow.  ``odd_space`` says whether the cell may hold any
    whitespace but blanks; where it is false, the plain trim gives the same result.
    """
    full = F.trim(cell, F.lit(WHITESPACE))
    return full if odd_space is None else F.when(odd_space, full).otherwise(F.trim(cell))


def has_odd_space(line: Column, delimiter: str) -> Column:
    """May a record contain whitespace other than blanks?

    Anything outside printable ASCII counts: one range is far cheaper to test than the set.
    """
    return F.lit(True) if delimiter.isspace() else line.rlike("[^ -~]")


def _escaped(delimiter: str) -> str:
    return delimiter if delimiter.isalnum() else "\\" + delimiter


def tokenize(line: Column, delimiter: str) -> Column:
    """Split one record into the texts of its cells: ARRAY<STRING>.

    A quote opens a quoted cell only as its first character; inside, a doubled quote is a
    quote and the delimiter is text; what follows the closing quote belongs to the cell.
    Only lines with a quote pay for that; all others are a plain split.
    """
    d = _escaped(delimiter)
    quoted = f"{d}({_QUOTED}\"?[^{d}]*+|[^{d}]*+)"
    cells = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(quoted), F.lit(1))
    return F.when(F.contains(line, F.lit('"')), F.transform(cells, _unquote)).otherwise(
        F.split(line, d, -1)
    )


def _unquote(cell: Column) -> Column:
    body = F.regexp_extract(cell, f"^({_QUOTED})", 1)
    text = F.replace(F.substring(body, 2, 2**31 - 1), F.lit('""'), F.lit('"'))
    rest = F.regexp_replace(cell, f'^{_QUOTED}"?', "")
    return F.when(cell.startswith('"'), F.concat(text, rest)).otherwise(cell)


def cell_at(cells: Column, position: int) -> Column:
    """Untrimmed text of one cell; NULL past the end."""
    return F.get(cells, F.lit(position))


def _iso_text(cell: Column, typ: str) -> Column:
    if typ == "date_iso":
        return cell
    day, month, year = (F.split_part(cell, F.lit("."), F.lit(i)) for i in (1, 2, 3))
    return F.concat_ws("-", year, month, day)


def _as_date(cell: Column, typ: str) -> Column:
    return _iso_text(cell, typ).try_cast("date")


def type_fits(cell: Column, typ: str) -> Column:
    """Does a stripped cell look like this type (and, for dates, exist in the calendar)?"""
    if typ == "string":
        return F.lit(True)
    if typ == "integer":
        # A cast alone won't do: it trims control characters and takes a plus sign.
        return cell.rlike(INTEGER)
    if typ == "decimal_de":
        return cell.rlike(DECIMAL_DE)
    if typ == "decimal_en":
        return cell.rlike(DECIMAL_EN)
    if typ in ("date_dmy", "date_iso"):
        syntax = DATE_DMY if typ == "date_dmy" else DATE_ISO
        date = _as_date(cell, typ)
        return F.when(cell.rlike(syntax), date.isNotNull() & (F.year(date) >= 1)).otherwise(False)
    if typ == "boolean":
        return F.lower(cell).isin(*TRUE_WORDS, *FALSE_WORDS)
    return F.lit(False)


def pattern_fits(cell: Column, pattern: str) -> Column:
    """Regular expression anchored at the start only."""
    return cell.rlike(java_pattern(pattern))


def filled_fits(cell: Column, column: ColumnDef) -> Column:
    """Type and pattern test of a stripped cell that is not empty."""
    fits = type_fits(cell, column.typ)
    if column.muster is not None:
        fits = fits & pattern_fits(cell, column.muster)
    return fits


def convert(cell: Column, typ: str) -> Column:
    """Typed value of a stripped cell that fits its type; empty becomes NULL."""
    if typ == "string":
        return F.nullif(cell, F.lit(""))
    if typ == "integer":
        return cell.try_cast("bigint")
    if typ == "decimal_de":
        plain = F.replace(F.replace(cell, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
        return plain.try_cast("double")
    if typ == "decimal_en":
        return F.replace(cell, F.lit(","), F.lit("")).try_cast("double")
    if typ in ("date_dmy", "date_iso"):
        return F.when(cell != "", _as_date(cell, typ))
    if typ == "boolean":
        return F.when(cell != "", F.lower(cell).isin(*TRUE_WORDS))
    raise ValueError(f"unknown cell type '{typ}'")


def typed_value(cell: Column, typ: str) -> Column | None:
    """The value of a stripped cell, NULL where it does not fit its type (or is an integer of more
    than 64 bits): test and conversion in one.  None for strings, which are their own value."""
    if typ == "string":
        return None
    if typ == "integer":
        # Digits written the usual way need no pattern: the number reads as the cell does.
        value = cell.try_cast("bigint")
        return F.when((value.cast("string") == cell) | cell.rlike(INTEGER), value)
    if typ in ("date_dmy", "date_iso"):
        syntax, zero = (DATE_DMY, F.endswith) if typ == "date_dmy" else (DATE_ISO, F.startswith)
        return F.when(cell.rlike(syntax) & ~zero(cell, F.lit("0000")), _as_date(cell, typ))
    return F.when(type_fits(cell, typ), convert(cell, typ))


def value_fits(cell: Column, value: Column | None, typ: str) -> Column:
    """Does a stripped, filled cell fit its type?  ``value`` comes from :func:`typed_value`."""
    if value is None:
        return F.lit(True)
    if typ == "integer":
        return value.isNotNull() | overflows(cell, typ)
    return value.isNotNull()


def overflows(cell: Column, typ: str) -> Column | None:
    """An integer cell of more than 64 bits; no target column can hold it."""
    if typ != "integer":
        return None
    return (F.length(cell) > 18) & cell.rlike(INTEGER) & cell.try_cast("bigint").isNull()


def below_minimum(cell: Column, column: ColumnDef, value: Column | None = None) -> Column | None:
    """``value``: the typed value, if it is there already."""
    if column.minimum is None or column.typ not in NUMERIC_TYPES:
        return None
    return _out_of_range(cell, column, convert(cell, column.typ) if value is None else value, lower=True)


def above_maximum(cell: Column, column: ColumnDef, value: Column | None = None) -> Column | None:
    if column.maximum is None or column.typ not in NUMERIC_TYPES:
        return None
    return _out_of_range(cell, column, convert(cell, column.typ) if value is None else value, lower=False)


def _out_of_range(cell: Column, column: ColumnDef, value: Column, lower: bool) -> Column:
    bound = column.minimum if lower else column.maximum
    if column.typ != "integer" or math.isinf(bound):
        return (value < F.lit(float(bound))) if lower else (value > F.lit(float(bound)))
    # Compare integers as integers: a double cannot tell neighbours apart above 2**53.
    whole = math.ceil(bound) if lower else math.floor(bound)
    if not _LONG_MIN <= whole <= _LONG_MAX:
        return F.lit(whole > 0) if lower else F.lit(whole < 0)
    inside = (value < F.lit(whole)) if lower else (value > F.lit(whole))
    beyond = cell.startswith("-") if lower else ~cell.startswith("-")
    return F.when(value.isNull(), beyond).otherwise(inside)

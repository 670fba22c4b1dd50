"""Registry of derived target fields: values that come from the load, not from a cell.

An entry maps a function name to ``Callable[[LoadContext], Column]``; additions therefore
stay visible to Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockhand.functions.text import file_name


@dataclass(frozen=True)
class LoadContext:
    """One load time per run, so every row of a run gets the same derived values."""

    load_time: datetime
    file: Column


DERIVED_FIELDS: dict[str, Callable[[LoadContext], Column]] = {
    "ladezeitpunkt_jahrmonat": lambda ctx: F.lit(f"{ctx.load_time:%Y%m}"),
    "ladezeitpunkt_datum": lambda ctx: F.lit(ctx.load_time.date()),
    "dateiname": lambda ctx: file_name(ctx.file),
}

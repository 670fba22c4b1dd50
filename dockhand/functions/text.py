"""Small string expressions: file names, disposition paths, percent and score formatting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    """Plain file name of a path as Spark reports it (percent-encoded URI)."""
    last = F.element_at(F.split(path, "/"), -1)
    decoded = F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(last, F.lit("%")), F.coalesce(decoded, last)).otherwise(last)


def stamped_name(name: Column, when: datetime) -> Column:
    """``stem.ext`` becomes ``stem__yyyymmdd_hhmmss.ext``; without a dot the stamp is appended."""
    stamp = f"__{when:%Y%m%d_%H%M%S}"
    stem = F.regexp_extract(name, r"(?s)^(.*)\.([^.]*)$", 1)
    suffix = F.regexp_extract(name, r"(?s)^(.*)\.([^.]*)$", 2)
    return F.when(
        F.contains(name, F.lit(".")), F.concat(stem, F.lit(stamp + "."), suffix)
    ).otherwise(F.concat(name, F.lit(stamp)))


def archive_path(folder: str, source: Column, name: Column, when: datetime) -> Column:
    return F.concat_ws("/", F.lit(folder), source, stamped_name(name, when))


def reject_path(folder: str, name: Column, when: datetime) -> Column:
    return F.concat_ws("/", F.lit(folder), stamped_name(name, when))


def quarantine_path(folder: str, name: Column, when: datetime) -> Column:
    """``<stem>_fehlerhaft__<stamp>.csv``; the stem drops the last suffix of the name."""
    stem = F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+$", "")
    return F.concat(
        F.lit(folder + "/"), stem, F.lit(f"_fehlerhaft__{when:%Y%m%d_%H%M%S}.csv")
    )


def percent(share: Column) -> Column:
    """Whole percent, halves to even: 0.875 becomes ``88%``."""
    return F.concat(F.bround(share * 100, 0).cast("bigint").cast("string"), F.lit("%"))


def round_half_even(x: Column, digits: int = 4) -> Column:
    """Round a score in [0, 1] by its exact binary value, ties to even.

    ``round`` works on the shortest decimal text of a double and so sees ties where the
    double lies just beside one.  Here the nearest tie is compared with the exact value:
    first as doubles and, if equal, by the tie's own rounding error in integer arithmetic.
    """
    scale = 10**digits
    low = F.floor(x * scale)
    # x * scale may round up across an integer; step back so that low / scale <= x.
    low = F.when(low / F.lit(float(scale)) > x, low - 1).otherwise(low)
    tie = (2 * low + 1) / F.lit(2.0 * scale)
    exact = (tie * F.lit(2.0**62)).cast("bigint").cast("decimal(38,0)") * F.lit(2 * scale)
    wanted = (2 * low + 1).cast("decimal(38,0)") * F.lit(2**62).cast("decimal(38,0)")
    up = (
        F.when(x > tie, True)
        .when(x < tie, False)
        .when(exact > wanted, True)
        .when(exact < wanted, False)
        .otherwise(low % 2 == 1)
    )
    return (low + up.cast("int")) / F.lit(float(scale))

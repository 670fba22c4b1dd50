"""Records that span lines: a quoted cell may contain line breaks.

Whether a line starts inside a quoted cell depends on every line before it.  Each line acts
on that one bit as a function: it sets the bit, clears it, keeps it or flips it.  Functions
compose.  One pass over the lines notes, for each, what both possible states before its run of
lines would make of it; a run is what a task reads in one piece of a file split.  Every run then
is one small row, and composing these gives the state in which each run really begins.  So text
is neither sorted nor shuffled, no task needs more than a split, and files without a line that
leaves a quote open skip all of this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dockhand.functions.cells import tokenize
from dockhand.session import bounded_broadcast, new_work_folder

# A record of several lines is put together whatever its length, up to what one value can hold.
# One above the first limit that has a width no source has is wrong anyway: it stays one record
# with the number of cells it has, and its text goes to the quarantine line by line.  So does one
# above the second limit.  Other records of the file are not concerned.
MAX_RECORD_CHARS = 16 * 1024 * 1024
MAX_VALUE_CHARS = 1024 * 1024 * 1024
LONG_RECORD = "Datensatz mit {} Zeichen"

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'


def _whole_cell(delimiter: str) -> tuple[str, str]:
    """Patterns of one complete cell without its delimiter, and of the delimiter."""
    d = delimiter if delimiter.isalnum() else "\\" + delimiter
    return f'(?:"{_INSIDE}"[^{d}]*+|[^"{d}][^{d}]*+|)', d


def leaves_open(line: Column, delimiter: str) -> Column:
    """A line that starts outside of quotes and ends inside a quoted cell."""
    cell, d = _whole_cell(delimiter)
    pattern = f'^(?:{cell}{d})*+"{_INSIDE}$'
    return F.contains(line, F.lit('"')) & line.rlike("(?s)" + pattern)


def stays_open(line: Column, delimiter: str) -> Column:
    """A line that starts inside a quoted cell and ends inside the same or another one."""
    cell, d = _whole_cell(delimiter)
    same = f"^{_INSIDE}$"
    later = f'^{_INSIDE}"[^{d}]*+{d}(?:{cell}{d})*+"{_INSIDE}$'
    return line.rlike(f"(?s)(?:{same})|(?:{later})")


_STATES = T.StructType(
    [T.StructField("_run", T.LongType())]
    + [T.StructField(n, T.BooleanType()) for n in ("_in0", "_in1", "_open0", "_open1")]
    + [T.StructField(n, T.LongType()) for n in ("_own0", "_own1")]
)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each line, for both states (0 outside, 1 inside) before its run: the state before
    and after the line, and the records begun in the run so far.  A run is named by its first rid."""
    before, run, state, begun = None, 0, (False, True), (0, 0)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, block, rid = batch.column("file"), batch.column("block").to_numpy(), batch.column("rid").to_numpy()
        opens, stays = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_opens", "_stays"))
        new = np.ones(n, bool)
        other = pc.not_equal(file.slice(1), file.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[1:] = (rid[1:] != rid[:-1] + 1) | (block[1:] != block[:-1]) | other
        new[0] = before != (file[0].as_py(), block[0], rid[0])
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(new, at, -1))  # -1: the run of the batch before goes on
        flips = np.concatenate([[0], np.cumsum(opens & ~stays)])
        setting = np.maximum.accumulate(np.where(opens == stays, at, -1))
        setting = np.concatenate([[-1], setting[:-1]])  # last line before this one that sets the bit
        known = (setting >= 0) & (setting >= start)
        parity = (flips[at] - flips[np.where(known, setting + 1, np.maximum(start, 0))]) & 1
        columns = {"_run": pa.array(np.where(start < 0, run, rid[np.maximum(start, 0)]))}
        after, count = [], []
        for e in (0, 1):
            entry = np.where(start < 0, state[e], bool(e))
            inside = np.where(known, opens[setting], entry) ^ (parity == 1)
            opened = np.where(inside, stays, opens)
            total = np.concatenate([[0], np.cumsum(~inside)])
            own = total[1:] - total[np.maximum(start, 0)] + np.where(start < 0, begun[e], 0)
            columns |= {f"_in{e}": pa.array(inside), f"_open{e}": pa.array(opened), f"_own{e}": pa.array(own)}
            after.append(bool(opened[-1]))
            count.append(int(own[-1]))
        run, state, begun = int(columns["_run"][-1].as_py()), tuple(after), tuple(count)
        before = (file[-1].as_py(), block[-1], rid[-1] + 1)
        kept = [c for c in batch.schema.names if c not in ("_opens", "_stays")]
        arrays = [batch.column(c) for c in kept] + [columns[f.name] for f in _STATES]
        yield pa.RecordBatch.from_arrays(arrays, [*kept, *_STATES.names])


def number_records(lines: DataFrame, delimiter: str, folder: str | None = None) -> DataFrame:
    """Add ``nr``, the record number, ``inside`` (the line begins inside of quotes) and ``multi``
    (its record has several lines) to lines of files with open quotes.

    ``lines`` has (file, block, rid, line), rids of a block rising by one.  Lines in any other
    order are right too, but make many runs.  Working tables go into ``folder``.
    """
    spark, line = lines.sparkSession, F.col("line")
    acts = lines.withColumns({"_opens": leaves_open(line, delimiter), "_stays": stays_open(line, delimiter)})
    schema = T.StructType(lines.schema.fields + _STATES.fields)
    folder = folder or new_work_folder(spark, "quotes")
    acts.mapInArrow(_states, schema).write.parquet(f"{folder}/lines")
    noted = spark.read.schema(schema).parquet(f"{folder}/lines")

    runs = noted.groupBy("file", "block", "_run").agg(
        F.max_by(F.struct("_open0", "_open1"), "rid").alias("_end"),
        F.count_if(~F.col("_in0")).alias("_n0"), F.count_if(~F.col("_in1")).alias("_n1"),
    )
    in_order = Window.partitionBy("file").orderBy("block", "_run")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    first, second = F.col("_end._open0").cast("int"), F.col("_end._open1").cast("int")
    # A run sets the bit when both states end alike; else it keeps (0) or flips (1) it.
    entry = (
        runs.withColumns({"_set": F.when(first == second, first), "_flip": F.when(first != second, first).otherwise(F.lit(0))})
        .withColumn("_all", F.sum("_flip").over(in_order))
        .withColumn("_anchor", F.col("_set") + F.col("_all"))
        .withColumn("_bit", (F.coalesce(F.last("_anchor", ignorenulls=True).over(earlier), F.lit(0)) + F.col("_all") - F.col("_flip")) % 2 == 1)
        .withColumn("_n", F.when(F.col("_bit"), F.col("_n1")).otherwise(F.col("_n0")))
        .select("file", "block", "_run", "_bit", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    entry.write.parquet(f"{folder}/runs")
    entry = spark.read.schema(entry.schema).parquet(f"{folder}/runs")
    size = entry.agg(F.sum(F.length(F.col("file").cast("string")) + F.lit(64)).alias("size")).first()["size"] or 0
    known = noted.join(bounded_broadcast(entry, size), ["file", "block", "_run"])
    of_state = lambda name: F.when(F.col("_bit"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    return known.select(
        *lines.columns, of_state("_in").alias("inside"), (of_state("_in") | of_state("_open")).alias("multi"),
        (F.col("_before") + of_state("_own")).alias("nr"),
    )


def long_records(numbered: DataFrame, delimiter: str, widths: tuple[int, ...] = ()) -> DataFrame:
    """(file, nr, chars, cells) of the records of several lines that are not put together.

    Lengths and cells are summed line by line; a line that starts inside of quotes is cut as if
    it began with one."""
    several = numbered.filter("multi")
    lengths = several.groupBy("file", "nr").agg(F.sum(F.length("line") + 1).alias("chars")).filter(F.col("chars") > MAX_RECORD_CHARS)
    cut = tokenize(F.when(F.col("inside"), F.concat(F.lit('"'), F.col("line"))).otherwise(F.col("line")), delimiter)
    counted = several.join(lengths, ["file", "nr"]).groupBy("file", "nr", "chars").agg((F.sum(F.size(cut) - 1) + 1).alias("cells"))
    wrong = ~F.col("cells").isin(*widths) if widths else F.lit(False)
    return counted.filter(wrong | (F.col("chars") > MAX_VALUE_CHARS))


def pieces(numbered: DataFrame, long: DataFrame) -> DataFrame:
    """The lines of long records: (file, zeile_nr, block, rid, line)."""
    lines = numbered.join(long.select("file", "nr"), ["file", "nr"], "left_semi")
    return lines.select("file", F.col("nr").alias("zeile_nr"), "block", "rid", "line")


def _stand_ins(long: DataFrame, delimiter: str, widths: tuple[int, ...]) -> DataFrame:
    """One line per long record with as many cells as it has, the first telling its length.

    A record as wide as a source would pass for one of it, so it gets a cell too many."""
    fits = F.col("cells").isin(*widths) if widths else F.lit(False)
    cells = F.when(fits, F.lit(max(widths, default=0) + 1)).otherwise(F.col("cells"))
    before, after = LONG_RECORD.split("{}")
    text = F.concat(F.lit(before), F.col("chars").cast("string"), F.lit(after))
    # More cells than any source has are one kind of wrong; there is no need for all of them.
    blanks = F.least(cells - 1, F.lit(max(widths, default=0) + 1_000)).cast("int")
    return long.select("file", "nr", F.concat(text, F.repeat(F.lit(delimiter), blanks)).alias("line"))


def join_lines(numbered: DataFrame, delimiter: str, widths: tuple[int, ...] = (), long: DataFrame | None = None) -> DataFrame:
    """One row per record: (file, nr, line); lines of a record are joined by a line feed.

    Only records of several lines are grouped.  ``widths`` are the cell counts of the sources
    (none: any will do), ``long`` the result of :func:`long_records` if it is there already.
    """
    long = long_records(numbered, delimiter, widths) if long is None else long
    single = numbered.filter(~F.col("multi")).select("file", "nr", "line")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block", "rid", "line"))), lambda p: p["line"])
    several = (
        numbered.filter("multi").join(long, ["file", "nr"], "left_anti")
        .groupBy("file", "nr")
        .agg(F.concat_ws("\n", parts).alias("line"))
    )
    return single.unionByName(several).unionByName(_stand_ins(long, delimiter, widths))

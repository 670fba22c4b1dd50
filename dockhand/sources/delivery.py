"""Delivered files: listing, landing and record numbers.

``land`` copies the raw lines of an inbox once into a Parquet table.  From then on every
stage sees the same bytes even if a file in the inbox changes, and the line index (counts,
numbering offsets, encoding evidence) comes from a few narrow columns instead of a second
pass over the text.

Line numbers need no window over the data.  A line carries the file split it came from
(``block``) and an id that rises inside its task (``rid``); the running sum of line counts
over the splits of a file, a small table, gives the offset of each split.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote
from zoneinfo import ZoneInfo

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockhand.functions.text import file_name
from dockhand.sources.encoding import detected_encoding, undecodable
from dockhand.sources.quoting import leaves_open
from dockhand.session import bounded_broadcast, small_table

_WILD = re.compile(r"([*?{}\[\]\\])")

RAW_SCHEMA = "file string, block bigint, rid bigint, raw binary"


@dataclass(frozen=True)
class Landing:
    """Tables of one landed delivery."""

    lines: DataFrame  # file, block, rid, raw (BINARY), evidence flags
    blocks: DataFrame  # file, block, n, first_rid, start: one row per file split
    files: DataFrame  # file, name, file_seq, n_lines, dateihash, all_utf8, all_cp1252, spans_<i>
    index_bytes: int  # measured size of ``blocks``


@dataclass(frozen=True)
class Inbox:
    """One listing of an inbox: what Spark reads of it, and the files it must refuse."""

    text: DataFrame | None  # text scan
    paths: list[str]  # files of the inbox itself, in the order of their names
    hidden: list[str]  # files that Spark's readers pass over


def open_inbox(spark: SparkSession, folder: str, before: datetime | None = None) -> Inbox:
    """Text scan of a folder, and its files in the order of their names.

    Scan and list come from one listing, so files that arrive later are in neither.  A
    missing folder counts as empty.  Subfolders are not looked into, whatever their name; dot
    files are no delivery.  ``before`` leaves out files changed at or after that time, which may
    still be in writing; without a time zone it is local time.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if before is not None:
        at = before.astimezone(ZoneInfo(spark.conf.get("spark.sql.session.timeZone")))
        reader = reader.option("modifiedBefore", f"{at:%Y-%m-%dT%H:%M:%S}")
    try:
        text = reader.text(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return Inbox(None, [], [])
        raise
    listed, root = _listed(spark, folder)
    listed = [f for f in listed if _name(f[0]).startswith("_")]
    every = text.inputFiles()
    paths = sorted((p for p in every if root is None or _parent(p) == root), key=_name)
    if len(paths) < len(every):  # folders in it: read the files of the inbox alone
        text = _text_of(spark, [unquote(p) for p in paths])
    limit = None if before is None else before.timestamp() * 1000
    hidden = sorted((p for p, changed, _ in listed if limit is None or changed < limit), key=_name)
    return Inbox(text, paths, hidden)


def open_files(spark: SparkSession, folder: str, names: list[str]) -> Inbox:
    """The same for listed files of a folder; others, of folders in it, are left out."""
    root = _listed(spark, folder)[1]
    own = [n for n in names if root is None or unquote(_parent(plain(n))) == unquote(root)]
    if not own:
        return Inbox(None, [], [])
    text = _text_of(spark, own)
    return Inbox(text, sorted(text.inputFiles(), key=_name), [])


def _text_of(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Text scan of these files and no others."""
    if not paths:
        return None
    return spark.read.option("recursiveFileLookup", True).text([_WILD.sub(r"\\\1", p) for p in paths])


def only(spark: SparkSession, inbox: Inbox, paths: list[str]) -> Inbox:
    """The same inbox with some of its files."""
    return Inbox(_text_of(spark, [unquote(p) for p in paths]), paths, inbox.hidden)


def read_through(spark: SparkSession, paths: list[str]) -> None:
    """Read files to their end; an error if one of them can't be."""
    _text_of(spark, [unquote(p) for p in paths]).write.format("noop").mode("overwrite").save()


def unread_files(spark: SparkSession, folder: str) -> tuple[list[str], list[str]]:
    """Files that no scan shows, as they are empty, and those whose names begin with '_'."""
    listed = _listed(spark, folder)[0]
    hidden = sorted((p for p, _, _ in listed if _name(p).startswith("_")), key=_name)
    return sorted((p for p, _, n in listed if not n and p not in hidden), key=_name), hidden


def changes(spark: SparkSession, folder: str) -> dict[str, tuple[int, int]]:
    """Time of last change (milliseconds) and length of each file of a folder, by plain path."""
    return {unquote(p): (changed, length) for p, changed, length in _listed(spark, folder)[0]}


def _listed(spark: SparkSession, folder: str) -> tuple[list[tuple[str, int, int]], str | None]:
    """Files of a folder with the time of their last change and their length, and the folder as it
    stands in paths; neither for a path with wildcards.  Dot files and the mark that a finished
    Spark job leaves are no delivery."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return [], None
    found = [
        (plain(f.getPath().toUri().toString()), f.getModificationTime(), f.getLen())
        for f in fs.listStatus(path)
        if f.isFile() and not f.getPath().getName().startswith(".") and f.getPath().getName() != "_SUCCESS"
    ]
    return found, plain(fs.makeQualified(path).toUri().toString()).rstrip("/")


def plain(uri: str) -> str:
    """Local paths as Spark writes them in its file lists."""
    return "file:///" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def _parent(path: str) -> str:
    return path.rsplit("/", 1)[0]


def _name(path: str) -> str:
    return unquote(path.rsplit("/", 1)[-1])


def file_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, file_seq): the files in processing order, which is the order of their names."""
    rows = [(p, i) for i, p in enumerate(paths)]
    return small_table(spark, rows, "file string, file_seq int")


def raw_lines(inbox: Inbox) -> DataFrame | None:
    """Lines of the files of an inbox with their split and rising id."""
    if inbox.text is None:
        return None
    return inbox.text.select(
        F.input_file_name().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("rid"),
        F.col("value").cast("binary").alias("raw"),
    )


def with_evidence(lines: DataFrame, delimiters: list[str]) -> DataFrame:
    """Add what the index needs to know of each line: encoding and open quotes."""
    raw = F.col("raw")
    bad_utf8 = undecodable(raw, "utf-8")
    spans = {
        spans_name(i): leaves_open(raw.cast("string"), d) for i, d in enumerate(delimiters)
    }
    return lines.withColumns({
        # Two marks of the line's bytes; with its number they make up the identity of the file.
        "mark_a": F.xxhash64(F.lit(1), raw),
        "mark_b": F.xxhash64(F.lit(2), raw),
        "utf8_ok": ~bad_utf8,
        "cp1252_ok": F.when(bad_utf8, ~undecodable(raw, "cp1252")).otherwise(True),
        **spans,
    })


def spans_name(i: int) -> str:
    return f"spans_{i}"


def land(
    spark: SparkSession,
    raw: DataFrame | None,
    files: DataFrame,
    folder: str,
    delimiters: list[str],
    single_byte: tuple[str, ...] = (),
) -> Landing:
    """Write the landing table of raw lines and derive its line index.

    ``files`` comes from :func:`file_table`; ``single_byte`` names declared encodings, for
    which undecodable lines are counted per file.
    """
    declared = {undecodable_name(e): undecodable(F.col("raw"), e) for e in single_byte}
    if raw is None:
        raw = small_table(spark, [], RAW_SCHEMA)
    marked = with_evidence(raw, delimiters).withColumns(declared)
    marked.write.mode("overwrite").parquet(f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")

    flags = [spans_name(i) for i in range(len(delimiters))] + list(declared)
    per_block = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("rid").alias("first_rid"),
        F.bool_and("utf8_ok").alias("utf8_ok"),
        F.bool_and("cp1252_ok").alias("cp1252_ok"),
        *(F.bool_or(f).alias(f) for f in flags),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = per_block.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    numbered.write.mode("overwrite").parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")

    per_file = blocks.groupBy("file").agg(
        F.sum("n").alias("n_lines"),
        F.bool_and("utf8_ok").alias("all_utf8"),
        F.bool_and("cp1252_ok").alias("all_cp1252"),
        *(F.bool_or(f).alias(f) for f in flags),
    )
    size = blocks.agg(F.sum(F.length("file") + F.lit(64)).alias("size")).first()["size"] or 0
    identity = content_identity(lines, blocks, size)
    listed = files.join(per_file, "file", "left").join(identity, "file", "left").select(
        "file",
        file_name(F.col("file")).alias("name"),
        "file_seq",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("dateihash", _identity_text(F.lit(0), F.lit(0), F.lit(0))).alias("dateihash"),
        F.coalesce("all_utf8", F.lit(True)).alias("all_utf8"),
        F.coalesce("all_cp1252", F.lit(True)).alias("all_cp1252"),
        *(F.coalesce(f, F.lit(False)).alias(f) for f in flags),
    )
    listed.write.mode("overwrite").parquet(f"{folder}/files")
    return Landing(lines, blocks, spark.read.parquet(f"{folder}/files"), size)


def content_identity(lines: DataFrame, blocks: DataFrame, index_bytes: int) -> DataFrame:
    """(file, dateihash): an identity of what a file holds, whatever its name.

    Every line gives a mark that depends on its bytes and its number; marks are combined in any
    order, so splits, tasks and the size of a file play no part, and members of archives have an
    identity too.  Files are equal if they have the same lines: line ends and a byte order mark
    don't count.  Two sums of 64 bits tell files apart that differ by accident; they are no
    protection against files made to collide.
    """
    side = bounded_broadcast(blocks.select("file", "block", "first_rid", "start"), index_bytes)
    marks = lines.select("file", "block", "rid", "mark_a", "mark_b").join(side, ["file", "block"])
    sums = [F.bit_xor(F.xxhash64(line_number(), F.col(m))) for m in ("mark_a", "mark_b")]
    return marks.groupBy("file").agg(_identity_text(F.count(F.lit(1)), *sums).alias("dateihash"))


def _identity_text(n: Column, a: Column, b: Column) -> Column:
    return F.sha2(F.concat_ws(":", n.cast("string"), F.hex(a.cast("bigint")), F.hex(b.cast("bigint"))), 256)


def undecodable_name(encoding: str) -> str:
    return "undecodable_" + encoding.replace("-", "_")


def number_lines(landing: Landing, files: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Lines of the given files with their number: (file, nr, raw, *columns of ``files``).

    The join key is the file split, so even a shuffled join has no group larger than one
    split, whatever share of the data one file holds.
    """
    side = landing.blocks.select("file", "block", "first_rid", "start").join(
        files.select("file", *columns), "file"
    )
    joined = landing.lines.join(bounded_broadcast(side, landing.index_bytes), ["file", "block"])
    return joined.select("file", line_number().alias("nr"), "raw", *columns)


def line_number() -> Column:
    return F.col("start") + F.col("rid") - F.col("first_rid") + 1


def head_lines(landing: Landing, rows: int) -> DataFrame:
    """The first lines of every file: (file, nr, raw).

    Only the splits that hold the first lines take part: the others drop out of the side
    table, so their lines never match.
    """
    side = landing.blocks.filter(F.col("start") < rows).select("file", "block", "first_rid", "start")
    joined = landing.lines.join(bounded_broadcast(side, landing.index_bytes), ["file", "block"])
    numbered = joined.select("file", line_number().alias("nr"), "raw")
    return numbered.filter(F.col("nr") <= rows)


def file_encoding() -> Column:
    """Detected encoding of a row of ``Landing.files``."""
    return detected_encoding(F.col("all_utf8"), F.col("all_cp1252"))


def content_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """SHA-256 of every file: (file, dateihash).  Spark reads binary files up to 2 GB."""
    return spark.read.format("binaryFile").load(folder).select(
        F.input_file_name().alias("file"), F.sha2("content", 256).alias("dateihash")
    )

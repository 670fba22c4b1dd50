"""Load operators: how incoming rows meet the rows a keyed table already holds.

A key with a NULL part never conflicts, as in an SQL UNIQUE constraint.  Within a batch the
files count as loaded one after another, so the order of rows is (file_seq, nr).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockhand.session import small_table

ORDER = ("file_seq", "nr")
_BLOCK_BITS = 16  # of a place; the rest is its block
FEW = 200_000  # (set, file) pairs that reject mode settles on the driver; the verdicts don't depend on it


def key_is_complete(key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])


def one_per_key(rows: DataFrame, key: list[str], last: bool = False) -> DataFrame:
    """First (or last) row of each complete key, and all rows whose key is incomplete.

    The rank limit is pushed below the shuffle, so of a key that fills a third of the data
    each task sends one row.
    """
    order = [F.desc(c) if last else F.asc(c) for c in ORDER]
    alone = F.when(~key_is_complete(key), F.struct(*ORDER))
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key, alone).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def rows_to_skip_load(rows: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """Skip mode: rows to append.  Existing keys stay; the first row of a new key wins."""
    return one_per_key(rows, key).join(table.select(*key), key, "left_anti")


def rows_to_update_load(rows: DataFrame, key: list[str]) -> DataFrame:
    """Update mode: rows that replace or extend the table.  The last row of a key wins."""
    return one_per_key(rows, key, last=True)


def rows_kept(table: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Update mode: table rows whose key does not come in."""
    return table.join(incoming.select(*key), key, "left_anti")


def rows_per_key(rows: DataFrame, key: list[str]) -> DataFrame:
    """Reject mode: complete keys of each file with their row count (file_seq, *key, n)."""
    keyed = rows.filter(key_is_complete(key))
    return keyed.groupBy("file_seq", *key).agg(F.count(F.lit(1)).alias("n"))


def reject_verdicts(
    spark: SparkSession, per_key: DataFrame, table: DataFrame, key: list[str], folder: str, few: int = FEW
) -> DataFrame:
    """Reject mode: (file_seq, conflicts, repeats) per file that has keys.

    A file with ``conflicts`` rows whose key exists is rejected; one that repeats a key inside
    itself fails to load.  Whether an earlier file of the batch counts depends on its own
    verdict, see :func:`losers`.  Only keys that several files share take part in that.
    """
    per_key = _saved(spark, per_key, f"{folder}/per_key")
    known = per_key.join(table.select(*key), key, "left_semi")
    in_table = known.groupBy("file_seq").agg(F.sum("n").alias("in_table"))
    repeats = per_key.groupBy("file_seq").agg(F.sum(F.col("n") - 1).alias("repeats"))
    first_look = _saved(
        spark,
        repeats.join(in_table, "file_seq", "left").select(
            "file_seq", "repeats", F.coalesce("in_table", F.lit(0)).alias("in_table")
        ),
        f"{folder}/first_look",
    )
    clean = first_look.filter("in_table = 0 and repeats = 0").select("file_seq")
    several = per_key.groupBy(*key).agg(F.count(F.lit(1)).alias("files")).filter("files > 1")
    shared = _saved(spark, per_key.join(several.select(*key), key), f"{folder}/shared")
    lost = losers(spark, shared.join(clean, "file_seq").select("file_seq", *key), key, folder, few)
    accepted = clean.join(lost, "file_seq", "left_anti")
    owner = shared.join(accepted, "file_seq").select(F.col("file_seq").alias("_owner"), *key)
    beaten = (
        shared.join(owner, key)
        .filter(F.col("_owner") < F.col("file_seq"))
        .groupBy("file_seq")
        .agg(F.sum("n").alias("in_batch"))
    )
    return first_look.join(beaten, "file_seq", "left").select(
        "file_seq",
        (F.col("in_table") + F.coalesce("in_batch", F.lit(0))).alias("conflicts"),
        "repeats",
    )


def losers(
    spark: SparkSession, contested: DataFrame, key: list[str], folder: str, few: int = FEW
) -> DataFrame:
    """Files (file_seq) that share a key with an earlier accepted file, from (file_seq, *key).

    A file is accepted if no earlier accepted file has one of its keys.  Keys with the same files
    are one set, so data of any size shrinks to (set, file) pairs, and only these count from here
    on: up to ``few`` of them are settled one file after the other on the driver, more of them by
    :func:`_settle`.
    """
    contested = _saved(spark, contested, f"{folder}/contested")
    # Sums of 32 bits don't overflow; together they name the set, in 16 bytes.
    parts = [F.sum(F.shiftright(F.xxhash64("file_seq", F.lit(i)), 32)).alias(f"_sum{i}") for i in range(3)]
    counted = contested.groupBy(*key).agg(F.count(F.lit(1)).alias("_files"), *parts).filter("_files > 1")
    name = F.unhex(F.md5(F.concat_ws(":", "_files", *(f"_sum{i}" for i in range(3)))))
    named = counted.select(*key, name.alias("set"))
    members = contested.join(named, key).select("set", "file_seq").distinct()
    members = _saved(spark, members, f"{folder}/members")
    if members.count() <= few:
        taken, lost, sets_of = set(), [], {}
        for row in members.collect():
            sets_of.setdefault(row["file_seq"], []).append(bytes(row["set"]))
        for file, sets in sorted(sets_of.items()):
            if taken.isdisjoint(sets):
                taken.update(sets)
            else:
                lost.append((file,))
        return small_table(spark, lost, "file_seq int")
    return _settle(spark, members, folder)


def _settle(spark: SparkSession, members: DataFrame, folder: str) -> DataFrame:
    """The same in rounds over ids only, one small row per member of a set.

    Verdicts are written as conjunctions.  A file is accepted if each of its sets is free before
    it; a set is free after a member if it was free before and the member is not accepted.  Before
    the second member that is the first one's verdict alone, so pairs need no more than that.  Each
    round puts in known values and, for what hangs on a single other verdict, that one: pointers
    double, so a chain of n files takes about log2(n) rounds.  A conjunction that holds a verdict and its
    opposite is false.  At least the first open verdict is settled per round.
    """
    placed = dense_numbers(spark, members, ["set", "file_seq"], "place", folder)
    # Neighbours are found in blocks of places, which no large set can make uneven; rows at the
    # edge of a block are in the one beside it as well.
    block_of = lambda step: F.shiftright(F.col("place") + step, _BLOCK_BITS)
    blocks = F.array_distinct(F.array(*(block_of(step) for step in (-1, 0, 1, 2))))
    window = Window.partitionBy("block").orderBy("place")
    same = lambda other: F.coalesce(other.over(window) == F.col("set"), F.lit(False))
    linked = placed.select("place", "set", F.col("file_seq").cast("bigint").alias("file"), F.explode(blocks).alias("block"))
    linked = linked.select(
        "file", "place", (F.col("block") == block_of(0)).alias("own"), F.lag("file").over(window).alias("before"),
        same(F.lag("set")).alias("later"), same(F.lag("set", 2)).alias("third"), same(F.lead("set")).alias("earlier"),
    ).filter("own")
    # Verdict of a file: its number.  "Set is free after the member at place p": -(p + 1), from the second member on.
    free_after = -(F.col("place") + 1)
    none = F.lit(None).cast("bigint")
    free_before = F.when(F.col("third"), -F.col("place")).when(F.col("later"), F.col("before"))
    as_value = F.when(F.col("third") | ~F.col("later"), 1).otherwise(0)
    between = linked.filter("earlier and later")
    rules = (
        linked.select(F.col("file").alias("node"), free_before.alias("on"), as_value.alias("is"))
        .unionByName(between.select(free_after.alias("node"), F.col("file").alias("on"), F.lit(0).alias("is")))
        .unionByName(between.select(free_after.alias("node"), free_before.alias("on"), as_value.alias("is")))
    )
    rules = _saved(spark, rules, f"{folder}/rules")
    known, turn = None, 0
    while True:
        # A term without "on" is a constant; "is" tells whether it is true.
        terms = rules.groupBy("node", "on").agg(F.min("is").alias("low"), F.max("is").alias("high"))
        nodes = terms.groupBy("node").agg(
            F.bool_or((F.col("low") < F.col("high")) | (F.col("on").isNull() & (F.col("low") == 0))).alias("fails"),
            F.count("on").alias("open"), F.max(F.struct("on", F.col("low").alias("is"))).alias("only"),
        )
        nodes = _saved(spark, nodes, f"{folder}/nodes-{turn}")
        settled = nodes.filter("fails or open = 0").select("node", none.alias("to"), F.when(F.col("fails"), 0).otherwise(1).alias("as"))
        known = settled if known is None else known.unionByName(settled)
        left = nodes.filter("not fails and open > 0")
        if left.filter("node >= 0").isEmpty():
            break
        single = left.filter("open = 1").select("node", F.col("only.on").alias("to"), F.col("only.is").alias("as"))
        meaning = known.unionByName(single).withColumnRenamed("node", "on")
        open_rules = terms.filter("on is not null").select("node", "on", F.col("low").alias("is")).join(left.select("node"), "node", "left_semi")
        put_in = open_rules.join(meaning, "on", "left")
        agrees = F.when(F.col("is") == F.col("as"), 1).otherwise(0)
        rules = put_in.select(
            "node", F.when(F.col("as").isNull(), F.col("on")).otherwise(F.col("to")).alias("on"),
            F.when(F.col("as").isNull(), F.col("is")).otherwise(agrees).alias("is"),
        )
        turn += 1
        rules = _saved(spark, rules, f"{folder}/rules-{turn}")
    return known.filter("node >= 0 and as = 0").select(F.col("node").cast("int").alias("file_seq"))


def dense_numbers(spark: SparkSession, rows: DataFrame, order: list[str], name: str, folder: str) -> DataFrame:
    """Rows numbered 0, 1, 2... in the given order, without one task that sees them all."""
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = _saved(spark, ordered.withColumn("_at", F.monotonically_increasing_id()), f"{folder}/ordered")
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per partition
    starts, total = [], 0
    for row in sorted(sizes):
        starts.append((row["_part"], total))
        total += row["n"]
    starts = F.broadcast(small_table(spark, starts, "_part bigint, _start bigint"))
    numbered = ordered.withColumn("_part", part).join(starts, "_part")
    return numbered.withColumn(name, F.col("_start") + at).drop("_at", "_part", "_start")


def _saved(spark: SparkSession, frame: DataFrame, path: str) -> DataFrame:
    """Write and read back: cuts the lineage and survives the loss of executors."""
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)

"""Written tables that cut lineage, and components of a graph of any size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.session import new_work_folder

_TYPES = {"long": T.LongType, "int": T.IntegerType, "string": T.StringType, "double": T.DoubleType, "binary": T.BinaryType}


def record(**fields: str | T.DataType) -> T.StructType:
    """A struct type by name; unlike a DDL string it can be made without a session."""
    return T.StructType([T.StructField(k, v if isinstance(v, T.DataType) else _TYPES[v]()) for k, v in fields.items()])


# Rows of whole texts are large: fewer of them in a batch between the JVM and Python.
_BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000")


def bounded(spark: SparkSession) -> SparkSession:
    """Smaller Arrow batches, where the user has not chosen their size."""
    key, default, value = _BATCH_ROWS
    if spark.conf.get(key) == default:
        spark.conf.set(key, value)
    return spark


def written(frame: DataFrame, label: str, compression: str = "zstd", by: str | None = None) -> DataFrame:
    """The frame's rows from a table in the shared work folder: computed once, safe from the
    loss of executors, and without the lineage behind it.  by: a column of few values, each in
    files of its own."""
    spark = frame.sparkSession
    folder = new_work_folder(spark, label)
    frame.write.option("compression", compression).parquet(folder, partitionBy=by)
    return spark.read.schema(frame.schema).parquet(folder)


def nothing(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, but for a collision of 64-bit sums."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node reachable from it.

    Alternating large and small stars: each step links the neighbours of a node to the smallest
    one around, until all edges point at the roots.  Only minima are taken per node, so a node
    with very many neighbours is never gathered; the joins are plain ones that Spark can split.
    edges: columns a and b; loops and repeated edges do no harm, nulls are left out.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, label)
    before = _state(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), label)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def spread(link: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each row of a symmetric link matrix."""
    label = np.arange(len(link))
    rows, columns = np.nonzero(link)
    while True:
        new = label.copy()
        np.minimum.at(new, rows, label[columns])
        new = new[new]
        if (new == label).all():
            return label
        label = new

"""Session settings and working folders the engine relies on."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Generated methods above 8000 bytecodes are never compiled by the JVM.  Wide sources reach
# that size, and Spark is faster when it falls back to its split-up projections there.
_HUGE_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "65535", "8000")


def configure(spark: SparkSession) -> SparkSession:
    """Apply settings that only change speed, where the user has not chosen otherwise."""
    key, default, value = _HUGE_METHOD_LIMIT
    if spark.conf.get(key) == default:
        spark.conf.set(key, value)
    return spark


# A side table is broadcast only below this measured size; above it the join shuffles.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def bounded_broadcast(side: DataFrame, size: int) -> DataFrame:
    """Broadcast a side table of measured size, or leave it to a shuffled join."""
    return F.broadcast(side) if size <= BROADCAST_LIMIT_BYTES else side


def work_root(spark: SparkSession) -> str:
    """Shared folder for working tables: the one the cluster names, a local one in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="dockhand-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_work_folder(spark: SparkSession, label: str) -> str:
    """A folder name that no other job uses."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a working folder that this library has made; a missing one is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def publish_file(spark: SparkSession, path: str, text: str) -> bool:
    """Publish a small file at once and only if there is none of its name; False if there is.

    The text is written beside it and then takes the name: by a hard link on local disks, by a
    rename elsewhere, which must not replace files (as on HDFS; plain object stores can't do that)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = target.getParent()
    written = jvm.org.apache.hadoop.fs.Path(f"{folder}-unpublished/{uuid.uuid4().hex}")
    out = fs.create(written)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.mkdirs(folder)
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(target) and fs.rename(written, target)
        local = lambda x: jvm.java.io.File(x.toUri().getPath()).toPath()
        jvm.java.nio.file.Files.createLink(local(target), local(written))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(written, False)


def small_table(
    spark: SparkSession, rows: list[tuple], schema: str | T.StructType
) -> DataFrame:
    """Driver-side facts as a table whose size Spark knows, so joins with it can broadcast.

    Rows given as a Python list become an RDD of unknown size; an Arrow table becomes a
    local relation, and an empty one disappears from the plan.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [
        pa.array([_plain(v, f.dataType) for v in c], a.type)
        for c, f, a in zip(columns, schema.fields, fields, strict=True)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), schema)


def _plain(value, kind: T.DataType):
    """Tuples of nested rows as the dictionaries Arrow expects."""
    if value is None:
        return None
    if isinstance(kind, T.ArrayType):
        return [_plain(v, kind.elementType) for v in value]
    if isinstance(kind, T.StructType):
        return {f.name: _plain(v, f.dataType) for f, v in zip(kind.fields, value, strict=True)}
    return value

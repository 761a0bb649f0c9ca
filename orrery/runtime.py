"""Scratch space, frozen intermediates and size checks shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# A side is broadcast only when its measured size is below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# A one-task window is used only over tables with at most this many rows.
SMALL_ROWS = 100_000
# Data in memory may be this many times as large as the files that hold it.
_COMPRESSION = 16

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would lose data with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="orrery-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/orrery/{app}/{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, name: str = "frozen") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where a result must not move between two uses (row positions) or where
    a small aggregate over a large input would otherwise be computed twice. The
    copy outlives executors and is columnar, so later passes read only the
    columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _width(field: T.StructField):
    size = _FIXED_WIDTH.get(type(field.dataType))
    if size is not None:
        return F.lit(size)
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))


def measured_bytes(df: DataFrame) -> int:
    """Data size of ``df`` by one map-side-combined aggregate."""
    row = F.lit(16)
    for field in df.schema.fields:
        row = row + _width(field)
    total = df.agg(F.sum(row.cast("bigint")).alias("bytes")).first()["bytes"]
    return int(total or 0)


def planned_bytes(df: DataFrame) -> int:
    """Size that the optimizer expects of ``df``; file sizes where it is a scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is small enough to broadcast.

    A plan far below the limit, even if its files are compressed, needs no job, and neither
    does a plain scan far beyond it; anything in between is measured.
    """
    planned = planned_bytes(df)
    if planned * _COMPRESSION <= BROADCAST_BYTES:
        return True
    if df.inputFiles() and planned > _COMPRESSION * BROADCAST_BYTES and _only_reads(df):
        return False
    return measured_bytes(df) <= BROADCAST_BYTES


def _only_reads(df: DataFrame) -> bool:
    """Whether the plan is a scan with columns picked: its size cannot be far below its files'."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.children().size() == 1 and plan.nodeName() == "Project":
        plan = plan.children().apply(0)
    return plan.children().size() == 0


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, the default file system's where it names none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch copy that nothing reads any more; a path that is not there is fine."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the scratch copies of this application; tables read from them are gone then."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/orrery/{spark.sparkContext.applicationId}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

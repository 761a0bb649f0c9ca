"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orrery.runtime import scratch_path

#: Rows that a worker hands back at once.
OUT_ROWS = 20_000


def keep(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_sample(rows: DataFrame, count: int, most: int, *columns: str) -> DataFrame:
    """At most ``most`` of the ``count`` rows, those whose hash of ``columns`` is smallest; equal rows are one.

    Ordering alone would have every partition hand over ``most`` rows, so a threshold on the
    hash first leaves little more than that in all partitions together.
    """
    span = 1 << 32
    place = F.pmod(F.xxhash64(*[col(c) for c in columns], F.lit(most)), F.lit(span))
    bound = int(min(1.0, 1.1 * most / max(1, count)) * span)
    near = rows.withColumn("sample_place", place).filter(F.col("sample_place") < F.lit(bound))
    return near.dropDuplicates(["sample_place"]).orderBy("sample_place").limit(most).drop("sample_place")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(quoted(name))


def arrow_schema(spark_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark_schema)


def bytes_array(buffer: bytes, ends: np.ndarray) -> pa.Array:
    """A binary array over ``buffer`` cut at ``ends`` (cumulative byte positions)."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)])
    return array.cast(pa.binary())


def each_batch(work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """A mapInArrow function that applies ``work`` to every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(batch)

    return run


def per_worker(key, build: Callable):
    """``build()``, once in each Python worker.

    Functions travel to the workers with their modules' code, so a module's own cache would
    start empty in every task.
    """
    cache = sys.modules.setdefault("_orrery_worker_cache", types.ModuleType("_orrery_worker_cache")).__dict__
    if key not in cache:
        cache[key] = build()
    return cache[key]

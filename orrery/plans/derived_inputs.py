"""Inputs in the shapes the readers expect, derived by Spark from the given tables.

Each builder is a plain plan over a whole table; the writers put the result into
the shared scratch folder so that a reader can be run on it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.functions.text import MISSING_TOKENS
from orrery.operators.clean import INSERT_COLUMNS, NUMERIC_COLUMNS
from orrery.plans.health_view import health_view
from orrery.runtime import freeze, qualified, scratch_path
from orrery.sources.paths import table

PICTURE_SIZE = 8
#: Bytes of a file that are copied at once.
COPY_BYTES = 4 << 20


def write_text(lines: DataFrame, name: str) -> str:
    path = scratch_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


def write_csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    (df.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
       .csv(path))
    return path


def write_csv_file(df: DataFrame, name: str, order: str | None = None) -> str:
    """One CSV file, in ascending ``order`` if given, in a folder of its own.

    All tasks write the rows, those of a range of ``order`` sorted by themselves; one task then
    copies the finished parts one behind the other, some megabytes at a time. A task run again
    writes the same bytes.
    """
    # The ranges are of a written copy: finding them reads the rows once more.
    rows = freeze(df, f"{name}-rows").repartitionByRange(order).sortWithinPartitions(order) if order else df
    parts = scratch_path(df.sparkSession, f"{name}-parts")
    shown = rows.drop(order) if order else rows
    shown.write.options(header=False, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(parts)
    header = ",".join(shown.columns)
    folder = qualified(df.sparkSession, scratch_path(df.sparkSession, name))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for source, target in zip(batch["source"].to_pylist(), batch["target"].to_pylist()):
                store, base = fs.FileSystem.from_uri(source)
                _, place = fs.FileSystem.from_uri(target)
                store.create_dir(place, recursive=True)
                found = store.get_file_info(fs.FileSelector(base))
                size = 0
                with store.open_output_stream(f"{place}/part-00000.csv") as out:
                    out.write(f"{header}\n".encode())
                    # Names of parts begin with the number of their task.
                    for path in sorted(f.path for f in found if f.base_name.startswith("part-")):
                        with store.open_input_stream(path) as part:
                            while piece := part.read(COPY_BYTES):
                                size += out.write(piece)
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64())], names=["written"])

    asked = df.sparkSession.createDataFrame([(qualified(df.sparkSession, parts), folder)], "source string, target string").coalesce(1)
    asked.mapInArrow(copy, "written bigint").agg(F.sum("written")).first()
    return folder


def health_text(spark: SparkSession, folder: str) -> DataFrame:
    """Health rows as text: missing tokens take turns for NULL numbers and categories, and every
    seventh state name holds a line break."""
    rows = health_view(spark, folder)
    token = F.element_at(
        F.array(*[F.lit(t) for t in MISSING_TOKENS]), (F.col("id") % len(MISSING_TOKENS) + 1).cast("int")
    )
    missing = {c: F.coalesce(F.col(c).cast("string"), token) for c in [*NUMERIC_COLUMNS, "measure_name"]}
    broken = F.when(F.col("id") % 7 == 0, F.concat("state_name", F.lit("\nsecond line"))).otherwise(F.col("state_name"))
    return rows.withColumns(missing).withColumn("state_name", broken).select(*INSERT_COLUMNS, "id")


def health_odd_text(spark: SparkSession, folder: str) -> DataFrame:
    """``health_text`` with values that are no numbers: every thirteenth ``value``, every eleventh ``lower_ci``."""
    odd = {
        "value": F.when(F.col("id") % 13 == 0, F.lit("1.5d")).otherwise(F.col("value")),
        "lower_ci": F.when(F.col("id") % 11 == 0, F.lit("about 7")).otherwise(F.col("lower_ci")),
    }
    return health_text(spark, folder).withColumns(odd)


def customer_lines(spark: SparkSession, folder: str) -> DataFrame:
    """CSV lines without header: quoted commas, doubled quotes, quoted line breaks, short rows, blank lines."""
    k = F.col("c_custkey")
    name = (
        F.when(k % 7 == 0, F.concat(F.lit('"'), "c_name", F.lit('\nsecond line"')))
        .when(k % 3 == 0, F.concat(F.lit('"'), "c_name", F.lit(', ""quoted"""')))
        .otherwise(F.col("c_name"))
    )
    line = (
        F.when(k % 11 == 0, F.lit(""))
        .when(k % 5 == 0, k.cast("string"))
        .otherwise(F.concat_ws(",", k.cast("string"), name, F.col("c_mktsegment")))
    )
    return table(spark, folder, "customer").select(line.alias("value"))


def label_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One image label line per event; most kinds are unusable in one way or need care.

    Sizes are whole numbers, decimals or text, coordinates numbers or text, points objects,
    empty lists or missing.
    """
    e = F.col("event_id")
    kind = e % 10
    name = (
        F.when(kind == 5, F.concat(F.lit("img_"), e, F.lit(".txt")))
        .when(kind == 6, F.concat(F.lit(" IMG_"), e, F.lit(".PNG ")))
        .otherwise(F.concat(F.lit("img_"), e, F.lit(".png")))
    )
    point = F.struct(F.col("value").alias("x_px"), F.when(kind != 8, F.col("value") * 2).alias("y_px"))
    record = F.to_json(F.struct(
        F.when(kind != 3, name).alias("image"),
        F.when(kind != 4, point).alias("point"),
        F.struct(F.lit(320).alias("width"), F.lit(256).alias("height")).alias("image_size"),
    ))
    line = (
        F.when(kind == 0, F.lit("")).when(kind == 1, F.lit("{not json")).when(kind == 2, F.lit("[1,2]"))
        .when(kind == 4, F.when(e % 20 == 4, record).otherwise(F.regexp_replace(record, r"\}$", ',"point":[]}')))
        .when(kind == 7, F.regexp_replace(record, '"width":320', '"width":320.0'))
        .when(kind == 9, F.regexp_replace(F.regexp_replace(record, '"x_px":([0-9.]+)', '"x_px":"$1"'), '"height":256', '"height":"tall"'))
        .otherwise(record)
    )
    return table(spark, folder, "events").select(line.alias("value"))


def listed_images(spark: SparkSession, folder: str) -> DataFrame:
    """File names of a listing that lacks every third event."""
    e = F.col("event_id")
    upper = F.concat(F.lit("IMG_"), e, F.lit(".PNG"))
    name = F.when(e % 10 == 6, upper).otherwise(F.concat(F.lit("img_"), e, F.lit(".png")))
    return table(spark, folder, "events").filter(e % 3 != 0).select(name.alias("image"))


def daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Per-day loss, mae and mse of the event values against 50: one row per day as epoch."""
    diff = F.col("value") - 50
    return (
        table(spark, folder, "events").groupBy(F.dayofyear("ts").alias("epoch"))
        .agg(F.round(F.avg("value"), 6).alias("loss"), F.round(F.avg(F.abs(diff)), 6).alias("mae"),
             F.round(F.avg(diff * diff), 6).alias("mse"))
    )


def pictures(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, image): an 8 x 8 colour picture per embedding, in the image source's layout.

    The blue channel is the scaled embedding, green its complement, red its
    triple modulo 256. The bytes are put together without leaving the JVM.
    """
    grey = F.transform("embedding", lambda v: F.least(F.greatest(F.floor(v.cast("double") * 127 + 128), F.lit(0)), F.lit(255)))
    two = lambda v: F.lpad(F.hex(v.cast("int")), 2, "0")
    code = F.array_join(F.transform("grey", lambda p: F.concat(two(p), two(255 - p), two(p * 3 % 256))), "")
    side = F.lit(PICTURE_SIZE)
    image = F.struct(
        F.concat(F.lit("vec_"), F.col("vec_id"), F.lit(".png")).alias("origin"), side.alias("height"),
        side.alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), F.unhex(code).alias("data"),
    )
    return table(spark, folder, "embeddings").withColumn("grey", grey).select("vec_id", image.alias("image"))


def png_bytes(bgr: bytes, height: int, width: int) -> bytes:
    """8-bit RGB PNG from BGR bytes."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rgb = bytearray(bgr)
    rgb[0::3], rgb[2::3] = bgr[2::3], bgr[0::3]
    lines = b"".join(b"\0" + bytes(rgb[i * width * 3:(i + 1) * width * 3]) for i in range(height))
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def write_pictures(df: DataFrame, name: str = "pictures") -> str:
    """Write one PNG per row from the executors; a task run again writes the same bytes.

    The folder's full URI, store included, is taken from what Spark itself wrote.
    """
    stored = freeze(df.select("image"), name)
    folder = stored.inputFiles()[0].rsplit("/", 1)[0] + "-files"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for picture in batch.column("image").to_pylist():
                with store.open_output_stream(f"{base}/{picture['origin']}") as out:
                    out.write(png_bytes(picture["data"], picture["height"], picture["width"]))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["written"])

    stored.mapInArrow(write, "written bigint").agg(F.sum("written")).first()
    return folder

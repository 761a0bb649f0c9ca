"""Image label files: one JSON object per line."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.image import ImageSchema
from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.functions.text import image_pattern, is_image_name, strip
from orrery.operators.clean import require_rows
from orrery.operators.joins import keep_existing, lookup_join
from orrery.runtime import fits_broadcast, freeze, path_exists, scratch_path
from orrery.sources.image_files import list_files, list_tree, read_images, read_pictures

LABEL_FILE = "clean_labels.jsonl"
#: Files that are read by one list of paths; their label rows, some 100 bytes each, are broadcast.
CHUNK_FILES = 250_000


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """All non-blank lines as (image, point, _corrupt_record).

    Only a line that is not a JSON object is corrupt and keeps its text there. Fields are
    read leniently: a name is taken as text, a coordinate as a number where it is one or
    spells one, and any other field of a record is left alone.
    """
    record = F.try_parse_json("value")
    is_object = F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    x, y = (F.try_variant_get(record, f"$.point.{c}", "double").alias(c) for c in ("x_px", "y_px"))
    lines = spark.read.text(path).filter(strip(F.col("value")) != "")
    return lines.select(
        F.when(is_object, F.try_variant_get(record, "$.image", "string")).alias("image"),
        F.when(is_object, F.struct(x, y)).alias("point"),
        F.when(~is_object, F.col("value")).alias("_corrupt_record"),
    )


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Records of the label file (image, point) with a trimmed image name."""
    rows = read_label_lines(spark, path)
    return rows.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record").withColumn(
        "image", strip(F.col("image"))
    )


def usable_names(labels: DataFrame, name: str = "image") -> DataFrame:
    """Records with a name that carries an accepted image extension."""
    return labels.filter((F.col(name) != "") & is_image_name(F.col(name)))


def with_point(labels: DataFrame) -> DataFrame:
    """Records that have both coordinates."""
    return labels.filter(F.col("point.x_px").isNotNull() & F.col("point.y_px").isNotNull())


def labelled_files(labels: DataFrame, files: DataFrame, name: str = "image") -> DataFrame:
    """Usable records whose file exists; a point is not required."""
    return keep_existing(usable_names(labels, name), files, name)


def count_labelled(labels: DataFrame, files: DataFrame) -> int:
    """Number of labelled, existing images; none at all is an error."""
    n = labelled_files(labels, files).count()
    if n == 0:
        raise ValueError("no labelled images found")
    return n


def labelled_points(labels: DataFrame, files: DataFrame) -> DataFrame:
    """(image, x_px, y_px) of usable records: the targets stay in original pixels."""
    rows = with_point(labelled_files(labels, files))
    return rows.select("image", F.col("point.x_px").alias("x_px"), F.col("point.y_px").alias("y_px"))


def read_image_dataset(spark: SparkSession, folder: str, tree: bool = False) -> DataFrame:
    """(image, x_px, y_px, picture) for a flat image folder with its label file.

    With ``tree``, pictures may lie in folders below it, which tasks list; of equal names the
    first path in code-point order counts.

    No picture is ever shuffled. Few labels are broadcast to where the pictures are decoded;
    for many, names are joined to paths first and only the labelled files are read.
    """
    labels = read_labels(spark, f"{folder.rstrip('/')}/{LABEL_FILE}")
    if tree:
        found = freeze(list_tree(spark, folder).groupBy(F.col("name").alias("image")).agg(F.min("path").alias("path")), "tree")
        points = labelled_points(labels, found.select("image"))
        return late_pictures(require_rows(points, "no valid labelled images were parsed"), found)
    listing = list_files(spark, folder).select(F.col("name").alias("image"), "path")
    points = require_rows(labelled_points(labels, listing.select("image")), "no valid labelled images were parsed")
    if not fits_broadcast(points):
        return late_pictures(points, listing)
    # The pattern keeps the label file, which may be large, from being read as a picture.
    pictures = read_images(spark, folder, image_pattern()).select(F.col("name").alias("image"), F.col("image").alias("picture"))
    # The label rows travel; the pictures stay where they were decoded.
    return pictures.join(F.broadcast(points), "image").select("image", "x_px", "y_px", "picture")


def late_pictures(points: DataFrame, listing: DataFrame, chunk: int | None = None) -> DataFrame:
    """``points`` with their decoded pictures: names and paths are joined first, files read afterwards.

    The joined rows are dealt to chunks of about ``chunk`` files, each in a folder of its own, so
    that a chunk's paths and label rows are read without the others. Each chunk's files are read by
    their paths and decoded once, next to a broadcast of the chunk's few label rows. The driver
    sees the paths, as it does for any folder that Spark scans.
    """
    spark = points.sparkSession
    found = freeze(lookup_join(points, listing, "image", broadcast_ok=False), "labelled-paths")
    chunks = max(1, -(-found.select("path").distinct().count() // (chunk or CHUNK_FILES)))
    dealt = found.withColumn("chunk", F.pmod(F.xxhash64("path"), F.lit(chunks)).cast("int"))
    folder = scratch_path(spark, "labelled-chunks")
    dealt.repartition(chunks, "chunk").write.partitionBy("chunk").parquet(folder)
    parts = []
    for i in range(chunks):
        place = f"{folder}/chunk={i}"
        if path_exists(spark, place):
            rows = spark.read.schema(found.schema).parquet(place)
            pictures = read_pictures(spark, [r["path"] for r in rows.select("path").distinct().collect()])
            pictures = pictures.select(F.col("name").alias("image"), F.col("image").alias("picture"))
            parts.append(pictures.join(F.broadcast(rows.drop("path")), "image"))
    if not parts:
        return found.select("image", "x_px", "y_px", F.lit(None).cast(ImageSchema.columnSchema).alias("picture"))
    return reduce(DataFrame.union, parts).select("image", "x_px", "y_px", "picture")

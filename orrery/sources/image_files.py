"""Image folders: listing and decoding on the executors."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.functions.text import basename
from orrery.runtime import freeze, path_exists, qualified

# Most tasks that list one level of folders, and entries that a task hands on at once.
LISTING_TASKS = 10_000
LISTING_ROWS = 10_000
#: Files that a task looks up by their paths.
LOOKUP_FILES = 100


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(name, path, length) of the files in a flat folder; no content is read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select(basename(F.col("path")).alias("name"), "path", "length")


def list_tree(spark: SparkSession, folder: str) -> DataFrame:
    """(name, path, length) of the files in a folder and all folders below it; no content is read.

    Tasks list the store themselves, level by level: each writes what its folders hold, and the
    folders among it are dealt to the tasks of the next level. The driver sees one count a level
    and no path. One task lists one folder, so a large collection should be spread over folders.

    Names that Spark's own scans pass over are left out here too: those beginning with a dot or
    an underscore (unless they hold an equals sign), and unfinished copies. Links to folders
    are not followed, and links to nothing are left out. Files without content are listed, which
    ``list_files`` leaves out. A missing folder is an error, an empty one has no rows.
    """
    if not path_exists(spark, folder):
        raise FileNotFoundError(folder)
    frontier, levels = spark.createDataFrame([(qualified(spark, folder),)], "path string"), []
    while True:
        folders = frontier.count()
        if not folders:
            break
        dealt = frontier.repartition(min(folders, LISTING_TASKS))
        levels.append(freeze(dealt.mapInArrow(_list_folders, "is_folder boolean, path string, length bigint"), "listing"))
        frontier = levels[-1].filter("is_folder").select("path")
    return reduce(DataFrame.union, levels).filter("NOT is_folder").select(basename(F.col("path")).alias("name"), "path", "length")


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = itertools.chain.from_iterable(_entries(folder) for folder in batch["path"].to_pylist())
        while rows := list(itertools.islice(found, LISTING_ROWS)):
            columns = zip(("is_folder", "path", "length"), zip(*rows), (pa.bool_(), pa.string(), pa.int64()))
            yield pa.RecordBatch.from_pydict({n: pa.array(values, kind) for n, values, kind in columns})


def _entries(folder: str) -> Iterator[tuple[bool, str, int]]:
    """(is_folder, path, length) of what lies directly in a folder."""
    base = folder.rstrip("/")
    if folder.startswith("file:"):
        with os.scandir(folder.removeprefix("file:")) as found:
            for entry in found:
                inner = entry.is_dir(follow_symlinks=False)
                if not _passed_over(entry.name) and (inner or entry.is_file()):
                    yield inner, f"{base}/{entry.name}", 0 if inner else entry.stat().st_size
        return
    store, place = fs.FileSystem.from_uri(folder)
    for entry in store.get_file_info(fs.FileSelector(place)):
        inner = entry.type == fs.FileType.Directory
        if not _passed_over(entry.base_name):
            yield inner, f"{base}/{entry.base_name}", 0 if inner else entry.size


def _passed_over(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _named(df: DataFrame) -> DataFrame:
    # File URIs are percent-encoded; the name is not.
    name = F.url_decode(F.replace(basename(F.col("image.origin")), F.lit("+"), F.lit("%2B")))
    return df.select(name.alias("name"), "image")


def unreadable_images(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(name) of the files that ``read_images`` leaves out because they cannot be decoded."""
    reader = spark.read.format("image").option("dropInvalid", False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return _named(reader.load(folder)).filter(F.col("image.height") < 0).select("name")


def read_images(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(name, image): decoded pictures, undecodable files dropped.

    ``image.data`` holds BGR bytes; ``operators.images`` turns them to RGB.
    """
    reader = spark.read.format("image").option("dropInvalid", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return _named(reader.load(folder))


def read_pictures(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, image) of the files at these paths; signs that a path pattern would read are taken as they are.

    Files are looked up by a few tasks: one a path would send the driver some kilobytes for each.
    """
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]
    tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    given = spark.conf.get(tasks)
    spark.conf.set(tasks, str(min(int(given), max(1, -(-len(plain) // LOOKUP_FILES)))))
    try:
        return _named(spark.read.format("image").option("dropInvalid", True).load(plain))
    finally:
        spark.conf.set(tasks, given)

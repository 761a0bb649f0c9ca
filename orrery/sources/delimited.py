"""CSV readers.

``escape='"'`` makes doubled quotes read as Python's readers do. Line breaks inside quotes
belong to their record, and files are still split: see ``split_records``, which reads the text
once to find out where records begin. ``multiline=False`` spares that pass where no quoted
value is known to hold a line break; ``multiline="whole"`` reads each file in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from orrery.functions.numbers import parse_number
from orrery.functions.text import null_tokens
from orrery.sources.split_records import csv_records

# The columns of a health file, in file order.
HEALTH_SCHEMA = T.StructType([
    T.StructField("edition", T.StringType()),
    T.StructField("report_type", T.StringType()),
    T.StructField("measure_name", T.StringType()),
    T.StructField("state_name", T.StringType()),
    T.StructField("subpopulation", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("lower_ci", T.DoubleType()),
    T.StructField("upper_ci", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_date", T.StringType()),
])


# Line breaks inside quotes: in records of split files (True), no such breaks (False), files read whole.
Multiline = bool | str
_OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}


def _reader(spark: SparkSession, header: bool, multiline: Multiline):
    return spark.read.options(header=header, multiLine=bool(multiline), **_OPTIONS)


def _parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    row = F.from_csv("value", schema.toDDL(), {**_OPTIONS, "multiLine": "true"})
    return records.select(row.alias("row")).select("row.*")


def _inferred(records: DataFrame, names: list[str]) -> T.StructType:
    """Types as Spark's own inference finds them in the records, under the names of the header."""
    spark = records.sparkSession
    texts = getattr(records.select("value")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(header=False, inferSchema=True, multiLine=True, **_OPTIONS)
    found = reader._df(reader._jreader.csv(texts)).schema
    kinds = [f.dataType for f in found.fields] + [T.StringType()] * len(names)
    return T.StructType([T.StructField(c, k) for c, k in zip(names, kinds)])


def read_csv_inferred(spark: SparkSession, path: str, multiline: Multiline = True, split_bytes: str | int | None = None) -> DataFrame:
    """Header and inferred types. Inference reads the data one extra time."""
    records = csv_records(spark, path, split_bytes) if multiline is True else None
    if records is None:
        return _reader(spark, True, multiline == "whole").option("inferSchema", True).csv(path)
    names = _reader(spark, True, True).csv(path).columns
    rows = records.filter(~F.col("first"))
    return _parsed(rows, _inferred(rows, names))


def read_csv_rows(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None, multiline: Multiline = True,
    split_bytes: str | int | None = None,
) -> DataFrame:
    """All-text named rows; short rows end in NULLs, blank lines are skipped.

    Names come from the header unless given.
    """
    schema = None if columns is None else T.StructType([T.StructField(c, T.StringType()) for c in columns])
    records = csv_records(spark, path, split_bytes) if multiline is True else None
    if records is None:
        reader = _reader(spark, schema is None, multiline == "whole")
        return (reader.schema(schema) if schema else reader).csv(path)
    if schema:
        return _parsed(records, schema)
    # Only the first record of a file is read for its names.
    names = _reader(spark, True, True).csv(path).columns
    return _parsed(records.filter(~F.col("first")), T.StructType([T.StructField(c, T.StringType()) for c in names]))


def column_values(schema: T.StructType) -> dict[str, tuple[Column, Column]]:
    """For each column its text, NULL for missing tokens, and its value, NULL also where the text has none."""
    out = {}
    for f in schema.fields:
        text = null_tokens(F.col(f.name))
        number = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        out[f.name] = text, parse_number(text).cast(f.dataType) if number else text.try_cast(f.dataType)
    return out


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the types of ``schema``: missing tokens and bad numbers become NULL."""
    return df.select(*[value.alias(c) for c, (_, value) in column_values(schema).items()])


def read_csv_missing(
    spark: SparkSession, path: str, schema: T.StructType = HEALTH_SCHEMA, multiline: Multiline = True,
    split_bytes: str | int | None = None,
) -> DataFrame:
    """Typed rows in which every token pandas reads as missing is NULL; no inference."""
    rows = read_csv_rows(spark, path, multiline=multiline, split_bytes=split_bytes)
    return typed(rows, schema)

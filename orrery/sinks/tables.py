"""Catalog tables: creation, loading, literal inserts, deletes that rewrite the files they touch."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orrery.operators.clean import INSERT_COLUMNS, project
from orrery.operators.rows import POSITION_BITS, dense_index
from orrery.sinks.ledger import Store, reserve

# Columns, lengths and default of the health table.
HEALTH_COLUMNS = """
    id BIGINT,
    edition VARCHAR(10),
    report_type VARCHAR(100),
    measure_name VARCHAR(100),
    state_name VARCHAR(50),
    subpopulation VARCHAR(100),
    value FLOAT,
    lower_ci FLOAT,
    upper_ci FLOAT,
    source VARCHAR(255),
    source_date VARCHAR(50),
    created_at TIMESTAMP DEFAULT current_timestamp()
"""
# Table property with the highest id given out before a delete.
_LAST_ID = "orrery.last_id"
# Folder of a table, hidden from readers, with what loads and deletes have written and not yet put in place.
_PENDING = "_pending"
MESSAGE_COLUMNS = "message VARCHAR(250)"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def ensure_table(
    spark: SparkSession, name: str, columns: str = HEALTH_COLUMNS, location: str | None = None
) -> None:
    """Create a parquet table unless it exists. Lengths are enforced on insert."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a table; the files of a table with a location stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _last_id(spark: SparkSession, name: str) -> int:
    """The highest id that the table has or had before a delete."""
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    present = spark.table(name).agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    return max(int(present), int(kept.get(_LAST_ID, 0)))


def ledger_folder(spark: SparkSession, name: str) -> str:
    """Folder of the table's id ranges: next to its files, wherever a delete has moved these."""
    return table_location(spark, name).split("--rewrite-")[0] + "--ids"


def numbered_rows(df: DataFrame, name: str, dense: bool = True) -> DataFrame:
    """``df`` with the ids that its rows get in the table; no other writer gets any of them.

    Dense ids follow the highest one given out so far. Others rise with gaps, and the range
    that is reserved for them is as wide as the partitions of ``df`` can fill.
    """
    spark = df.sparkSession
    last, ledger = _last_id(spark, name), ledger_folder(spark, name)
    if dense:
        numbered = dense_index(df, name="id")
        start = reserve(spark, ledger, numbered.count(), last)
        return numbered.withColumn("id", F.col("id") + F.lit(start))
    start = reserve(spark, ledger, df.rdd.getNumPartitions() << POSITION_BITS, last)
    return df.withColumn("id", F.monotonically_increasing_id() + F.lit(start))


def insert_numbered(df: DataFrame, name: str, columns: list[str] = INSERT_COLUMNS) -> None:
    """Append rows that have their ids, by column name; the table's lengths and defaults hold.

    The rows are inserted into a hidden folder through a table like this one and then put in
    place: two loads into one folder would remove each other's temporary files. Partitioned
    tables take a plain insert.
    """
    spark, names = df.sparkSession, ["id", *columns]

    def insert(into: str) -> None:
        spark.sql(f"INSERT INTO {into} ({', '.join(names)}) SELECT {', '.join(names)} FROM {{rows}}", rows=df.select(*names))

    if _partitioned(spark, name):
        return insert(name)
    location, token = table_location(spark, name), uuid.uuid4().hex
    stage = f"{name}_{token}"
    spark.sql(f"CREATE TABLE {stage} LIKE {name} LOCATION '{location}/{_PENDING}/{token}'")
    try:
        insert(stage)
    finally:
        spark.sql(f"DROP TABLE {stage}")
    _put_in_place(spark, location, token, [])
    spark.catalog.refreshTable(name)


def load_table(df: DataFrame, name: str, columns: list[str] = INSERT_COLUMNS, dense: bool = True) -> None:
    """Append rows by column name with generated ids; ``created_at`` takes its default.

    Several loads may run at once: each reserves its range of ids in the table's ledger.
    Dense ids follow the highest one given out so far and cost one extra write. With
    ``dense=False`` ids rise and are unique but leave gaps, and nothing extra
    is written. All rows become visible together when the job commits.
    """
    insert_numbered(numbered_rows(project(df, columns), name, dense), name, columns)


def insert_rows(spark: SparkSession, name: str, rows: list[tuple]) -> None:
    """Insert a few literal rows."""
    marks = ", ".join("(" + ", ".join("?" for _ in row) + ")" for row in rows)
    spark.sql(f"INSERT INTO {name} VALUES {marks}", args=[v for row in rows for v in row])


def kept_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows a DELETE would leave: those where the condition is false or NULL."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def delete_where(spark: SparkSession, name: str, condition: Column, location: str | None = None) -> str:
    """Delete the rows where ``condition`` holds; returns the table's location.

    Files with such rows are found by a scan of the condition's columns. What they keep is
    written to a hidden folder of the table, a journal names the files to add and to remove, and
    then both are done; all other files stay as they are. A delete that was cut off after its
    journal was written is carried out by the next delete or load. A reader that lists the
    files in the moment of the change may see a row twice or miss a new file; readers that must
    not are served by a new ``location``, to which the whole table is rewritten before it is
    switched over (the old files stay then). Partitioned tables are always rewritten.

    One delete at a time. The highest id is noted in the table's properties, so a deleted id
    is not given out again.
    """
    if "id" in spark.table(name).columns:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_LAST_ID}' = '{_last_id(spark, name)}')")
    if location is None and not _partitioned(spark, name):
        return _delete_in_files(spark, name, condition)
    if location is None:
        base = table_location(spark, name).split("--rewrite-")[0]
        location = f"{base}--rewrite-{uuid.uuid4().hex}"
    kept_rows(spark.table(name), condition).write.parquet(location)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return location


def _partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))


def _delete_in_files(spark: SparkSession, name: str, condition: Column) -> str:
    location = table_location(spark, name)
    finish_changes(spark, location)
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    hit = rows.filter(F.coalesce(condition, F.lit(False))).select(F.col("_metadata.file_name").alias("file")).distinct()
    # One name per file that has to change.
    files = sorted(r["file"] for r in hit.collect())
    if not files:
        return location
    token = uuid.uuid4().hex
    staged = f"{location}/{_PENDING}/{token}"
    kept_rows(spark.read.schema(rows.schema).parquet(*[f"{location}/{f}" for f in files]), condition).write.parquet(staged)
    _put_in_place(spark, location, token, files)
    spark.catalog.refreshTable(name)
    return location


def _put_in_place(spark: SparkSession, location: str, token: str, remove: list[str]) -> None:
    """Journal the files staged under ``token`` and those they replace, and carry the journal out."""
    written = [n for n in Store(spark, f"{location}/{_PENDING}/{token}").names() if not n.startswith(("_", "."))]
    Store(spark, f"{location}/{_PENDING}").create(f"{token}.json", json.dumps({"staged": token, "add": written, "remove": remove}) + "\n")
    finish_changes(spark, location)


def finish_changes(spark: SparkSession, location: str) -> int:
    """Carry out the journals of loads and deletes; every step may be repeated, by several writers too.

    Returns how many there were.
    """
    journals = Store(spark, f"{location}/{_PENDING}")
    at = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join([location, *parts]))
    done = 0
    for name in sorted(n for n in journals.names() if n.endswith(".json")):
        try:
            text = journals.read(name)
        except Py4JJavaError:  # another writer has carried it out meanwhile
            continue
        if not text.endswith("\n"):  # cut off while it was written: nothing has been changed yet
            continue
        plan = json.loads(text)
        for file in plan["add"]:
            if journals.files.exists(at(_PENDING, plan["staged"], file)):
                journals.files.rename(at(_PENDING, plan["staged"], file), at(file))
        for file in plan["remove"]:
            journals.files.delete(at(file), False)
        journals.files.delete(at(_PENDING, name), False)
        journals.files.delete(at(_PENDING, plan["staged"]), True)
        done += 1
    return done

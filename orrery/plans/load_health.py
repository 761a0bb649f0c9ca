"""CSV to table: create what is missing, read with missing tokens as NULL, append."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orrery.operators.clean import project
from orrery.runtime import freeze
from orrery.sinks import tables
from orrery.sources.delimited import HEALTH_SCHEMA, Multiline, read_csv_missing, read_csv_rows
from orrery.sources.jdbc import JdbcConfig, write_jdbc
from orrery.sources.rejects import ColumnCounts, reject_rows, typed_observed


@dataclass(frozen=True)
class LoadReport:
    """What a load did: the table's full name, rows read and kept values per column, and the rejected values."""

    table: str
    counts: ColumnCounts
    rejects: DataFrame


def load_csv_with_report(spark: SparkSession, path: str, table: str, database: str | None = None, location: str | None = None,
                         multiline: Multiline = True, dense: bool = True, rejects: str | None = None) -> LoadReport:
    """Append a health CSV to a catalog table, creating database and table first.

    Every row is loaded; a value that is neither missing nor of its column's type is NULL there,
    counted, and listed with the row's id in ``report.rejects``, which is also written to the
    folder ``rejects`` if one is given. Counts and list come from the pass that numbers the rows.
    """
    name = f"{database}.{table}" if database else table
    if database:
        tables.ensure_database(spark, database, location and f"{location}/{database}.db")
    tables.ensure_table(spark, name, location=location and f"{location}/{table}")
    rows, seen = typed_observed(read_csv_rows(spark, path, multiline=multiline), HEALTH_SCHEMA)
    numbered = tables.numbered_rows(rows, name, dense)
    if not dense:
        numbered = freeze(numbered, "load")
    tables.insert_numbered(numbered, name)
    listed = reject_rows(numbered, "id")
    if rejects:
        listed.write.mode("overwrite").parquet(rejects)
    return LoadReport(name, seen.counts(), listed)


def load_csv_to_table(spark: SparkSession, path: str, table: str, database: str | None = None,
                      location: str | None = None, multiline: Multiline = True, dense: bool = True) -> str:
    """``load_csv_with_report`` without the report. Returns the full name."""
    return load_csv_with_report(spark, path, table, database, location, multiline, dense).table


def load_csv_to_jdbc(spark: SparkSession, path: str, db: JdbcConfig | None = None, batch_size: int = 1000,
                     multiline: Multiline = True) -> None:
    """Append a health CSV to a database table that generates its own ids and times."""
    rows = project(read_csv_missing(spark, path, multiline=multiline))
    write_jdbc(rows, db or JdbcConfig.from_env(), batch_size)

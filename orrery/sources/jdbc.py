"""JDBC tables: one-partition scans, scans split by key range, batched writes."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

# Cells of the first count for each part, and how much narrower those of the next count are.
_CELLS_PER_PART = 4
_FINER = 64


@dataclass(frozen=True)
class JdbcConfig:
    """Connection defaults; ``from_env`` lets the environment override them."""

    host: str = "localhost"
    port: str = "3306"
    user: str = "root"
    password: str = ""
    database: str = "health_data"
    table: str = "health_disparities"
    driver: str = "com.mysql.cj.jdbc.Driver"
    dialect: str = "mysql"

    @classmethod
    def from_env(cls, base: JdbcConfig | None = None) -> JdbcConfig:
        base = base or cls()
        # Names of the environment variables.
        names = {
            "host": "DB_HOST", "port": "DB_PORT", "user": "DB_USER", "password": "DB_PASSWORD",
            "database": "DB_NAME", "table": "DB_TABLE",
        }
        return replace(base, **{f: os.environ[v] for f, v in names.items() if v in os.environ})

    @property
    def url(self) -> str:
        return f"jdbc:{self.dialect}://{self.host}:{self.port}/{self.database}"

    def options(self, table: str | None = None) -> dict[str, str]:
        return {
            "url": self.url, "dbtable": table or self.table, "user": self.user,
            "password": self.password, "driver": self.driver,
        }


@dataclass(frozen=True)
class KeyRange:
    """Range split on a numeric key. The bounds set the stride; they drop no rows."""

    column: str = "id"
    lower: int = 1
    upper: int = 1_000_000
    partitions: int = 16

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column, "lowerBound": str(self.lower),
            "upperBound": str(self.upper), "numPartitions": str(self.partitions),
        }


def range_from(low: int | None, high: int | None, rows: int, column: str = "id", rows_per_partition: int = 1_000_000,
               partitions: int = 16) -> KeyRange | None:
    """Bounds that fit the keys present; more partitions once the table outgrows ``partitions``.

    Fixed bounds put a small table into one partition and leave all keys beyond
    the upper bound to the last one.
    """
    if low is None or high is None or rows == 0:
        return None
    wanted = max(partitions, -(-rows // rows_per_partition))
    return KeyRange(column, low, high + 1, max(1, min(wanted, high + 1 - low)))


def key_limits(spark: SparkSession, cfg: JdbcConfig, column: str = "id") -> tuple[int | None, int | None, int]:
    """Lowest key, highest key and row count, asked of the database: one row comes back."""
    query = (f"(SELECT MIN({column}) AS low, MAX({column}) AS high, COUNT(*) AS total "
             f"FROM {cfg.table}) key_limits")
    low, high, total = tuple(spark.read.format("jdbc").options(**cfg.options(query)).load().first())
    return None if low is None else int(low), None if high is None else int(high), int(total)


def derive_range(spark: SparkSession, cfg: JdbcConfig, column: str = "id", **limits) -> KeyRange | None:
    return range_from(*key_limits(spark, cfg, column), column, **limits)


Span = tuple[int, int]
CountCells = Callable[[list[Span], int], list[tuple[int, int]]]


def cell_query(table: str, column: str, base: int, spans: list[Span], width: int) -> str:
    """Rows per cell of ``width`` consecutive keys, counted from ``base``, of the keys in ``spans``."""
    cell = f"FLOOR(({column} - {base}) / {width})"
    inside = " OR ".join(f"{column} >= {low} AND {column} < {high}" for low, high in spans)
    return f"(SELECT {cell} AS cell, COUNT(*) AS total FROM {table} WHERE {inside} GROUP BY {cell}) key_cells"


def balanced_cuts(count: CountCells, keys: KeyRange, rows: int) -> list[int]:
    """Keys at which to cut so that the parts hold about equally many rows.

    ``count(spans, width)`` gives the rows per cell. The first count has a few cells per
    part; cells with more rows than a part are counted again, all together, in cells a
    ``_FINER``-th as wide. Evenly spread keys need one count, and no range more than a
    handful; a part holds less than two shares unless one key alone does.
    """
    share = max(1, -(-rows // keys.partitions))
    wanted = _CELLS_PER_PART * keys.partitions
    # Widths are powers of two, so that narrower cells lie inside wider ones.
    width = 1 << max(0, -(-(keys.upper - keys.lower) // wanted) - 1).bit_length()
    cells, spans = [], [(keys.lower, keys.upper)]
    while spans:
        heavy = []
        for cell, n in sorted(count(spans, width)):
            start = keys.lower + cell * width
            if n > share and width > 1:
                end = min(keys.upper, start + width)
                if heavy and heavy[-1][1] == start:
                    heavy[-1] = (heavy[-1][0], end)
                else:
                    heavy.append((start, end))
            else:
                cells.append((start, n))
        spans, width = heavy, max(1, width // _FINER)
    cuts, filled = [], 0
    for start, n in sorted(cells):
        if filled and filled + n > share:
            cuts.append(start)
            filled = 0
        filled += n
    return cuts


def cut_predicates(column: str, cuts: list[int]) -> list[str]:
    """One condition per part; together they hold for every row, new and NULL keys included."""
    if not cuts:
        return ["1 = 1"]
    first, last = f"{column} < {cuts[0]} OR {column} IS NULL", f"{column} >= {cuts[-1]}"
    return [first, *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])], last]


def balanced_predicates(spark: SparkSession, cfg: JdbcConfig, column: str = "id", **limits) -> list[str]:
    """Conditions for parts of even size when the keys have gaps or cluster.

    Equal key ranges are uneven then: most rows may lie in one. A few grouped
    counts on the key, made by the database, find better cuts.
    """
    low, high, total = key_limits(spark, cfg, column)
    keys = range_from(low, high, total, column, **limits)
    if keys is None:
        return cut_predicates(column, [])

    def count(spans: list[Span], width: int) -> list[tuple[int, int]]:
        query = cell_query(cfg.table, column, keys.lower, spans, width)
        rows = spark.read.format("jdbc").options(**cfg.options(query)).load().collect()
        return [(int(r[0]), int(r[1])) for r in rows]

    return cut_predicates(column, balanced_cuts(count, keys, total))


def read_jdbc(spark: SparkSession, cfg: JdbcConfig, split: KeyRange | str | None = None) -> DataFrame:
    """Scan ``cfg.table``: in one partition, by a given key range, by ``"derived"`` bounds
    (equal key ranges between the limits present) or ``"balanced"`` (equal row counts).

    Filters and column choices made on the result are pushed into the database query.
    """
    if split == "balanced":
        properties = {k: v for k, v in cfg.options().items() if k in ("user", "password", "driver")}
        return spark.read.jdbc(cfg.url, cfg.table, predicates=balanced_predicates(spark, cfg), properties=properties)
    if split == "derived":
        split = derive_range(spark, cfg)
    reader = spark.read.format("jdbc").options(**cfg.options())
    if isinstance(split, KeyRange):
        reader = reader.options(**split.options())
    return reader.load()


def write_jdbc(df: DataFrame, cfg: JdbcConfig, batch_size: int = 1000, writers: int = 16) -> None:
    """Append rows in batches; each task commits its own rows over its own connection.

    ``writers`` limits the connections by merging partitions, without a shuffle.
    """
    (df.write.format("jdbc").options(**cfg.options(), batchsize=str(batch_size), numPartitions=str(writers))
       .mode("append").save())

"""CSV records with line breaks inside quotes, from files that Spark may split.

A physical line maps the state before it (outside or inside quotes) to the state after it:
lines without quotes keep it, an odd number of quotes turns it, and a line that only makes
sense from one state fixes it. Composed over a split, these maps are one small row; a running
composition over the splits of a file gives the state each split starts in. With it, every
task joins the lines of its own records, and only the pieces of records that cross the edge of
a split are shuffled and put together.

Splits are pinned by a session of their own, so that both passes see the same ones; a split
the first pass has not seen is an error. Files without any quoted line break need no second
pass and are read by Spark's own line reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

#: Kinds of rows: a whole record, a piece that goes on with one, a piece that begins one.
RECORD, REST, BEGIN = 0, 1, 2


@dataclass(frozen=True)
class Dialect:
    quote: str = '"'
    separator: str = ","

    def patterns(self) -> tuple[str, str]:
        """Lines that end outside quotes when they start outside, and when they start inside."""
        q, s = re.escape(self.quote), re.escape(self.separator)
        # A closing quote is not followed by another one; what stands between it and the separator is kept as it is.
        rest = f"{q}(?:[^{q}{s}][^{s}]*)?"
        inside = f"(?:[^{q}]|{q}{q})*"
        field = f"(?:{q}{inside}{rest}|[^{q}{s}][^{s}]*|)"
        return f"(?s)^(?:{field}{s})*{field}$", f"(?s)^{inside}{rest}(?:{s}{field})*$"


def line_maps(lines: pa.Array, dialect: Dialect) -> np.ndarray:
    """State after each line (0 outside, 1 inside) from both states: a row per line, a column per state before."""
    out = np.zeros((len(lines), 2), np.uint8)
    out[:, 1] = 1
    quoted = np.flatnonzero(pc.match_substring(lines, dialect.quote).to_numpy(zero_copy_only=False))
    if len(quoted):
        some = lines.take(pa.array(quoted))
        for state, pattern in enumerate(dialect.patterns()):
            out[quoted, state] = ~pc.match_substring_regex(some, pattern).to_numpy(zero_copy_only=False)
    return out


def states_after(maps: np.ndarray, start: int) -> np.ndarray:
    """The state after each line when the first one starts in ``start``."""
    n = len(maps)
    fixed = maps[:, 0] == maps[:, 1]
    turns = np.cumsum(~fixed & (maps[:, 0] == 1)) & 1
    last = np.maximum.accumulate(np.where(fixed, np.arange(n), -1))
    known = last >= 0
    base = np.where(known, maps[last, 0] ^ turns[last], start)
    return (base ^ turns).astype(np.uint8)


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array]]:
    """(file, block, lines) of each split met in a batch."""
    file, block = batch["file"].to_numpy(), batch["block"].to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)]):
        yield int(file[low]), int(block[low]), batch["value"].slice(low, high - low)


def _composed(dialect: Dialect):
    """One row per split: the state it ends in from both states, and whether its lines may be read one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends, odd = None, [0, 1], False

        def told() -> pa.RecordBatch:
            columns = [[key[0]], [key[1]], [ends[0]], [ends[1]], [odd]]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "block", "outside", "inside", "odd"])

        for batch in batches:
            if not batch.num_rows:
                continue
            for file, block, lines in _stretches(batch):
                if key != (file, block):
                    if key is not None:
                        yield told()
                    key, ends, odd = (file, block), [0, 1], False
                maps = line_maps(lines, dialect)
                ends = [int(states_after(maps, s)[-1]) for s in ends]
                # Spark's line reader drops lines of blanks and ends lines at a lone return.
                odd = odd or bool(maps[:, 0].any()) or bool(pc.any(pc.match_substring_regex(lines, r"^[ \t]+\r?$|\r.")).as_py())
        if key is not None:
            yield told()

    return run


def split_states(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """(file, block, start, stop, odd): the states in which each split starts and stops; one row per split."""
    maps = lines.mapInArrow(_composed(dialect), "file long, block long, outside int, inside int, odd boolean")
    fixed = F.col("outside") == F.col("inside")
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turned = maps.withColumn("turns", F.sum((~fixed & (F.col("outside") == 1)).cast("int")).over(order) % 2)
    known = turned.withColumn("known", F.last(F.when(fixed, F.col("outside").bitwiseXOR(F.col("turns").cast("int"))), ignorenulls=True).over(order))
    stop = F.coalesce("known", F.lit(0)).bitwiseXOR(F.col("turns").cast("int"))
    before = F.lag("stop", 1, 0).over(Window.partitionBy("file").orderBy("block"))
    return known.withColumn("stop", stop).select("file", "block", before.alias("start"), "stop", "odd")


def _joined(lines: list[str]) -> str:
    return "\n".join(lines)


def _assembler(states, dialect: Dialect):
    """Lines to records: (kind, value, file, block, first); ``first`` marks the record a file begins with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, blocks, starts = states.value
        key, state, kind, pending, first = None, 0, RECORD, [], False
        schema = pa.schema([("kind", pa.int32()), ("value", pa.string()), ("file", pa.int64()), ("block", pa.int64()), ("first", pa.bool_())])

        def rows(values: pa.Array, what: int, lead: bool = False) -> pa.RecordBatch:
            n = len(values)
            marks = np.zeros(n, bool)
            marks[:1] = lead
            columns = [pa.array(np.full(n, what)), values, pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])), pa.array(marks)]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            for file, block, lines in _stretches(batch):
                if key != (file, block):
                    if pending:
                        yield rows(pa.array([_joined(pending)]), kind, first)
                    key, pending, first = (file, block), [], block == 0
                    at = np.flatnonzero((files == file) & (blocks == block))
                    if not len(at):
                        raise RuntimeError("a split of the CSV files changed between two passes over them")
                    state = int(starts[at[0]])
                    kind = REST if state else BEGIN
                after = states_after(line_maps(lines, dialect), state)
                state = int(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                if not len(ends):
                    pending += lines.to_pylist()
                    continue
                at = 0
                if pending or kind == REST:
                    at = int(ends[0])
                    yield rows(pa.array([_joined(pending + lines.slice(0, at).to_pylist())]), REST if kind == REST else RECORD, first)
                    first = first and kind == REST
                    pending, kind = [], BEGIN
                    ends = ends[1:]
                if len(ends):
                    offsets = pa.array(np.concatenate([[at], ends]).astype(np.int32))
                    yield rows(pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n"), RECORD, first)
                    at, first = int(ends[-1]), False
                pending = lines.slice(at).to_pylist()
        if pending:
            yield rows(pa.array([_joined(pending)]), kind, first)

    return run


def _pinned(spark: SparkSession, split_bytes: str | int | None) -> SparkSession:
    """A session with the settings of ``spark`` in which files are split the same way at any time."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    if split_bytes is not None:
        session.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    if session.conf.get("spark.sql.files.minPartitionNum", None) is None:
        session.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return session


def csv_records(spark: SparkSession, path: str, split_bytes: str | int | None = None, dialect: Dialect = Dialect()) -> DataFrame | None:
    """(value, first): one row per CSV record; None where each line is a record of its own.

    Lines end in LF or CRLF; empty records are left out. ``first`` marks the record that a file
    begins with. ``split_bytes`` bounds a split (default: the session's setting). Records that
    cross an edge come after the others.
    """
    import functools

    value = F.col("value")
    meta = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = _pinned(spark, split_bytes).read.option("lineSep", "\n").text(path).select("value", *meta)
    # One row of a few numbers per split.
    told = split_states(lines, dialect).collect()
    if not any(r["odd"] for r in told):
        return None
    states = tuple(np.array([r[c] for r in told], k) for c, k in (("file", np.int64), ("block", np.int64), ("start", np.uint8)))
    run = _assembler(spark.sparkContext.broadcast(states), dialect)
    made = lines.mapInArrow(run, "kind int, value string, file long, block long, first boolean")
    parts = [made.filter(F.col("kind") == RECORD).select("value", "first")]
    if any(r["stop"] for r in told):
        pieces = made.filter(F.col("kind") != RECORD)
        order = Window.partitionBy("file").orderBy("block", "kind")
        numbered = pieces.withColumn("record", F.sum((F.col("kind") == BEGIN).cast("int")).over(order))
        whole = numbered.groupBy("file", "record").agg(
            F.array_sort(F.collect_list(F.struct("block", "kind", "value"))).alias("pieces"), F.bool_or("first").alias("first")
        )
        parts.append(whole.select(F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("value"), "first"))
    # An empty frame of the caller's session in front hands the result to that session.
    none = spark.createDataFrame([], "value string, first boolean")
    records = functools.reduce(DataFrame.union, [none, *parts])
    return records.select(F.regexp_replace(value, "\r$", "").alias("value"), "first").filter(value != "")

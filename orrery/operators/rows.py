"""Row organisation: dense index, permutation, exact split, shard, batch, repeat.

Row numbers are never taken from one window over the whole input. A dense index
comes from per-partition positions plus offsets, in arrival order or over a range
partitioning; a permutation is an index in hash order; a split needs no sort at all.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from orrery.functions.numbers import floor_div
from orrery.runtime import SMALL_ROWS, freeze

SEED = 1337
#: Rows of a shuffle buffer.
BUFFER_ROWS = 3000

# A histogram bucket of a split is four hex digits, so there are never more than 65,536 of them.
_DIGITS = 4
# A bucket of up to this many rows is ranked at once instead of being divided again.
_LEAF_ROWS = 10_000
POSITION_BITS = 33


def _running_offsets(counts: DataFrame, bucket: str) -> DataFrame:
    """Rows before each bucket. The table has one row per bucket or partition."""
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))


def _hashable(kind: T.DataType) -> bool:
    """Whether a column can be hashed: no map at any depth."""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dense_index(
    df: DataFrame, order_by: Sequence[str] | None = None, name: str = "idx", start: int = 0,
    partitions: int | None = None, hashed: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``start .. start+n-1`` without gaps.

    Without ``order_by`` rows are numbered as they are read and nothing is
    shuffled. With it they are range-partitioned (into ``partitions`` parts, or as
    many as the session shuffles into) and sorted; a hash of the row (of the columns
    ``hashed``, if given), and for equal rows the partition they were read in, break
    ties so that a frequent value does not fill one partition. Positions are
    fixed by one write to scratch, after which only a table with one row per
    partition is broadcast.
    """
    if order_by:
        hashable = [f.name for f in df.schema.fields if _hashable(f.dataType) and (hashed is None or f.name in hashed)]
        df = df.withColumn("_read_in", F.spark_partition_id())
        row = [F.xxhash64(*[F.col(f"`{c}`") for c in hashable])] if hashable else []
        keys = [F.col(c) for c in order_by] + row + [F.col("_read_in")]
        ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
        df = ranged.sortWithinPartitions(*keys).drop("_read_in")
    placed = freeze(df.withColumn("_place", F.monotonically_increasing_id()), "index")
    part = F.shiftright("_place", POSITION_BITS).alias("_part")
    offsets = _running_offsets(placed.groupBy(part).agg(F.count(F.lit(1)).alias("n")), "_part")
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", F.shiftright("_place", POSITION_BITS))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + F.lit(start).cast("bigint"))
        .drop("_part", "_offset", "_place")
    )


def rank_distinct(df: DataFrame, order: Sequence[Column], names: Sequence[str], name: str) -> DataFrame:
    """Number the rows of an already frozen, pre-aggregated table from 0.

    Small tables take one window; larger ones are sorted by range.
    """
    if df.count() <= SMALL_ROWS:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)
    keyed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return dense_index(keyed, name=name).select(*names, name)


def row_hash(key: Column, seed: int = SEED) -> Column:
    """Seeded md5 text of a row key, the same in every SQL engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def permute(df: DataFrame, key: str | None, seed: int = SEED, name: str = "idx", ties: Sequence[str] = ()) -> DataFrame:
    """Add the place of each row in a seeded permutation.

    Rows are ordered by a hash of ``key``, rows of equal keys by ``ties`` and then by a
    hash of the whole row, so a key may repeat as often as it likes and the place depends
    on the data alone. Without a key, arrival positions take its part.
    """
    columns = df.columns
    if key is None:
        df, key = dense_index(df, name="_arrival"), "_arrival"
    keyed = df.withColumn("_hash", row_hash(F.col(key), seed))
    return dense_index(keyed, ["_hash", key, *ties], name, hashed=columns).drop("_hash", "_arrival")


def holdout_size(n: int, fraction: float, clamp_to_rest: bool = False) -> int:
    """Rows to hold out: at least one; with ``clamp_to_rest`` also at most n-1."""
    size = int(n * float(fraction))
    if clamp_to_rest:
        size = min(n - 1, size)
    return max(1, size)


def training_steps(n: int, batch_size: int, fraction: float = 0.0) -> int:
    """Whole batches per epoch of the rows left after the hold-out, at least one."""
    return max(1, max(1, n - int(n * fraction)) // batch_size)


def _histogram(df: DataFrame, hashed: Column, at: int) -> list[tuple[str, int]]:
    bucket = F.substring(hashed, at, _DIGITS).alias("bucket")
    rows = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["bucket"], r["n"]) for r in rows)


def _locate(histogram: list[tuple[str, int]], place: int) -> tuple[str, int]:
    """Bucket that holds the row at ``place``, and the row's place inside it."""
    for bucket, n in histogram:
        if place < n:
            return bucket, place
        place -= n
    raise IndexError(place)


def exact_split(
    df: DataFrame,
    key: str,
    size: Callable[[int], int],
    seed: int = SEED,
    ties: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Split off exactly ``size(n)`` rows: those last in the seeded permutation.

    The permutation itself is not built. One or two histograms of the key's hash
    (at most 65,536 counts each) and the few distinct keys of one leaf give the
    boundary key; both parts are then plain filters on the input. Rows of a key that
    repeats across the boundary are divided as ``permute`` orders them.
    """
    hashed = row_hash(F.col(key), seed)
    keys = df.select(key)
    top = _histogram(keys, hashed, 1)
    n = sum(count for _, count in top)
    head = n - size(n)
    if n == 0 or head <= 0:
        return df.limit(0), df
    if head >= n:
        return df, df.limit(0)
    prefix, place = _locate(top, head)
    inside = keys.filter(hashed.startswith(prefix))
    if dict(top)[prefix] > _LEAF_ROWS:
        second, place = _locate(_histogram(inside, hashed, 1 + _DIGITS), place)
        inside = inside.filter(hashed.startswith(prefix + second))
    leaf = (
        inside.groupBy(hashed.alias("hash"), key).agg(F.count(F.lit(1)).alias("n"))
        .orderBy("hash", key).collect()
    )
    for row in leaf:
        if place < row["n"]:
            break
        place -= row["n"]
    edge_hash, edge_key, repeats = row["hash"], row[key], row["n"]
    at_edge = F.col(key).eqNullSafe(F.lit(edge_key))
    kind = df.schema[key].dataType
    edge = F.struct(F.lit(edge_hash).alias("hash"), F.lit(edge_key).cast(kind).alias("key"))
    before = F.struct(hashed.alias("hash"), F.col(key).alias("key")) < edge
    if place == 0:
        return df.filter(before), df.filter(~before)
    warnings.warn(f"split key {key} repeats {repeats} times at the boundary; dividing its rows by their hash")
    tied = dense_index(df.filter(at_edge), [key, *ties], "_tie")
    return (
        df.filter(before & ~at_edge).unionByName(tied.filter(F.col("_tie") < place).drop("_tie")),
        df.filter(~before & ~at_edge).unionByName(tied.filter(F.col("_tie") >= place).drop("_tie")),
    )


def holdout_split(
    df: DataFrame, key: str, fraction: float = 0.2, clamp_to_rest: bool = False, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(training, validation) with an exact validation size."""
    return exact_split(df, key, lambda n: holdout_size(n, fraction, clamp_to_rest), seed)


def subset(
    df: DataFrame, key: str, fraction: float = 0.0, name: str | None = None, seed: int = SEED
) -> DataFrame:
    """``training`` or ``validation`` part; all rows without a fraction or a name."""
    if not fraction or name not in ("training", "validation"):
        return df
    training, validation = holdout_split(df, key, fraction, clamp_to_rest=True, seed=seed)
    return training if name == "training" else validation


def shard(df: DataFrame, shards: int, index: str = "idx", name: str = "shard") -> DataFrame:
    """Row i belongs to pipeline ``i % shards``."""
    return df.withColumn(name, F.pmod(F.col(index), F.lit(shards)).cast("int"))


def batch(df: DataFrame, size: int, index: str = "idx", name: str = "batch_id") -> DataFrame:
    """Row i belongs to batch ``i div size``; the last batch may be short."""
    return df.withColumn(name, floor_div(F.col(index), size))


def repeat(df: DataFrame, times: int, name: str = "pass") -> DataFrame:
    """Every row once per pass, made in place by a generator: no join, no shuffle."""
    if times < 1:
        return df.withColumn(name, F.lit(0)).limit(0)
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def epoch_batches(df: DataFrame, size: int, epochs: int, index: str = "idx") -> DataFrame:
    """Batches as the epochs consume them.

    Batches are cut before the data repeats and an epoch takes ``n div size`` of
    them (at least one), so a short last batch opens the following epoch.
    Result: epoch, step, pass, batch_id, rows.
    """
    batches = batch(df, size, index).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    batches = freeze(batches, "batches")
    totals = batches.agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("per_pass")).first()
    if not totals["n"]:
        raise ValueError("no rows to batch")
    per_epoch = max(1, totals["n"] // size)
    passes = -(-epochs * per_epoch // totals["per_pass"])
    turn = F.col("pass").cast("bigint") * F.lit(totals["per_pass"]) + F.col("batch_id")
    return (
        repeat(batches, passes)
        .withColumn("_turn", turn)
        .withColumn("epoch", floor_div(F.col("_turn"), per_epoch))
        .withColumn("step", F.pmod("_turn", F.lit(per_epoch)))
        .filter(F.col("epoch") < epochs)
        .select("epoch", "step", "pass", "batch_id", "rows")
    )


def shuffle_epoch(df: DataFrame, key: str | None, epochs: int, seed: int = SEED, ties: Sequence[str] = ()) -> DataFrame:
    """A fresh full permutation per epoch: columns ``epoch`` and ``position``.

    Stronger than a bounded shuffle buffer, where a row cannot move far. All epochs are
    ordered together, and each holds as many rows as the input.
    """
    columns = df.columns
    if key is None:
        df, key = dense_index(df, name="_arrival"), "_arrival"
    n = df.count()
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.col("epoch").cast("string"), F.lit(":"),
                            F.coalesce(F.col(key).cast("string"), F.lit(""))))
    turns = repeat(df, epochs, "epoch").withColumn("_hash", hashed)
    placed = dense_index(turns, ["epoch", "_hash", key, *ties], "position", hashed=columns)
    return placed.withColumn("position", F.col("position") - F.col("epoch") * F.lit(n)).drop("_hash", "_arrival")


def buffer_shuffle(df: DataFrame, size: int = BUFFER_ROWS, epochs: int = 1, seed: int = SEED) -> DataFrame:
    """Rows as a bounded shuffle buffer in each pipeline (partition) hands them out: nothing is exchanged or sorted.

    A buffer of ``size`` rows is filled; each further row takes a drawn place, and the row
    there goes out; what is left at the end goes out in drawn order. Adds ``epoch``, ``shard``
    (the pipeline) and ``position`` (from 0 in its pipeline and epoch). Draws depend on the
    seed, epoch, pipeline and arrival alone. A pipeline of at most ``size`` rows is fully
    shuffled. Memory is one buffer and one Arrow batch; columns of these names give way.
    """
    if size < 1 or epochs < 0:
        raise ValueError("a buffer holds at least one row, and epochs are not negative")
    added = ("epoch", "shard", "position")
    source = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in added])
    schema = T.StructType([*source.schema.fields, T.StructField("epoch", T.IntegerType()), T.StructField("shard", T.IntegerType()),
                           T.StructField("position", T.LongType())])

    def turn(epoch: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = rng = held = None
            position = 0

            def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
                nonlocal position
                n = rows.num_rows
                marks = [pa.array(np.full(n, epoch, np.int32)), pa.array(np.full(n, shard, np.int32)), pa.array(position + np.arange(n))]
                for name, column in zip(added, marks):
                    rows = rows.append_column(name, column)
                position += n
                yield from rows.combine_chunks().to_batches()

            for batch in batches:
                if not batch.num_rows:
                    continue
                if rng is None:
                    shard = batch.column(batch.num_columns - 1)[0].as_py()
                    rng = np.random.default_rng([seed, epoch, shard])
                fresh = pa.Table.from_batches([batch]).select(list(range(batch.num_columns - 1)))
                missing = size - (held.num_rows if held is not None else 0)
                if missing:
                    first = fresh.slice(0, missing)
                    held = first if held is None else pa.concat_tables([held, first])
                    fresh = fresh.slice(missing)
                if fresh.num_rows:
                    leaves, stays = _replaced((rng.random(fresh.num_rows) * size).astype(np.int64), size)
                    both = pa.concat_tables([held, fresh]).combine_chunks()
                    held = both.take(pa.array(stays))
                    yield from out(both.take(pa.array(leaves)))
            if held is not None and held.num_rows:
                yield from out(held.combine_chunks().take(pa.array(np.argsort(rng.random(held.num_rows), kind="stable"))))

        return run

    # The number of a partition in its epoch; a task's own number goes on from one epoch to the next.
    numbered = source.withColumn("_pipeline", F.spark_partition_id())
    turns = [numbered.mapInArrow(turn(e), schema) for e in range(epochs)]
    return reduce(DataFrame.union, turns) if turns else df.sparkSession.createDataFrame([], schema)


def _replaced(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a buffer (rows 0 .. size - 1) and arrivals (rows size, ..) at drawn places: which rows leave, in order, and which stay."""
    n = len(places)
    order = np.argsort(places, kind="stable")
    before = np.empty(n, np.int64)
    same = np.concatenate([[False], places[order][1:] == places[order][:-1]])
    before[order] = np.where(same, size + np.concatenate([[0], order[:-1]]), places[order])
    stays = np.arange(size)
    stays[places[order]] = size + order  # the last arrival at a place stays
    return before, stays


def spread(df: DataFrame, partitions: int = 16) -> DataFrame:
    """Even out a skewed read."""
    return df.repartition(partitions)


def zip_by_index(left: DataFrame, right: DataFrame, index: str = "idx") -> DataFrame:
    """Positional zip of two equally long sequences that carry a dense index."""
    return left.join(right, index)

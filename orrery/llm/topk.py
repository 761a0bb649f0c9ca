"""Exact top-k by inner product: Voronoi kNN join.

Data vectors go to the cell of their nearest pivot. A cell's summary is its count and its
radius: for every x of it, q.x lies within q.p +- |q| * radius. From the summaries alone each
query has a lower bound of its k-th score; its best cell is solved first and raises that
bound, and copies of the query go only to cells whose upper bound reaches it. Cells are
solved locally and the local results merged, so the result is exact.

Pivots come from a bounded sample and decide cells only. A cell of over ``PART_ROWS`` rows is
dealt to parts, queries to blocks, so a task holds a bounded part and a bounded block. Queries
of a block start in the same or neighbouring cells, and a cell's rows go only to the blocks
that hold a copy for it. Where the bounds prune nothing, as in random vectors of many
dimensions, that is every block, and rows sent grow with data rows times blocks.

Vectors are integers floor(256 * x). Null vectors, vectors that hold null or non-finite
components and rows with a null id take no part; shorter vectors count as filled up with
zeros; ties go to the smaller id; rows that share an id are rows of their own, and none of
them answers a query of that id; a query's equal rows are one query. Scores beyond a long
saturate. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from orrery.llm.common import col, each_batch, hash_sample, keep
from orrery.llm.vectors import finite, matrix
from orrery.operators.joins import lookup_join

PIVOTS = 256
PIVOT_SAMPLE = 10_000
#: Rows that stand behind a pivot, at least.
PIVOT_ROWS = 1000
#: Rows of a cell that one task holds, and queries of a block.
PART_ROWS = 20_000
QUERY_ROWS = 10_000
#: Bounds are loosened by this share, so that rounding loses nothing.
SLACK = 1e-9
SEED = 42


def integers(vector: str, scale: int = 256):
    """floor(scale * x) of each component, as a double (a whole number)."""
    return F.transform(col(vector), lambda x: _floor(x.cast("double") * F.lit(float(scale))))


def _floor(x):
    # Beyond 2**52 doubles are whole already, and floor() would leave the range of a long.
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def choose_pivots(sample: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Pivots by a few rounds of k-means on the sample."""
    if not len(sample):
        return np.zeros((0, sample.shape[1]))
    pivots = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)].copy()
    for _ in range(3):
        near = nearest(sample, pivots)[0]
        sums, sizes = np.zeros_like(pivots), np.bincount(near, minlength=len(pivots))
        np.add.at(sums, near, sample)
        pivots[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return pivots


def nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and the distance to it."""
    square = (pivots * pivots).sum(axis=1)[None, :] - 2 * rows @ pivots.T
    near = np.argmin(square, axis=1)
    return near, np.sqrt(((rows - pivots[near]) ** 2).sum(axis=1))


def lay_blocks(pivots: np.ndarray, asked: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell the first block and the number of blocks of the queries that start in it.

    Cells follow each other along the direction of the pivot farthest from the middle and share
    a block while it has room; a cell with more than ``size`` queries has blocks of its own.
    """
    away = pivots - pivots.mean(axis=0) if len(pivots) else pivots
    along = away @ away[np.argmax((away * away).sum(axis=1))] if len(pivots) else np.zeros(0)
    base, count = np.zeros(len(pivots), np.int64), np.ones(len(pivots), np.int64)
    block = held = 0
    for c in np.argsort(along, kind="stable").tolist():
        if held and held + asked[c] > size:
            block, held = block + 1, 0
        base[c], count[c] = block, max(1, -(-int(asked[c]) // size))
        if count[c] > 1:
            block += int(count[c])
        else:
            held += int(asked[c])
    return base, count


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as longs."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    reach = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    if reach < 2.0**53:
        return (queries @ rows.T).astype(np.int64)
    whole = np.array([[int(v) for v in q] for q in queries.tolist()], object) @ np.array([[int(v) for v in r] for r in rows.tolist()], object).T
    return np.array([[max(-(1 << 63), min((1 << 63) - 1, v)) for v in line] for line in whole], np.int64)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """(query place, id, score) of each query's k best rows, ties by id."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    step = max(1, (1 << 22) // max(1, len(rows)))
    for at in range(0, len(queries), step):
        for i, line in enumerate(scores(queries[at : at + step], rows), start=at):
            others = np.flatnonzero(ids != query_ids[i])
            line = line[others]
            if len(line) > k:
                floor = np.partition(line, len(line) - k)[len(line) - k]
                some = np.flatnonzero(line >= floor)
                others, line = others[some], line[some]
            top = np.argsort(-line, kind="stable")[:k] if not (line == -(1 << 63)).any() else np.lexsort((ids[others], ~line))[:k]
            for j in top:
                yield i, int(ids[others[j]]), int(line[j])


def _first_cell(queries: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.argmax(queries @ pivots.T, axis=1).astype(np.int64)


def _solve(width: int, k: int):
    def run(data: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if data.num_rows and asked.num_rows:
            keys = asked["query"].to_pylist()
            found = best(matrix(asked["vector"], width), asked["query_id"].to_numpy(), matrix(data["vector"], width), data["id"].to_numpy(), k)
            out = [(keys[i], d, s) for i, d, s in found]
        columns = list(zip(*out)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query", "id", "score"), columns)})

    return run


def top_k(data: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best rows of ``data`` with another id."""
    spark = data.sparkSession

    def whole(rows: DataFrame) -> DataFrame:
        able = rows.filter(finite(vector) & col(vec_id).isNotNull())
        return able.select(col(vec_id).cast("long").alias("id"), integers(vector).alias("vector"))

    rows = whole(data)
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    asked = keep(whole(queries).distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    asked_shape = asked.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = max(shape["width"] or 1, asked_shape["width"] or 1, 1)
    drawn = hash_sample(rows.select("vector", "id"), shape["n"], PIVOT_SAMPLE, "id", "vector").collect()
    sample = np.zeros((len(drawn), width))
    for i, r in enumerate(drawn):
        sample[i, : len(r[0])] = r[0]
    points = choose_pivots(sample, max(1, min(pivots, -(-shape["n"] // PIVOT_ROWS))), np.random.default_rng(SEED))
    shared = spark.sparkContext.broadcast(points)

    def assign(batch: pa.RecordBatch):
        at, distance = nearest(matrix(batch["vector"], width), shared.value) if batch.num_rows else (np.zeros(0, int), np.zeros(0))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int64)), pa.array(distance)], names=["id", "vector", "cell", "distance"])

    told = rows.mapInArrow(each_batch(assign), "id long, vector array<double>, cell long, distance double")
    cells = keep(told.withColumn("row", F.monotonically_increasing_id()), "voronoi-cells")
    # One row per pivot.
    summary = {r["cell"]: (r["n"], r["radius"]) for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
    numbers = np.array(sorted(summary), np.int64)
    sizes = np.array([summary[c][0] for c in numbers.tolist()], np.int64)
    radii = np.array([summary[c][1] for c in numbers.tolist()])
    parts = -(-sizes // PART_ROWS)
    middles = points[numbers] if len(numbers) else points
    starts = spark.sparkContext.broadcast(middles)

    def start(batch: pa.RecordBatch):
        if batch.num_rows and len(starts.value):
            yield pa.RecordBatch.from_arrays([pa.array(_first_cell(matrix(batch["vector"], width), starts.value))], names=["place"])

    # One row per pivot.
    begun = asked.select("vector").mapInArrow(each_batch(start), "place long").groupBy("place").count().collect()
    load = np.zeros(len(middles), np.int64)
    for r in begun:
        load[r["place"]] = r["count"]
    bounds = spark.sparkContext.broadcast((middles, numbers, sizes, radii, parts, *lay_blocks(middles, load, QUERY_ROWS)))

    def reach(batch: pa.RecordBatch):
        """Cells that a query needs by the summaries: (.., cell, part, upper bound, first, block)."""
        pivots, numbers, sizes, radii, parts, base, spread = bounds.value
        if not batch.num_rows or not len(numbers):
            return
        q = matrix(batch["vector"], width)
        middle, swing = q @ pivots.T, np.sqrt((q * q).sum(axis=1))[:, None] * radii[None, :]
        loose = SLACK * (np.abs(middle) + swing + 1)
        low, high = middle - swing - loose, middle + swing + loose
        own, begin = batch["own"].to_numpy(), _first_cell(q, pivots)
        block = base[begin] + batch["query"].to_numpy() % spread[begin]
        for i in range(len(q)):
            order = np.argsort(-low[i])
            # k others besides the rows of the query's own id stand at or above this bound.
            enough = int(np.searchsorted(np.cumsum(sizes[order]), k + own[i]))
            bound = low[i, order[enough]] if enough < len(order) else -np.inf
            first = int(begin[i])
            need = np.flatnonzero((high[i] >= bound) | (np.arange(len(numbers)) == first))
            copies = np.repeat(need, parts[need])
            part = np.arange(len(copies)) - np.repeat(np.cumsum(parts[need]) - parts[need], parts[need])
            take = pa.array(np.full(len(copies), i))
            yield pa.RecordBatch.from_arrays(
                [*[batch[c].take(take) for c in ("query_id", "vector", "query")], pa.array(numbers[copies]), pa.array(part.astype(np.int64)), pa.array(high[i, copies]), pa.array(copies == first), pa.array(np.full(len(copies), block[i]))],
                names=["query_id", "vector", "query", "cell", "part", "high", "first", "block"],
            )

    # Rows with a query's own id fill cells and answer it nowhere.
    repeated = cells.groupBy("id").agg(F.count("*").alias("own")).filter("own > 1")
    named = asked.join(repeated, "id", "left").select(F.col("id").alias("query_id"), "vector", "query", F.coalesce("own", F.lit(1)).alias("own"))
    needed = named.mapInArrow(each_batch(reach), "query_id long, vector array<double>, query long, cell long, part long, high double, first boolean, block long")
    needed = keep(needed, "query-copies")

    of_cell = F.create_map(*[F.lit(int(v)) for pair in zip(numbers.tolist(), parts.tolist()) for v in pair]) if len(numbers) else F.create_map(F.lit(0), F.lit(1))
    dealt = cells.withColumn("part", F.pmod(F.xxhash64("row"), of_cell[F.col("cell").cast("int")]).cast("long"))
    dealt = dealt.select("id", "vector", "cell", "part")
    key = ("cell", "part", "block")

    def solved(copies: DataFrame) -> DataFrame:
        # A query asks all parts of a cell, so the blocks of a cell, at most all of them, are those of its parts.
        blocks = keep(copies.groupBy("cell").agg(F.collect_set("block").alias("blocks")), "cell-blocks")
        sent = lookup_join(dealt, blocks, "cell").select("id", "vector", "cell", "part", F.explode("blocks").alias("block"))
        return sent.groupBy(*key).cogroup(copies.groupBy(*key)).applyInArrow(_solve(width, k), "query long, id long, score long")

    first = keep(solved(needed.filter("first")), "first-cells")
    # The k-th score so far, where k rows were found.
    ranked = first.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id")))
    floor = ranked.filter(F.col("r") == k).select("query", F.col("score").alias("floor"))
    further = needed.filter(~F.col("first")).join(floor, "query", "left").filter(F.col("floor").isNull() | (F.col("high") >= F.col("floor").cast("double"))).drop("floor")
    merged = first.union(solved(keep(further, "further-copies")))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    top = merged.withColumn("rank", rank).filter(F.col("rank") <= k)
    return top.join(named.select("query", "query_id"), "query").select("query_id", "rank", F.col("id").alias("vec_id"), "score")

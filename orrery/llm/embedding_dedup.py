"""Embedding near-duplicates by a forest of random-projection trees with spill overlap.

A node projects unit vectors on a random direction and divides them at the median; vectors
within a margin of it go to both sides. The margin is a share of the chord that belongs to
the threshold, so a linked pair is parted at a node only if it straddles the whole overlap,
and is lost only if that happens in every tree. Directions and medians come from a bounded
sample; every vector is placed in every tree. Leaves of one label are shards, in which all
pairs are compared by cosine in double precision; nothing below the threshold is linked.

Equal vectors of a label are one class with a multiplicity. Each vector carries the leaves it
lies in, and a pair counts only in the first leaf that it shares, so leaves hand back counts
and spanning forests and no pairs are written out, however large a group of near copies is.

Null, zero and non-finite vectors, and rows without a label, link with nothing. Shorter
vectors count as filled up with zeros. Rows with equal ids are rows of their own; a null id
takes part and is never a component's id unless all of it is null. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from orrery.llm.common import col, each_batch, hash_sample, keep
from orrery.llm.components import Forest, components, split_shards
from orrery.llm.vectors import finite, matrix, unit

THRESHOLD = 0.98
TREES = 4
#: Spill margin on each side of a median, as a share of the threshold's chord.
SPILL = 0.1
TREE_SAMPLE = 20_000
#: Vectors of a leaf over all labels, as far as the splits reach, and rows compared in one task.
LEAF = 4000
CELL = 8000
SEED = 42


def build_tree(rows: np.ndarray, scale: float, leaf: int, margin: float, rng: np.random.Generator):
    """A node (direction, median, left, right) or None for a leaf; ``scale`` vectors stand behind each row."""
    if len(rows) * scale <= leaf or len(rows) < 8:
        return None
    direction = rng.standard_normal(rows.shape[1])
    direction /= np.linalg.norm(direction)
    along = rows @ direction
    middle = float(np.median(along))
    left, right = along <= middle + margin, along >= middle - margin
    if max(left.sum(), right.sum()) > 0.8 * len(rows):  # close together: the cells of a leaf will share them
        return None
    return (direction, middle, build_tree(rows[left], scale, leaf, margin, rng), build_tree(rows[right], scale, leaf, margin, rng))


def leaves_of(tree, rows: np.ndarray, margin: float) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf number, rows in it)."""
    stack, number = [(tree, np.arange(len(rows)))], 0
    while stack:
        node, inside = stack.pop()
        if node is None:
            yield number, inside
            number += 1
            continue
        direction, middle, left, right = node
        along = rows[inside] @ direction
        stack.append((right, inside[along >= middle - margin]))
        stack.append((left, inside[along <= middle + margin]))


def shared_before(a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    """Whether rows of leaf lists (filled up with -1) share a leaf below ``leaf``."""
    out = np.zeros(len(a), bool)
    for k in range(a.shape[1]):
        mine = a[:, k]
        out |= (mine >= 0) & (mine < leaf) & (b == mine[:, None]).any(axis=1)
    return out


def _compare(threshold: float, width: int):
    """A cell of a shard to rows (node, n, root): new links of each class, and its root in the cell."""

    def run(table: pa.Table) -> pa.Table:
        shard, x, y = table["shard"][0].as_py(), table["x"][0].as_py(), table["y"][0].as_py()
        nodes, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        vectors = unit(matrix(table["vector"], width))
        lists = table["leaves"].combine_chunks()
        leaves = matrix(lists, int(pc.max(pc.list_value_length(lists)).as_py()), np.int64)
        filled = pc.list_value_length(lists).to_numpy()
        leaves[np.arange(leaves.shape[1])[None, :] >= filled[:, None]] = -1
        side = table["part"].to_numpy() == x
        links = np.zeros(len(nodes), np.int64)
        forest = Forest(len(nodes))
        step = max(1, (1 << 22) // len(nodes))
        for at in range(0, len(nodes), step):
            close = vectors[at : at + step] @ vectors.T >= threshold
            close &= np.arange(len(nodes))[None, :] > np.arange(at, at + len(close))[:, None]
            if x != y:
                close &= side[at : at + step, None] != side[None, :]
            for i in np.flatnonzero(close.any(axis=1)).tolist():
                others = np.flatnonzero(close[i])
                forest.join(at + i, others)
                new = others[~shared_before(np.repeat(leaves[at + i][None, :], len(others), 0), leaves[others], shard)]
                links[at + i] += int(copies[new].sum())
                links[new] += int(copies[at + i])
        some = np.flatnonzero((links > 0) | (forest.label != np.arange(len(nodes))))
        return pa.table({"node": nodes[some], "n": links[some], "root": nodes[forest.label[some]]})

    return run


def embedding_groups(rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                     trees: int = TREES, leaf: int = LEAF, cell: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = rows.sparkSession
    able = finite(vector) & F.exists(col(vector), lambda x: x != 0) & col(label).isNotNull()
    named = rows.select(col(vec_id).cast("long").alias("vec_id"), col(vector).alias("vector"), col(label).alias("label"), F.coalesce(able, F.lit(False)).alias("able"))
    classes = named.filter("able").groupBy("label", "vector").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    classes = keep(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    shape = classes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    count, width = shape["n"], shape["width"] or 1
    drawn = hash_sample(classes.select("vector", "label"), count, TREE_SAMPLE, "vector", "label")
    sample = [r["vector"] for r in drawn.collect()]
    points = np.zeros((len(sample), width))
    for i, v in enumerate(sample):
        points[i, : len(v)] = v
    points = unit(points) if len(points) else points
    margin = SPILL * math.sqrt(2 - 2 * threshold)
    rng = np.random.default_rng(SEED)
    scale = count / max(1, len(points))
    shared = spark.sparkContext.broadcast([build_tree(points, scale, leaf, margin, rng) for _ in range(trees)])

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        points = unit(matrix(batch["vector"], width)) if batch.num_rows else np.zeros((0, width))
        placed = [(t * (1 << 40) + n, i) for t, tree in enumerate(shared.value) for n, inside in leaves_of(tree, points, margin) for i in inside.tolist()]
        mine: list[list[int]] = [[] for _ in range(batch.num_rows)]
        for shard, i in placed:
            mine[i].append(shard)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mine, pa.list_(pa.int64()))], names=[*batch.schema.names, "leaves"])

    kind = classes.schema["label"].dataType.simpleString(), classes.schema["vector"].dataType.simpleString()
    held = classes.select("node", "label", "vector", "copies").mapInArrow(each_batch(place), f"node long, label {kind[0]}, vector {kind[1]}, copies long, leaves array<long>")
    dealt = keep(held.withColumn("shard", F.explode("leaves")), "projection-leaves")
    cells = split_shards(dealt, ["label", "shard"], cell)
    found = keep(cells.groupBy("label", "shard", "x", "y").applyInArrow(_compare(threshold, width), "node long, n long, root long"), "vector-links")

    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = keep(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), "vector-roots")
    lows = roots.join(classes.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("component"))
    told = classes.join(counts, "node", "left").join(roots.join(lows, "root").select("node", "component"), "node", "left")
    told = told.select("label", "vector", F.coalesce("component", "low").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    told = told.withColumnsRenamed({"label": "_label", "vector": "_vector"})
    every = named.join(told, F.col("able") & (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left")
    component = F.coalesce("component_id", "vec_id")
    return every.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

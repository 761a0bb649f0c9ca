"""SimHash near-duplicates, linked through vantage-point trees.

Fingerprints of 64 bits are cut into four blocks of 16. Two fingerprints that differ in at
most 4 bits differ in at most one bit of some block, so four trees, one for each block with
Hamming radius 1, find every pair. A tree node holds a vantage point p and a bound m:
fingerprints nearer to p than m go left, the others right. A pair within the radius r is
divided only if both lie within r of the bound (triangle inequality), so a left member at
distance m - r or more also goes right as a query. Leaves are shards: members are compared
with one another, queries with members, on all 64 bits.

The trees are built on a bounded sample of fingerprints, which only places the bounds: every
fingerprint is indexed and the links are exact. Equal fingerprints are one node, leaves give
back a spanning forest of their links instead of pairs, and a leaf that the tree can't divide
is dealt to cells.

Null texts are empty; a document without words has fingerprint 0 and links like any other.
Rows with a null ``doc_id`` take part; a group of such rows alone has a null component.
Repeated rows keep a row each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orrery.llm.common import col, each_batch, free_name, hash_sample, keep
from orrery.llm.components import Forest, components, split_shards

BITS = 64
RADIUS = 4
BLOCKS = 4
SHINGLE = 4
SEED = 42
#: Fingerprints that place the bounds of the trees.
TREE_SAMPLE = 20_000
#: Members of a leaf, as far as bounds divide it, and rows of a leaf that are compared in one task.
LEAF = 1500
CELL = 20_000

#: SPREAD[b]: the bits of byte b, lowest first, each in a byte of its own.
_SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    if not len(hashes):
        return np.zeros(BITS, np.int64)
    # Up to 255 hashes are added up in single bytes.
    cuts = np.arange(0, len(hashes), 255)
    out = np.empty((8, 8), np.int64)
    for byte in range(8):
        sums = np.add.reduceat(_SPREAD[(hashes >> np.uint64(8 * byte)) & np.uint64(255)], cuts)
        out[byte] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0)
    return out.ravel()


def majority(hashes: np.ndarray) -> int:
    """The bits that over half the hashes have set; 0 without hashes."""
    ones = bit_counts(hashes) * 2 > len(hashes)
    return int.from_bytes(np.packbits(ones, bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    # ASCII white space divides words, and only A-Z are lower-cased: bytes do both.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words)) - 1
    hashes = [xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[: len(starts) - k].tolist(), ends[k:].tolist())]
    return majority(np.array(hashes, np.uint64))


def _fingerprints(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    values = np.array([fingerprint(t.as_py()) for t in batch["text"]], np.uint64).view(np.int64)
    yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(values)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    return rows.mapInArrow(each_batch(_fingerprints), "doc_id long, fp long")


def build_tree(values: np.ndarray, scale: float, leaf: int, radius: int, rng: np.random.Generator):
    """A node (vantage, bound, left, right), or None for a leaf; ``scale`` members stand behind each value."""
    if len(values) * scale <= leaf or len(np.unique(values)) < 2:
        return None
    best = None
    for vantage in rng.choice(values, 8):
        distances = np.bitwise_count(values ^ vantage)
        for bound in np.unique(distances)[1:]:
            left = np.count_nonzero(distances < bound)
            near = np.count_nonzero((distances < bound) & (distances >= bound - radius))
            right = len(values) - left
            cost = left * left + right * right + 2 * near * right
            if best is None or cost < best[0]:
                best = (cost, vantage, int(bound), distances < bound)
    if best is None or best[0] > 0.97 * len(values) ** 2:
        return None
    _, vantage, bound, left = best
    return (vantage, bound, build_tree(values[left], scale, leaf, radius, rng), build_tree(values[~left], scale, leaf, radius, rng))


def route(tree, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf number, members, queries): places in ``values`` of what meets in each leaf."""
    everything = np.arange(len(values))
    stack, number = [(tree, everything, everything[:0])], 0
    while stack:
        node, members, queries = stack.pop()
        if node is None:
            if len(members) or len(queries):
                yield number, members, queries
            number += 1
            continue
        vantage, bound, left, right = node
        dm, dq = np.bitwise_count(values[members] ^ vantage), np.bitwise_count(values[queries] ^ vantage)
        crossing = members[(dm < bound) & (dm.astype(int) + radius >= bound)]
        stack.append((right, members[dm >= bound], np.concatenate([queries[dq.astype(int) + radius >= bound], crossing])))
        stack.append((left, members[dm < bound], queries[dq.astype(int) - radius < bound]))


def leaf_links(fps: np.ndarray, member: np.ndarray, first: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between members, and of queries with members.

    With ``first`` (a mask), only pairs of a row inside and a row outside it are compared.
    """
    order = np.argsort(~member, kind="stable")
    fps, n_members = fps[order], int(member.sum())
    side = None if first is None else first[order]
    forest = Forest(len(fps))
    # Four fingerprints may be alike as members and queries: members alone answer.
    answers = fps[:n_members]
    step = max(1, (1 << 21) // max(1, n_members))
    for at in range(0, len(fps), step):
        block = fps[at : at + step]
        close = np.bitwise_count(block[:, None] ^ answers[None, :]) <= radius
        if side is not None:
            close &= side[at : at + step, None] != side[None, :n_members]
        linked = np.flatnonzero(close.any(axis=1))
        for i in linked:
            forest.join(at + int(i), np.flatnonzero(close[i]))
    moved = np.flatnonzero(forest.label != np.arange(len(fps)))
    return fps[moved], fps[forest.label[moved]]


def near_pairs(fps: DataFrame, radius: int = RADIUS, leaf: int = LEAF, cell: int = CELL, sample: int = TREE_SAMPLE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that give their components."""
    count = fps.count()
    drawn = hash_sample(fps.select("fp"), count, sample, "fp").collect()
    values = np.array([r[0] for r in drawn], np.int64).view(np.uint64)
    block_radius, width = radius // BLOCKS, BITS // BLOCKS
    mask = np.uint64((1 << width) - 1)
    rng = np.random.default_rng(SEED)
    trees = [build_tree((values >> np.uint64(width * b)) & mask, count / max(1, len(values)), leaf, block_radius, rng) for b in range(BLOCKS)]
    shared = fps.sparkSession.sparkContext.broadcast(trees)

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        all_fps = batch["fp"].to_numpy()
        for tree, root in enumerate(shared.value):
            blocks = (all_fps.view(np.uint64) >> np.uint64(width * tree)) & mask
            for number, members, queries in route(root, blocks, block_radius):
                picked = np.concatenate([members, queries])
                shard = np.full(len(picked), tree * (1 << 40) + number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(all_fps[picked]), pa.array(np.arange(len(picked)) < len(members))], names=["shard", "fp", "member"],
                )

    placed = keep(fps.select("fp").mapInArrow(each_batch(place), "shard long, fp long, member boolean"), "vantage-leaves")
    cells = split_shards(placed, ["shard"], cell)

    def links(table: pa.Table) -> pa.Table:
        rows = table["fp"].to_numpy().view(np.uint64)
        member = table["member"].to_numpy(zero_copy_only=False)
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        first = None if x == y else table["part"].to_numpy() == x
        a, b = leaf_links(rows, member, first, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return cells.groupBy("shard", "x", "y").applyInArrow(links, "a long, b long")


def _rooted(docs: DataFrame, doc_id: str, text: str, radius: int) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row: components whose smallest ids are equal differ in root."""
    rows = keep(fingerprints(docs, doc_id, text), "fingerprints")
    least = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    linked = components(near_pairs(least.select("fp"), radius)).withColumnsRenamed({"node": "fp"})
    linked = keep(linked.union(linked.select(F.col("root").alias("fp"), "root").distinct()), "fingerprint-roots")
    lows = linked.join(least, "fp").groupBy("root").agg(F.min("least").alias("low"))
    named = linked.join(lows, "root").select("fp", "root", "low")
    every = least.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("low", "least").alias("component_id"))
    return rows.join(every, "fp").select("doc_id", "fp", "root", "component_id")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row: component_id is the smallest doc_id linked to it."""
    return _rooted(docs, doc_id, text, radius).drop("root")


def near_duplicates_removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, one of each group: the first by id, then by text. Rows without an id stay.

    A row is told by its id and fingerprint, so texts of one id that are in different groups
    are kept or removed each on its own.
    """
    from pyspark.sql.window import Window

    groups = _rooted(docs, doc_id, text, RADIUS).filter(F.col("doc_id") == F.col("component_id"))
    named = {"doc_id": free_name(docs, "stay"), "fp": free_name(docs, "print"), "root": free_name(docs, "group")}
    copy = free_name(docs, "copy")
    stay = groups.select(*named).distinct().withColumnsRenamed(named)
    own, mark, root = (F.col(n) for n in named.values())
    told = F.pandas_udf(lambda texts: texts.map(lambda t: int(np.uint64(fingerprint(t)).view(np.int64))).astype("int64"), "long")
    own_mark = free_name(docs, "own_print")
    printed = docs.filter(col(doc_id).isNotNull()).withColumn(own_mark, told(col(text)))
    order = Window.partitionBy(root).orderBy(col(text))
    kept = printed.join(stay, (col(doc_id).cast("long") == own) & (F.col(own_mark) == mark)).withColumn(copy, F.row_number().over(order))
    nameless = docs.filter(col(doc_id).isNull())
    return kept.filter(F.col(copy) == 1).select(*[col(c) for c in docs.columns]).unionByName(nameless)

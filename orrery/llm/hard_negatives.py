"""Hard negatives by Fagin's threshold algorithm.

For each anchor row: its positives are the rows of its label with the greatest integer inner
products; for each positive, the hard negatives are the best rows of other labels whose score
lies between a share of the positive's score and that score (its window).

Rows are dealt to parts of a bounded size. Within a part every dimension has a list of the
rows sorted by that component. An anchor reads each list from the end that its own sign makes
best (a zero component's list is left out), so the components at the current depth, weighted by
the anchor, bound the score of every row not met yet: the threshold. A row met in any list is
scored whole at once (random access). Reading stops when the threshold is strictly below the
k-th score of every window, or below the least score a window admits. Parts hand back k rows
a window, and merging those is exact.

Labels of over ``PART_ROWS`` rows have parts of their own, as many as they need; other labels
share parts by hash. Positives are sought in the parts of the anchor's label only, negatives in
all parts. A part meets its anchors in blocks of ``ANCHOR_ROWS``.

Rows with a null id, a null label, a null vector, or a null or non-finite component take no
part; shorter vectors count as filled up with zeros; ties go to the smaller id; rows that share
an id are rows of their own, and none of them is a positive of that id; an anchor's equal rows
are one anchor. Scores beyond a long saturate. An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from orrery.llm.common import col, keep
from orrery.llm.topk import integers, scores
from orrery.llm.vectors import finite, matrix
from orrery.runtime import fits_broadcast

#: Rows of a part, and anchors of a block.
PART_ROWS = 50_000
ANCHOR_ROWS = 50_000
#: Depth that is read first; it doubles with every step.
DEPTH = 8
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


class Lists:
    """Rows of a part by id, and for each dimension the rows in descending order of it."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.rows, self.ids, self.order = rows[order], ids[order], order
        self.down = np.argsort(-self.rows, axis=0, kind="stable").astype(np.int32)
        self.reach = float(np.abs(self.rows).max()) if self.rows.size else 0.0

    def exact(self, anchor: np.ndarray) -> bool:
        """Whether doubles hold every score and threshold exactly."""
        return self.reach * float(np.abs(anchor).max(initial=0.0)) * len(anchor) < 2.0**53

    def read(self, anchor: np.ndarray, windows: list[tuple[int, int]], k: int, allowed: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, scores) of the best ``k`` allowed rows in each window (least score, greatest score)."""
        n = len(self.ids)
        seen, value = np.zeros(n, bool), np.zeros(n, np.int64)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        exact = self.exact(anchor)
        depth, size = 0, DEPTH
        while depth < n:
            end = min(n, depth + size)
            if len(up) + len(down):
                met = np.zeros(n, bool)
                met[self.down[depth:end, up]] = True
                met[self.down[n - end : n - depth, down]] = True
                met &= ~seen
            else:  # an anchor of zeros has no list to read: all rows score alike
                met, end = ~seen, n
            fresh = np.flatnonzero(met)
            if len(fresh):
                value[fresh] = (self.rows[fresh] @ anchor).astype(np.int64) if exact else scores(anchor[None, :], self.rows[fresh])[0]
                seen |= met
            depth, size = end, 2 * size
            if depth == n or self._settled(seen & allowed, value, windows, k, self._threshold(anchor, depth - 1, exact)):
                break
        return [self._best(seen & allowed, value, window, k) for window in windows]

    def _threshold(self, anchor: np.ndarray, depth: int, exact: bool) -> int:
        """What a row that stands below ``depth`` in every list can score at most."""
        place = np.where(anchor > 0, depth, len(self.ids) - 1 - depth)
        edge = self.rows[self.down[place, np.arange(len(anchor))], np.arange(len(anchor))]
        if exact:
            return int(edge @ anchor)
        return max(_LEAST, min(_MOST, sum(int(a) * int(e) for a, e in zip(anchor.tolist(), edge.tolist()))))

    def _settled(self, usable: np.ndarray, value: np.ndarray, windows: list[tuple[int, int]], k: int, threshold: int) -> bool:
        got = value[usable]
        for low, high in windows:
            inside = got[(got >= low) & (got <= high)]
            floor = np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else low
            if threshold >= floor:
                return False
        return True

    @staticmethod
    def _best(usable: np.ndarray, value: np.ndarray, window: tuple[int, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero(usable & (value >= window[0]) & (value <= window[1]))
        # Rows stand by id, so a stable order by score leaves ties to the smaller id; ~ reverses longs without overflow.
        top = rows[np.argsort(~value[rows], kind="stable")[:k]]
        return top, value[top]


def window_of(score: int, share: tuple[int, int]) -> tuple[int, int]:
    """Least and greatest score n with share[0] * score <= share[1] * n <= share[1] * score."""
    return -(-share[0] * score // share[1]), score


def _tables(data: pa.Table, asked: pa.Table, width: int) -> Iterator:
    """Matrices, ids and label numbers of both sides."""
    labels = pa.chunked_array([*data["label"].chunks, *asked["label"].chunks], data["label"].type).combine_chunks().dictionary_encode()
    numbers = labels.indices.to_numpy(zero_copy_only=False)
    return matrix(data["vector"], width), data["id"].to_numpy(), numbers[: data.num_rows], matrix(asked["vector"], width), numbers[data.num_rows :]


def _out(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _positives(width: int, k: int):
    def run(data: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if data.num_rows and asked.num_rows:
            rows, ids, labels, anchors, own = _tables(data, asked, width)
            keys, names = asked["anchor"].to_pylist(), asked["id"].to_numpy()
            for label in np.unique(own).tolist():
                some = labels == label
                if not some.any():
                    continue
                lists = Lists(rows[some], ids[some])
                for i in np.flatnonzero(own == label).tolist():
                    for top, value in lists.read(anchors[i], [(_LEAST, _MOST)], k, lists.ids != names[i]):
                        found += [(keys[i], int(lists.ids[r]), int(v)) for r, v in zip(top, value)]
        return _out(found, ("anchor", "id", "score"))

    return run


def _negatives(width: int, k: int, share: tuple[int, int]):
    def run(data: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if data.num_rows and asked.num_rows:
            rows, ids, labels, anchors, own = _tables(data, asked, width)
            lists = Lists(rows, ids)
            labels = labels[lists.order]
            keys, targets = asked["anchor"].to_pylist(), asked["targets"].to_pylist()
            for i, key in enumerate(keys):
                windows = [window_of(t, share) for t in targets[i]]
                for target, (top, value) in zip(targets[i], lists.read(anchors[i], windows, k, labels != own[i])):
                    found += [(key, target, int(lists.ids[r]), int(v)) for r, v in zip(top, value)]
        return _out(found, ("anchor", "target", "id", "score"))

    return run


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
    vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` tells which of ``rows`` are anchors. A negative's score n of a positive's score p
    satisfies share[0] * p <= share[1] * n <= share[1] * p.
    """
    able = rows.filter(finite(vector) & col(vec_id).isNotNull() & col(label).isNotNull())
    chosen = able.select(
        col(vec_id).cast("long").alias("id"), col(label).alias("label"), integers(vector, scale).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    table = keep(chosen.withColumn("row", F.monotonically_increasing_id()), "negative-rows")
    shape = table.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    width, shared = max(shape["width"] or 1, 1), max(1, -(-shape["n"] // PART_ROWS))

    # One row for each label of more rows than a part holds: its first part and how many it has.
    sizes = table.groupBy("label").agg(F.count("*").alias("n")).filter(F.col("n") > PART_ROWS)
    sizes = sizes.select("label", F.ceil(F.col("n") / PART_ROWS).alias("parts"))
    before = Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    large = keep(sizes.withColumn("start", shared + F.coalesce(F.sum("parts").over(before), F.lit(0))), "large-labels")
    parts = int(large.agg(F.coalesce(F.max(F.col("start") + F.col("parts")), F.lit(shared))).first()[0])
    small = F.broadcast(large) if fits_broadcast(large) else large
    hashed = F.pmod(F.xxhash64("label"), F.lit(shared))

    asked = table.filter("anchor").select("id", "label", "vector").distinct()
    asked = keep(asked.withColumn("anchor", F.monotonically_increasing_id()).join(small, "label", "left"), "anchors")
    blocks = max(1, -(-asked.count() // ANCHOR_ROWS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("long"))

    part = F.coalesce(F.col("start") + F.pmod(F.xxhash64("row"), F.col("parts")), hashed).cast("long")
    dealt = table.join(small, "label", "left").select(
        "id", "label", "vector", part.alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    )

    def solved(copies: DataFrame, solve, schema: str) -> DataFrame:
        return dealt.groupBy("part", "block").cogroup(copies.groupBy("part", "block")).applyInArrow(solve, schema)

    own = F.when(F.col("start").isNull(), F.array(hashed.cast("long"))).otherwise(F.sequence(F.col("start").cast("long"), (F.col("start") + F.col("parts") - 1).cast("long")))
    near = solved(asked.select("anchor", "id", "label", "vector", "block", F.explode(own).alias("part")), _positives(width, positives), "anchor long, id long, score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    chosen = keep(near.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= positives).drop("r"), "positives")

    targets = chosen.groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("targets"))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")
    asks = asked.join(targets, "anchor").select("anchor", "label", "vector", "targets", "block", everywhere)
    far = solved(asks, _negatives(width, negatives, share), "anchor long, target long, id long, score long")
    of_target = Window.partitionBy("anchor", "target").orderBy(F.desc("score"), "id")
    hard = far.withColumn("rank", F.row_number().over(of_target)).filter(F.col("rank") <= negatives)
    pairs = chosen.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("target"))
    named = asked.select("anchor", F.col("id").alias("anchor_id"))
    return hard.join(pairs, ["anchor", "target"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("target").alias("positive_score"), F.col("score").alias("negative_score"),
    )

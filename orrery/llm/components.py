"""Connected components and leaf splitting, shared by the near-duplicate operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from orrery.llm.common import keep

#: Hot shards that may be broadcast; more are joined.
BROADCAST_SHARDS = 100_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b): root is its component's smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until nothing changes.
    A step is a grouped minimum, combined on the map side, and a join, so no list of
    neighbours is ever gathered. Each round is written to the shared scratch folder.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    pairs, before = keep(pairs, "edges"), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if state[0] == 0 or state == before:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = state
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(pairs.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = keep(large, "large-star")
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        pairs = keep(small.union(lowest.select("hi", "m")).distinct(), "small-star")


def split_shards(rows: DataFrame, shard: list[str], cap: int) -> DataFrame:
    """Deal shards of over ``cap`` rows to cells: adds columns x, y (the cell) and part.

    A large shard's rows get a part at random; the row of part s goes to the cells of s and
    each other part. In cell (x, x) all pairs are compared, in cell (x, y) those of a row of x
    and a row of y, so every pair of the shard meets once and no cell holds over about
    2 * ``cap`` rows.
    """
    sizes = rows.groupBy(*shard).agg(F.count("*").alias("n")).filter(F.col("n") > cap)
    sizes = keep(sizes.select(*shard, F.ceil(F.col("n") / cap).cast("int").alias("parts")), "hot-shards")
    hot = sizes.count()
    if not hot:
        return rows.withColumns({"x": F.lit(0), "y": F.lit(0), "part": F.lit(0)})
    sizes = F.broadcast(sizes) if hot <= BROADCAST_SHARDS else sizes
    dealt = rows.join(sizes, shard, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(*[c for c in rows.columns if c not in shard]), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.withColumn("x", F.least("part", "other")).withColumn("y", F.greatest("part", "other")).drop("parts", "other")


class Forest:
    """Union by relabelling, for the few linked rows of one leaf."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, one: int, many: np.ndarray) -> None:
        mine = self.label[one]
        others = np.unique(self.label[many])
        others = others[others != mine]
        if len(others):
            low = min(int(others[0]), int(mine))
            self.label[np.isin(self.label, np.append(others, mine))] = low

"""Near copies by exact Jaccard similarity of word shingles: SimHash, then prefix filtering.

A document is the set of its shingles of ``SHINGLE`` words (ASCII letters lower-cased; a
shorter text is one shingle). Equal sets are one node. SimHash comes first: sets whose
fingerprints differ in at most ``RADIUS`` bits, found by the vantage-point trees of
``simhash``, are compared, and components of those that are similar are contracted.

Fingerprints of similar sets may lie farther apart, so the rest is found exactly. Sets are laid
out in one order over all shingles. Two sets whose similarity reaches the threshold t share a
shingle among the first n - ceil(t * n) + 1 of each, whatever that order is, so these prefixes
find every pair. Frequent shingles come last in the order. It is set up twice: first with what
is told to be frequent (shingles of low hashes are counted in all texts, others in a bounded
sample), then, for the sets that still share a shingle of their prefixes with another, by the
exact number of these sets that have a shingle. Shingles that no other set has then come first,
so a set with too many of its own is in no list, and the places of others tell how much two can share.

Nodes that share a shingle of their prefixes are a list, and the one with the smallest share of
shingles of its own leads it. In each of ``TURNS`` turns a node is compared with the leaders it
shares most lists with, from the second on also with its neighbours in lists that are shuffled
by a hash, and only where places allow the threshold. Components are contracted after each turn;
so a group of m near copies costs some m comparisons and not its pairs. What is left are pairs of
a list whose nodes lie in different components; those of fitting sizes and places are all
compared. Each comparison is on whole sets.

For a comparison, the texts of a leader's partners travel to cells of at most ``CELL_TEXTS``,
once each, and the leader's text once to every cell.

Null texts are empty; documents without words are one node; repeated rows are copies; very long
texts are shingled whole; an empty table gives no rows; columns of ``docs`` may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from orrery.llm.common import OUT_ROWS, col, each_batch, free_name, keep, quoted
from orrery.llm.components import components
from orrery.llm.simhash import majority, near_pairs
from orrery.llm.tokens import chunks
from orrery.runtime import fits_broadcast, scratch_path

SHINGLE = 5
#: Similarity from which documents are near copies, as a fraction of whole numbers.
SIMILAR = (4, 5)
SEED = 42
#: Bits in which the fingerprints of candidates may differ; blocks of a quarter then differ in one at most.
RADIUS = 7
#: Shingles of hashes below this are counted in all texts.
LOW = 1 << 62
#: Documents that tell which others are frequent, in how many texts a frequent one is, and how many are noted at most.
ORDER_SAMPLE = 20_000
FREQUENT = 4
MOST_FREQUENT = 1 << 20
#: Turns in which nodes are compared with leaders and neighbours, and with how many of either a node is in one.
TURNS = 2
NEIGHBOURS = 4
#: Texts that a cell compares with one.
CELL_TEXTS = 500


class Scratch:
    """Intermediates that are removed once what follows from them is written."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, name))
        df.write.option("compression", "zstd").parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def clear(self) -> None:
        for name in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths = []


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words)) - 1
    hashes = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[: len(starts) - k].tolist(), ends[k:].tolist())]
    return np.unique(np.array(hashes, np.uint64))


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """(k1, k2, text): two hashes stand for a text."""
    given = F.coalesce(col(text), F.lit(""))
    return docs.select(F.xxhash64(given).alias("k1"), F.xxhash64(given, F.lit(SEED)).alias("k2"), given.alias("text"))


def frequent_shingles(texts: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, ascending, and the number of texts that each is part of.

    Hashes below ``LOW`` are counted in all texts, others in about ``sample`` texts whose hash
    lies below a threshold, and scaled up. Of many, the ``MOST_FREQUENT`` most frequent are told.
    """
    span = 1 << 32
    share = min(1.0, sample / max(1, texts.count()))
    drawn = F.pmod(F.xxhash64("k1", F.lit(SEED)), F.lit(span)) < F.lit(int(share * span))

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in chunks(batch, "text"):
            sets = [shingles(t.as_py()) for t in part["text"]]
            taken = [s if d.as_py() else s[: np.searchsorted(s, np.uint64(LOW))] for s, d in zip(sets, part["drawn"])]
            tokens, n = np.unique(np.concatenate(taken), return_counts=True)
            for at in range(0, len(tokens), OUT_ROWS):
                some = slice(at, at + OUT_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(tokens[some].view(np.int64)), pa.array(n[some])], names=["token", "n"])

    met = texts.select("text", drawn.alias("drawn")).mapInArrow(each_batch(each), "token long, n long")
    counts = met.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
    scale = F.when(F.col("token").between(0, LOW - 1), F.lit(1.0)).otherwise(F.lit(1 / share if share else 1.0))
    counts = keep(counts.select("token", F.round(F.col("n") * scale).cast("long").alias("n")), "frequent-shingles")
    sizes = counts.groupBy("n").agg(F.count("*").alias("tokens")).orderBy(F.desc("n")).limit(MOST_FREQUENT)
    least, room = FREQUENT, MOST_FREQUENT
    for row in sizes.toLocalIterator():
        room -= row["tokens"]
        if room < 0:
            least = row["n"] + 1
            break
    table = counts.filter(F.col("n") >= least).toArrow()
    tokens, n = table["token"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], n[order]


def prefix(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first tokens of a set in the order of (sampled count, token), as many as must be looked at."""
    if not len(tokens):
        return tokens
    weight = np.zeros(len(tokens), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        weight = np.where(frequent[at] == tokens, counts[at], 0)
    length = len(tokens) - -(-SIMILAR[0] * len(tokens) // SIMILAR[1]) + 1
    return tokens[np.argsort(weight, kind="stable")[:length]]


def _prefixes(texts: DataFrame, frequent: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(k1, k2, node, n, fp, prefix) of every row: n distinct shingles, the set's hash and its SimHash."""
    shared = texts.sparkSession.sparkContext.broadcast((frequent, counts))

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for part in chunks(batch, "text"):
            sets = [shingles(t.as_py()) for t in part["text"]]
            nodes = np.array([xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            prints = np.array([majority(s) for s in sets], np.uint64).view(np.int64)
            firsts = [prefix(s, *shared.value).view(np.int64) for s in sets]
            ends = np.cumsum([0, *map(len, firsts)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(firsts)))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([part["k1"], part["k2"], pa.array(nodes), sizes, pa.array(prints), lists], names=["k1", "k2", "node", "n", "fp", "prefix"])

    return texts.mapInArrow(each_batch(each), "k1 long, k2 long, node long, n long, fp long, prefix array<long>")


def _postings(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(node, n, token) of every shingle of the texts, which have n each."""
    for part in chunks(batch, "text"):
        sets = [shingles(t.as_py()) for t in part["text"]]
        sizes = np.array([len(s) for s in sets], np.int64)
        node, n, token = np.repeat(part["node"].to_numpy(), sizes), np.repeat(sizes, sizes), np.concatenate(sets).view(np.int64)
        for at in range(0, len(token), OUT_ROWS):
            some = slice(at, at + OUT_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(n[some], pa.int32()), pa.array(token[some])], names=["node", "n", "token"])


def _shared(postings: DataFrame) -> DataFrame:
    """The postings whose token several nodes have, with their number: counts are combined before they travel."""
    counts = postings.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1")
    return postings.join(counts, "token")


def _exact_lists(nodes: DataFrame, rows: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(token, node, n, pos, alone): lists of prefixes in the order of the exact number of ``nodes`` that have a token.

    Tokens that no other node has come first and are in no list; there are ``alone`` of them.
    """
    told = _texts_of(nodes, rows, texts, scratch)
    postings = scratch.keep(told.mapInArrow(each_batch(_postings), "node long, n int, token long"), "postings")
    own = Window.partitionBy("node")
    alone, place = F.col("n") - F.count("*").over(own), F.row_number().over(own.orderBy("size", "token"))
    placed = _shared(postings).select("token", "node", "n", (alone + place - 1).cast("int").alias("pos"), alone.cast("int").alias("alone"))
    top, whole = SIMILAR
    firsts = scratch.keep(placed.filter((F.col("n") - F.col("pos")) * whole >= F.col("n") * top), "exact-prefixes")
    return _shared(firsts).drop("size")


def _near_prints(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): nodes whose fingerprints are equal or linked through the trees; the first node of a fingerprint stands for it."""
    nodes = rows.select("fp", "node").distinct()
    firsts = scratch.keep(nodes.groupBy("fp").agg(F.min("node").alias("first")), "first-nodes")
    some = F.broadcast(firsts) if fits_broadcast(firsts) else firsts
    same = nodes.join(some, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    # The second of a pair is the one that its leaf's forest hangs on: it leads.
    near = near_pairs(firsts.select("fp"), RADIUS).distinct()
    near = near.join(some.withColumnsRenamed({"fp": "b", "first": "lead"}), "b").join(some.withColumnsRenamed({"fp": "a", "first": "node"}), "a")
    return same.union(near.select("lead", "node")).filter("a <> b").distinct()


def _texts_of(nodes: DataFrame, rows: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, text) of the given nodes; copies of a text give the same set, so any will do."""
    keys = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("k")).select("node", "k.k1", "k.k2")
    keys = scratch.keep(keys, "asked-nodes")
    some = F.broadcast(keys) if fits_broadcast(keys) else keys
    return scratch.keep(texts.join(some, ["k1", "k2"]).select("node", "text").dropDuplicates(["node"]), "asked-texts")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cells, each cell led by its leader's text: the pairs that reach the threshold."""
    cell = x = None
    for batch in batches:
        found = []
        for a, part, leads, node, text in zip(*[batch[c].to_pylist() for c in ("a", "part", "leads", "node", "text")]):
            if (a, part) != cell:
                if not leads:
                    raise ValueError("a cell without its leader")
                cell, x = (a, part), shingles(text)
                continue
            y = shingles(text)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both):
                found.append((a, node))
        for at in range(0, len(found), OUT_ROWS):
            one, other = zip(*found[at : at + OUT_ROWS])
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(other, pa.int64())], names=["a", "b"])


def _alike(pairs: DataFrame, rows: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The distinct pairs (a, b) of nodes whose whole sets reach the threshold."""
    told = _texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), rows, texts, scratch)
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / CELL_TEXTS).cast("int").alias("parts"))
    few = F.broadcast(sizes) if fits_broadcast(sizes) else sizes
    dealt = pairs.join(few, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("node"))
    leaders = dealt.select("a", "part").distinct().select("a", "part", F.lit(True).alias("leads"), F.col("a").alias("node"))
    cells = leaders.union(dealt.select("a", "part", F.lit(False), "node")).join(told, "node")
    # A leader sorts before its partners.
    ordered = cells.repartition("a", "part").sortWithinPartitions("a", "part", F.desc("leads")).select("a", "part", "leads", "node", "text")
    return keep(ordered.mapInArrow(_compared, "a long, b long"), "similar-pairs")


def _with_components(lists: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``lists`` with the component of each node, without lists that lie in one component.

    ``main`` is the node of a list with the smallest share of shingles of its own; it comes with its component, size and place.
    """
    roots = components(links)
    some = F.broadcast(roots) if fits_broadcast(roots) else roots
    named = lists.join(some, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    named = scratch.keep(named, "list-components")
    first = F.min(F.struct(F.col("alone") / F.col("n"), "node", "comp", "n", "pos")).alias("first")
    mixed = named.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), first).filter("x <> y")
    told = [F.col("first.node").alias("main"), *[F.col(f"first.{c}").alias(f"main_{c}") for c in ("comp", "n", "pos")]]
    return scratch.keep(named.join(mixed.select("token", *told), "token"), "mixed-lists")


def _may_link(n, pos, m, at):
    """Whether sets of n and m shingles that share the one at these places, and none before, may reach the threshold.

    They need 4 of 9 of n + m in common, and share no more than what lies from there on in either.
    """
    top, whole = SIMILAR
    fits = F.least(n, m) * whole >= F.greatest(n, m) * top
    return fits & (F.least(n - pos, m - at) * (top + whole) >= (n + m) * top)


def _best(pairs: DataFrame, asked: DataFrame) -> DataFrame:
    """Of (a, b, by, n) that were not asked, for each node ``by`` the ``NEIGHBOURS`` that share most lists with it."""
    pairs = pairs.join(asked, ["a", "b"], "left_anti")
    place = F.row_number().over(Window.partitionBy("by").orderBy(F.desc("n"), "a", "b"))
    return pairs.withColumn("place", place).filter(F.col("place") <= NEIGHBOURS).select("a", "b")


def _leaders(mixed: DataFrame, asked: DataFrame) -> DataFrame:
    """(a, b): each node and leaders of other components that it shares most lists with and may be like."""
    may = _may_link(F.col("n"), F.col("pos"), F.col("main_n"), F.col("main_pos"))
    pair = (F.least("main", "node").alias("a"), F.greatest("main", "node").alias("b"), F.col("node").alias("by"))
    return _best(mixed.filter((F.col("comp") != F.col("main_comp")) & may).groupBy(*pair).agg(F.count("*").alias("n")), asked)


def _neighbours(mixed: DataFrame, asked: DataFrame, turn: int) -> DataFrame:
    """(a, b): nodes of different components that stand next to each other in a list ordered by a hash of this turn."""
    order = Window.partitionBy("token").orderBy(F.xxhash64("node", F.lit(turn)), "node")
    beside = mixed.select("node", "comp", "n", "pos", *[F.lag(c).over(order).alias(f"other_{c}") for c in ("node", "comp", "n", "pos")])
    may = _may_link(F.col("n"), F.col("pos"), F.col("other_n"), F.col("other_pos"))
    pair = (F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b"))
    pairs = beside.filter((F.col("comp") != F.col("other_comp")) & may).groupBy(*pair).agg(F.count("*").alias("n"))
    return _best(pairs.withColumn("by", F.col("b")), asked)


def _candidates(one: DataFrame, many: DataFrame) -> DataFrame:
    """Pairs (a, b) of a row of each side that may reach the threshold by a token that they share, in different components."""
    x, y = one.alias("x"), many.alias("y")
    # Later tokens that a pair shares need not be met: the first is early enough in both.
    may = _may_link(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"))
    # A token that two nodes share is met once, also where both are on the first side.
    once = (F.col("y.comp") == F.col("y.main_comp")) | (F.col("x.node") < F.col("y.node"))
    joined = x.join(y, F.col("x.token") == F.col("y.token")).filter((F.col("x.comp") != F.col("y.comp")) & may & once)
    return joined.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def near_copy_groups(docs: DataFrame, text: str = "text", sample: int = ORDER_SAMPLE) -> DataFrame:
    """(k1, k2, group) of the texts that share a group with another text; k1 and k2 are hashes of the text."""
    spark = docs.sparkSession
    texts = _keyed(docs, text)
    whole, turns = Scratch(spark), Scratch(spark)
    rows = whole.keep(_prefixes(texts, *frequent_shingles(texts, sample)), "shingle-prefixes")
    nodes = rows.select("node", "prefix").dropDuplicates(["node"])
    postings = nodes.select("node", F.explode("prefix").alias("token"))
    # One shuffle finds the shingles that several nodes share.
    size = F.count("*").over(Window.partitionBy("token"))
    some = turns.keep(postings.withColumn("size", size).filter("size > 1").select("node").distinct(), "listed-nodes")
    lists = whole.keep(_exact_lists(some, rows, texts, turns), "prefix-lists")
    turns.clear()

    pairs = turns.keep(_near_prints(rows, turns), "near-prints")
    asked = whole.keep(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "asked-pairs")
    links = _alike(pairs, rows, texts, turns)
    turns.clear()
    for turn in range(TURNS + 1):
        mixed = _with_components(lists, links, turns)
        if turn < TURNS:
            pairs = _leaders(mixed, asked)
            pairs = turns.keep(pairs.union(_neighbours(mixed, asked, turn)).distinct() if turn else pairs, "asked-now")
            asked = asked.union(whole.keep(pairs, "asked-pairs"))
        else:
            pairs = turns.keep(_candidates(mixed.filter("comp <> main_comp"), mixed), "candidate-pairs")
        links = links.union(_alike(pairs, rows, texts, turns))
        turns.clear()
    roots = components(links)
    varied = rows.groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("x"), F.max(F.struct("k1", "k2")).alias("y")).filter("x <> y").select("node")
    members = varied.union(roots.select("node")).union(roots.select("root")).distinct().join(roots, "node", "left")
    named = rows.select("k1", "k2", "node").distinct().join(members, "node")
    groups = keep(named.select("k1", "k2", F.coalesce("root", "node").alias("group")), "near-copy-groups")
    whole.clear()
    return groups


def near_copies_removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, one of each group: the first by id (null ids last), then by text.

    Only keys are grouped. Rows that go, and equal keys of which one row stays, are joined back
    to the documents, by broadcast where they measure small.
    """
    groups = near_copy_groups(docs, text)
    given = F.coalesce(col(text), F.lit(""))
    hashes = {"k1": F.xxhash64(given), "k2": F.xxhash64(given, F.lit(SEED))}
    light = docs.select(col(doc_id).alias("id"), *[h.alias(n) for n, h in hashes.items()])
    light = keep(light.groupBy("id", "k1", "k2").agg(F.count("*").alias("n")), "near-copy-keys")
    some = F.broadcast(groups) if fits_broadcast(groups) else groups
    named = light.join(some, ["k1", "k2"], "left")
    # A text that shares no group with another text is a group by itself.
    keys = {"g1": F.coalesce("group", "k1"), "g2": F.when(F.col("group").isNull(), F.col("k2")).otherwise(F.lit(0))}
    named = named.withColumns({**keys, "own": F.col("group").isNull()})
    order = F.struct(F.col("id").isNull().alias("absent"), "id")
    first = named.groupBy("own", "g1", "g2").agg(F.min(order).alias("first"), F.sum("n").alias("rows")).filter("rows > 1").drop("rows")
    few = F.broadcast(first) if fits_broadcast(first) else first
    met = named.join(few, ["own", "g1", "g2"])
    # Rows of the first id stay for now: several only if the id repeats in the group.
    marked = met.select("id", "k1", "k2", "own", "g1", "g2", "n", order.eqNullSafe(F.col("first")).alias("stays"))
    marked = keep(marked, "near-copy-marks")
    again = marked.filter("stays").groupBy("own", "g1", "g2").agg(F.sum("n").alias("rows")).filter("rows > 1").select("own", "g1", "g2")
    unclear = marked.filter("stays").join(again, ["own", "g1", "g2"]).select("id", "k1", "k2", "own", "g1", "g2", F.lit(True).alias("unclear"))
    gone = marked.filter("not stays").select("id", "k1", "k2", "own", "g1", "g2", F.lit(False).alias("unclear"))
    marks = keep(gone.union(unclear), "near-copy-marks")
    names = {n: free_name(docs, n) for n in ("k1", "k2", "id", "own", "g1", "g2", "unclear", "place")}
    marks = marks.withColumnsRenamed(names)
    small = F.broadcast(marks) if fits_broadcast(marks) else marks
    keyed = docs.withColumns({names[n]: h for n, h in hashes.items()})
    same = [keyed[quoted(names[n])] == small[quoted(names[n])] for n in ("k1", "k2")]
    joined = keyed.join(small, [*same, keyed[quoted(doc_id)].eqNullSafe(small[quoted(names["id"])])], "left")
    columns = [keyed[quoted(c)] for c in docs.columns]
    flagged = joined.select(*columns, *[small[quoted(names[n])] for n in ("own", "g1", "g2", "unclear")])
    clear = flagged.filter(col(names["unclear"]).isNull())
    place = F.row_number().over(Window.partitionBy(*[col(names[n]) for n in ("own", "g1", "g2")]).orderBy(col(text)))
    one = flagged.filter(col(names["unclear"])).withColumn(names["place"], place).filter(col(names["place"]) == 1)
    kept = [col(c) for c in docs.columns]
    return clear.select(*kept).union(one.select(*kept))

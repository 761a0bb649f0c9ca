"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Windows of ``window`` consecutive item words are the patterns (an item of fewer words is one
pattern). A block is two neighbouring words. For each pattern length a shift table tells from
the block that ends at a word how far the next possible end of a pattern is, so most words
are never looked at. Where the shift is zero, the block's hash names a bucket of patterns,
the window's hash picks some of it, and their words are compared byte by byte.

A map task searches the whole texts of its rows; nothing is shuffled. Long items are cut to
overlapping pieces, pieces are dealt to shards of about ``SHARD_BYTES``, and each shard is
broadcast and searched for by a pass of its own that adds to what the passes before have
found: memory is bounded for any benchmark and any number of items that share a window.

Null and wordless texts have no words and no hits; items without words have no pattern;
items without an id hit words but are not named; items that share an id are one name; equal
documents are rows of their own; an empty table gives no rows, an empty benchmark no hits. A
very long text is searched as a whole. Columns of ``docs`` named like an output give way.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from orrery.llm.common import arrow_schema, col, each_batch, keep, per_worker
from orrery.llm.substrings import mixed, slice_hashes
from orrery.llm.tokens import chunks

WINDOW = 10
BLOCK = 2
#: Bytes of item text that one broadcast holds, and words of an item that one piece starts windows at.
SHARD_BYTES = 8 << 20
PIECE_WORDS = 10_000
#: Passes whose tables a task holds at once; results are written after so many.
PASSES = 4
#: Pattern ends that one lane of the search is responsible for.
LANE_WORDS = 1024
#: Words that are compared at once.
COMPARED_WORDS = 1 << 17
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATORS = "[\\x00-/:-`{-\\x7f]+"


def _letters() -> np.ndarray:
    """Byte to lower-case byte; 0 where a byte belongs to no word."""
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


class Words:
    """The words of some texts laid end to end: lowered bytes, bounds, hashes, and the text of each."""

    def __init__(self, texts: pa.Array):
        plain = pc.fill_null(texts, "").cast(pa.large_binary())
        ends = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
        raw = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(plain) else np.zeros(0, np.uint8)
        self.edges = ends - ends[0]
        self.data = _letters()[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = self.data != 0
        # A word ends with its text, even if the next one starts with a letter.
        cut = np.zeros(len(raw) + 1, bool)
        cut[self.edges] = True
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        self.hashes = slice_hashes(self.data, self.starts, self.ends) if len(self.starts) else np.zeros(0, np.uint64)
        #: Words before each text.
        self.first = np.searchsorted(self.starts, self.edges, side="left")
        self.text = np.repeat(np.arange(len(plain)), np.diff(self.first))

    def blocks(self, ends: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the ``size`` (1 or 2) words up to each of ``ends``."""
        return mixed(self.hashes[ends] + _STEP * self.hashes[ends - 1]) if size == 2 else self.hashes[ends]

    def windows(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Hashes of ``length`` words from each of ``starts``."""
        out = np.zeros(len(starts), np.uint64)
        for i in range(length):
            out = out * _STEP + self.hashes[starts + i]
        return mixed(out)


def same_words(a: Words, at: np.ndarray, b: Words, to: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` words of ``a`` from each of ``at`` are those of ``b`` from ``to``, byte by byte."""
    step = max(1, COMPARED_WORDS // length)
    parts = [_same(a, at[i : i + step], b, to[i : i + step], length) for i in range(0, len(at), step)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _same(a: Words, at: np.ndarray, b: Words, to: np.ndarray, length: int) -> np.ndarray:
    place = np.arange(length)
    left, right = at[:, None] + place, to[:, None] + place
    sizes = a.ends[left] - a.starts[left]
    same = (sizes == b.ends[right] - b.starts[right]).all(axis=1)
    some = np.flatnonzero(same)
    lengths = sizes[some].ravel()
    if not len(lengths):
        return same
    total = np.cumsum(lengths)
    inner = np.arange(total[-1]) - np.repeat(total - lengths, lengths)
    equal = a.data[np.repeat(a.starts[left[some]].ravel(), lengths) + inner] == b.data[np.repeat(b.starts[right[some]].ravel(), lengths) + inner]
    per_window = np.add.reduceat(~equal, (total - lengths)[::length])
    same[some] = per_window == 0
    return same


class Patterns:
    """Shift table and buckets of the distinct patterns of one length."""

    def __init__(self, words: Words, starts: np.ndarray, length: int):
        self.words, self.length, self.block = words, length, min(BLOCK, length)
        hashes = words.windows(starts, length)
        order = np.argsort(hashes, kind="stable")
        starts, hashes = starts[order], hashes[order]
        fresh = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        # Equal hashes are one pattern only if their words are equal; any others stand alone.
        lead = np.maximum.accumulate(np.where(fresh, np.arange(len(starts)), 0))
        again = np.flatnonzero(~fresh)
        fresh[again] = ~same_words(words, starts[again], words, starts[lead[again]], length)
        group = np.cumsum(fresh) - 1
        self.starts = starts[fresh]
        texts = words.text[starts]
        pairs = np.unique(np.stack([group, texts], axis=1), axis=0)
        self.texts, self.text_ends = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.starts) + 1))

        top = length - self.block
        self.bits = int(np.clip(np.ceil(np.log2(8 * len(self.starts) * (top + 1))), 12, 24))
        self.shift = np.full(1 << self.bits, top + 1, np.uint8)
        for back in range(top, -1, -1):  # the nearest end is written last
            self.shift[self._cell(words.blocks(self.starts + length - 1 - back, self.block))] = back
        keys = self._key(words, self.starts)
        order = np.argsort(keys, kind="stable")
        self.keys, self.order = keys[order], order

    def _cell(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - self.bits)).astype(np.int64)

    def _key(self, words: Words, starts: np.ndarray) -> np.ndarray:
        """Bucket of the last block, then the hash of the whole window."""
        bucket = words.blocks(starts + self.length - 1, self.block) >> np.uint64(64 - self.bits)
        return (bucket << np.uint64(40)) | (words.windows(starts, self.length) >> np.uint64(24))

    def candidates(self, words: Words) -> np.ndarray:
        """Window starts whose last block has shift zero; each lane jumps by the shifts it meets."""
        n = len(words.hashes)
        lanes = np.arange(0, n, LANE_WORDS)
        stop = np.minimum(lanes + LANE_WORDS, n)
        at = np.maximum(lanes, self.length - 1)
        found = []
        while True:
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
            if not len(at):
                break
            jump = self.shift[self._cell(words.blocks(at, self.block))]
            found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
        starts = np.concatenate(found) - (self.length - 1) if found else np.zeros(0, np.int64)
        # A window lies in one text.
        return starts[words.text[starts] == words.text[starts + self.length - 1]]

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(window start, pattern) of every occurrence, after comparing the words themselves."""
        starts = self.candidates(words)
        keys = self._key(words, starts)
        low = np.searchsorted(self.keys, keys, side="left")
        many = np.searchsorted(self.keys, keys, side="right") - low
        starts = np.repeat(starts, many)
        place = np.repeat(low, many) + np.arange(len(starts)) - np.repeat(np.cumsum(many) - many, many)
        pattern = self.order[place]
        true = same_words(words, starts, self.words, self.starts[pattern], self.length)
        return starts[true], pattern[true]


class Tables:
    """Patterns of a shard by length, and the names of its items in order."""

    def __init__(self, pieces: list[tuple[str | None, str]], window: int):
        names = sorted({name for name, _ in pieces if name is not None}, key=lambda s: s.encode())
        number = {name: i for i, name in enumerate(names)}
        self.names = np.array(names, object)
        self.name_of_text = np.array([number.get(name, -1) for name, _ in pieces], np.int64)
        words = Words(pa.array([text for _, text in pieces], pa.string()))
        sizes = np.diff(words.first)
        self.patterns = []
        for length in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
            if length == window:
                counts = np.maximum(sizes - window + 1, 0)
                at = np.repeat(words.first[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            else:
                at = words.first[:-1][sizes == length]
            self.patterns.append(Patterns(words, at, length))


def _search(tables: Tables, texts: pa.Array, spans: pa.Array | None, named: pa.Array | None) -> list[pa.Array]:
    """n_words, n_hit, spans, items of each text; ``spans`` and ``named`` are those of earlier passes."""
    words = Words(texts)
    n = len(words.starts)
    edge = np.zeros(n + 1, np.int64)
    if spans is not None:
        flat, counts = spans.flatten(), pc.list_value_length(spans).to_numpy(zero_copy_only=False).astype(np.int64)
        base = np.repeat(words.first[:-1], counts)
        np.add.at(edge, base + flat.field("first").to_numpy(), 1)
        np.add.at(edge, base + flat.field("last").to_numpy() + 1, -1)
    pairs = []
    for patterns in tables.patterns:
        at, pattern = patterns.occurrences(words)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + patterns.length, -1)
        both = np.unique(np.stack([words.text[at], pattern], axis=1), axis=0)
        pairs.append((both, patterns))
    hit = np.cumsum(edge)[:-1] > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[words.first[1:]] - total[words.first[:-1]]

    opening = hit.copy()
    closing = hit.copy()
    if n:
        same = words.text[1:] == words.text[:-1]
        opening[1:] &= ~(hit[:-1] & same)
        closing[:-1] &= ~(hit[1:] & same)
    begin, end = np.flatnonzero(opening), np.flatnonzero(closing)
    base = words.first[words.text[begin]]
    merged = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], names=["first", "last"])
    bounds = np.searchsorted(begin, words.first).astype(np.int32)

    names: list[list[str]] = named.to_pylist() if named is not None else [[] for _ in range(len(texts))]
    found: dict[int, list[np.ndarray]] = {}
    for both, patterns in pairs:
        cuts = np.flatnonzero(np.diff(both[:, 0], prepend=-1))
        for low, high in zip(cuts, [*cuts[1:], len(both)]):
            items = [patterns.texts[patterns.text_ends[p] : patterns.text_ends[p + 1]] for p in both[low:high, 1]]
            found.setdefault(int(both[low, 0]), []).append(np.unique(tables.name_of_text[np.concatenate(items)]))
    for text, parts in found.items():
        ranks = np.unique(np.concatenate(parts))
        fresh = tables.names[ranks[ranks >= 0]].tolist()
        names[text] = sorted({*names[text], *fresh}, key=lambda s: s.encode()) if names[text] else fresh
    return [
        pa.array(np.diff(words.first).astype(np.int64)), pa.array(n_hit.astype(np.int64)),
        pa.ListArray.from_arrays(pa.array(bounds), merged), pa.array(names, pa.list_(pa.string())),
    ]


def _tables(slot: int, token: str, build) -> Tables:
    """The tables of one broadcast; a worker holds those of ``PASSES`` broadcasts at most."""
    held = per_worker("benchmark tables", dict)
    if held.get(slot, ("", None))[0] != token:
        held[slot] = (token, build())
    return held[slot][1]


def item_pieces(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, piece): lowered words of each item, in pieces that share ``window`` - 1 words with the next."""
    words = F.array_remove(F.split(F.translate(F.coalesce(col(text), F.lit("")), UPPER, LOWER), _SEPARATORS), "")
    rows = benchmark.select(col(item_id).cast("string").alias("item"), words.alias("words")).filter(F.size("words") > 0)
    at = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(PIECE_WORDS))
    cut = rows.select("item", "words", F.explode(at).alias("at"))
    return cut.select("item", F.array_join(F.expr(f"slice(words, at + 1, {PIECE_WORDS + window - 1})"), " ").alias("piece"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", keep_text: bool = True,
) -> DataFrame:
    """``docs`` with n_words, n_hit, spans, items and contaminated.

    A word is hit if it lies inside an occurrence of a window of any item. ``spans`` are the
    first and last word of each stretch of hit words, ``items`` the sorted ids of all items
    with an occurring window. ``keep_text=False`` leaves the text column out.
    """
    if not 1 <= window <= 200:
        raise ValueError("a window has 1 to 200 words")
    spark = docs.sparkSession
    pieces = item_pieces(benchmark, item_id, item_text, window)
    size = pieces.agg(F.sum(F.octet_length("piece").cast("long"))).first()[0] or 0
    shards = max(1, -(-int(size) // SHARD_BYTES))
    if shards > 1:
        pieces = keep(pieces.withColumn("shard", F.pmod(F.xxhash64("item", "piece"), F.lit(shards))), "benchmark-pieces")

    added = ["n_words", "n_hit", "spans", "items"]
    others = [c for c in docs.columns if c.lower() not in {*added, "contaminated"} or c == text]
    out = docs.select(*[col(c) for c in others])
    hits = "n_words long, n_hit long, spans array<struct<first: long, last: long>>, items array<string>"
    source = text
    if text in added:
        raise ValueError(f"the text column may not be called {text}")
    for shard in range(shards):
        some = pieces.filter(F.col("shard") == shard) if shards > 1 else pieces
        shared = spark.sparkContext.broadcast([(r["item"], r["piece"]) for r in some.collect()])
        last = shard == shards - 1
        kept = [c for c in others if keep_text or c != text or not last]
        schema = out.select(*[col(c) for c in kept]).schema
        for field in spark.createDataFrame([], hits).schema:
            schema = schema.add(field)
        shape = arrow_schema(schema)

        def run(batch: pa.RecordBatch, shared=shared, kept=tuple(kept), shape=shape, first=shard == 0, slot=shard % PASSES, token=uuid.uuid4().hex):
            tables = _tables(slot, token, lambda: Tables(shared.value, window))
            for part in chunks(batch, source):
                old = (None, None) if first else (part["spans"], part["items"])
                columns = [part[c] for c in kept] + _search(tables, part[source], *old)
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, shape)], schema=shape)

        out = out.mapInArrow(each_batch(run), schema)
        if not last and shard % PASSES == PASSES - 1:
            out = keep(out, "decontaminated")
    return out.withColumn("contaminated", F.col("n_hit") > 0)

"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least hash of the ``MINIMISER``
word sequences in it; consecutive windows with one minimiser travel together, as one packed
string, to the bucket of that minimiser. Equal windows have equal minimisers, so each bucket
counts its windows alone: it sorts their hashes and compares the words of those that meet.

Map tasks pack all strings of a bucket into compressed blocks and send equal strings once,
with the places they come from. A minimiser that a bounded sample of documents shows to be
frequent is not a bucket key: its windows travel one by one, by their own hash, so that a
passage of a third of all documents is spread. The sample only chooses the route. Buckets
are sized by the corpus, and each is worked through in parts of bounded size.

A row is known by (doc_id, hash of text), so rows that repeat an id stay apart and rows that
are equal altogether get equal results; null ids are allowed. Null and wordless texts have
no words; texts of fewer words than a window lose none. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orrery.llm.common import col, each_batch, keep, per_worker

WINDOW = 35
MINIMISER = 5
#: Bytes of packed strings that a bucket holds on average.
BUCKET_BYTES = 12 << 20
#: Bytes of text whose strings a map task packs together.
FLUSH_BYTES = 12 << 20
#: Documents that show which minimisers are frequent, and the share of all strings from which one is.
ROUTE_SAMPLE = 20_000
FREQUENT = 0.001

_BASE = 0x9E3779B97F4A7C15 | 1
_SPAN = 1 << 20  # bytes that are hashed at once


def _powers() -> np.ndarray:
    """_BASE to the powers 0, 1, ... _SPAN, modulo 2**64."""
    out = np.empty(_SPAN + 1, np.uint64)
    out[0] = 1
    np.multiply.accumulate(np.full(_SPAN, _BASE, np.uint64), out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each slice data[start:end], by its bytes alone; ``starts`` ascend, slices are short against _SPAN."""
    powers = per_worker("slice hash powers", _powers)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        origin = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, origin + _SPAN, side="right")))
        top = int(ends[at:stop].max()) - origin
        if top > _SPAN:  # one slice beyond the span
            out[at] = np.uint64(int.from_bytes(_digest(data[origin : origin + top].tobytes()), "little"))
            at += 1
            continue
        sums = np.zeros(top + 1, np.uint64)
        np.cumsum((data[origin : origin + top].astype(np.uint64) + np.uint64(1)) * powers[:top], out=sums[1:])
        a, b = starts[at:stop] - origin, ends[at:stop] - origin
        # Every slice is moved to the same power, so equal bytes give equal numbers.
        out[at:stop] = mixed((sums[b] - sums[a]) * powers[_SPAN - a] + (b - a).astype(np.uint64))
        at = stop
    return out


def _digest(data: bytes) -> bytes:
    import hashlib

    return hashlib.blake2b(data, digest_size=8).digest()


def word_bounds(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a line whose words are divided by single spaces."""
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    return np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(line)]])


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive hashes."""
    low, reach = hashes, 1
    while 2 * reach <= width:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def super_kmers(line: bytes, window: int = WINDOW, minimiser: int = MINIMISER) -> Iterator[tuple[int, int, int, int, int]]:
    """(minimiser hash, first word, windows, first byte, last byte + 1) of each run of windows."""
    starts, ends = word_bounds(line)
    if len(starts) < window:
        return
    data = np.frombuffer(line, np.uint8)
    hashes = slice_hashes(data, starts[: len(starts) - minimiser + 1], ends[minimiser - 1 :])
    minima = window_minima(hashes, window - minimiser + 1)
    cuts = np.concatenate([[0], np.flatnonzero(minima[1:] != minima[:-1]) + 1, [len(minima)]])
    first, size = cuts[:-1], np.diff(cuts)
    last_word = first + size + window - 2
    yield from zip(minima[first].tolist(), first.tolist(), size.tolist(), starts[first].tolist(), ends[last_word].tolist())


def words_line(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def _bucket(key: int, buckets: int) -> int:
    return (key >> 20) % buckets


def _packer(buckets: int, frequent: frozenset, window: int, minimiser: int):
    """Documents (doc_id, h, text) to blocks (bucket, data) of packed strings."""
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        piles: dict[int, dict[bytes, list]] = defaultdict(dict)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            numbers, blocks = [], []
            for bucket, strings in piles.items():
                numbers.append(bucket)
                blocks.append(squeeze.compress(pack_block(strings)))
                if sum(map(len, blocks)) > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "data"])
                    numbers, blocks = [], []
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "data"])
            piles.clear()

        def add(bucket: int, string: bytes, place: tuple) -> None:
            places = piles[bucket].get(string)
            if places is None:
                piles[bucket][string] = [place]
            else:
                places.append(place)

        for batch in batches:
            for doc, h, text in zip(batch["doc_id"].to_pylist(), batch["h"].to_pylist(), batch["text"]):
                line = words_line(text.as_py())
                bounds = None
                for key, word, size, a, b in super_kmers(line, window, minimiser):
                    if key not in frequent:
                        add(_bucket(key, buckets), line[a:b], (doc, h, word))
                        held += b - a
                        continue
                    if bounds is None:
                        bounds = word_bounds(line)
                        data = np.frombuffer(line, np.uint8)
                    s, e = bounds[0][word : word + size], bounds[1][word + window - 1 : word + window - 1 + size]
                    for i, own in enumerate(slice_hashes(data, s, e).tolist()):
                        add(_bucket(own, buckets), line[s[i] : e[i]], (doc, h, word + i))
                        held += 64
                if held > 3 * FLUSH_BYTES:
                    yield from flush()
                    held = 0
        yield from flush()

    return run


def pack_block(strings: dict[bytes, list]) -> bytes:
    """Strings, with the places (doc_id, text hash, first word) of each, as bytes."""
    places = [p for ps in strings.values() for p in ps]
    lengths = np.fromiter(map(len, strings), np.int32, len(strings))
    copies = np.fromiter(map(len, strings.values()), np.int32, len(strings))
    known = np.fromiter((p[0] is not None for p in places), np.uint8, len(places))
    ids = np.fromiter((p[0] or 0 for p in places), np.int64, len(places))
    hashes = np.fromiter((p[1] for p in places), np.int64, len(places))
    words = np.fromiter((p[2] for p in places), np.int64, len(places))
    head = np.array([len(strings), len(places)], np.int64)
    return b"".join([head.tobytes(), lengths.tobytes(), copies.tobytes(), known.tobytes(), ids.tobytes(), hashes.tobytes(), words.tobytes(), *strings])


def unpack_block(raw: bytes) -> tuple:
    """(string bytes, lengths, copies, known, ids, hashes, words) of a packed block."""
    n, m = np.frombuffer(raw, np.int64, 2)
    at = 16
    out = []
    for kind, size in ((np.int32, n), (np.int32, n), (np.uint8, m), (np.int64, m), (np.int64, m), (np.int64, m)):
        out.append(np.frombuffer(raw[at : at + size * kind().nbytes], kind))
        at += size * kind().nbytes
    return (raw[at:], *out)


def repeated_windows(data: bytes, lengths: np.ndarray, copies: np.ndarray, window: int = WINDOW) -> Iterator[tuple[int, int, int]]:
    """(string, first window, last window + 1) of each run of repeated windows.

    ``data`` holds the strings end to end; string i stands at ``copies[i]`` places.
    """
    array = np.frombuffer(data, np.uint8)
    # A string ends where the next begins; inside, spaces divide words.
    offsets = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    spaces = np.flatnonzero(array == 32)
    string_of_space = np.searchsorted(offsets, spaces, side="right") - 1
    word_starts = np.sort(np.concatenate([offsets[:-1], spaces + 1]))
    word_ends = np.sort(np.concatenate([offsets[1:], spaces]))
    n_words = np.bincount(string_of_space, minlength=len(lengths)) + 1
    n_windows = n_words - window + 1
    base = np.cumsum(n_words) - n_words
    owner = np.repeat(np.arange(len(lengths)), n_windows)
    index = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    first_word = base[owner] + index
    starts, ends = word_starts[first_word], word_ends[first_word + window - 1]
    hashes = slice_hashes(array, starts, ends)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    groups = np.cumsum(np.concatenate([[True], ~same])) - 1
    alike = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    flag = copies[owner] > 1
    # Equal hashes only point at candidates: the words decide.
    met = order[alike]
    seen: dict[tuple[int, bytes], int] = {}
    for at, group in zip(met.tolist(), groups[alike].tolist()):
        words = (group, data[starts[at] : ends[at]])
        before = seen.setdefault(words, at)
        if before != at:
            flag[before] = flag[at] = True
    marked = np.flatnonzero(flag)
    if not len(marked):
        return
    new = np.concatenate([[True], (np.diff(marked) > 1) | (np.diff(owner[marked]) > 0)])
    firsts = marked[new]
    lasts = marked[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(marked) - 1]])]
    yield from zip(owner[firsts].tolist(), index[firsts].tolist(), (index[lasts] + 1).tolist())


def merged_ranges(at: np.ndarray, known: np.ndarray, ids: np.ndarray, hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Table:
    """One row (doc_id, h, starts, stops) for each row of documents, ranges that touch made one."""
    order = np.lexsort((start, hashes[at], ids[at], known[at]))
    at, start, stop = at[order], start[order], stop[order]
    row = np.stack([known[at].astype(np.int64), ids[at], hashes[at]])
    new_row = np.concatenate([[True], (row[:, 1:] != row[:, :-1]).any(axis=0)])[: len(at)]
    # The furthest stop so far in the row tells whether a range touches those before it.
    group = np.cumsum(new_row)
    width = int(stop.max()) + 1 if len(stop) else 1
    reach = np.maximum.accumulate(stop + group * width) - group * width
    new = new_row | np.concatenate([[True], start[1:] > reach[:-1]])[: len(at)]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]).astype(np.int64)[: len(first)] - 1
    rows = np.flatnonzero(new_row)
    offsets = pa.array(np.concatenate([np.searchsorted(first, rows), [len(first)]]).astype(np.int32))
    one = at[rows]
    return pa.table({
        "doc_id": pa.array(ids[one], mask=known[one] == 0), "h": pa.array(hashes[one]),
        "starts": pa.ListArray.from_arrays(offsets, pa.array(start[first])), "stops": pa.ListArray.from_arrays(offsets, pa.array(reach[last])),
    })


def _counter(window: int):
    """All blocks of a bucket to ranges (doc_id, h, starts, stops) of words to remove."""

    def run(group: pa.Table) -> pa.Table:
        import zstandard

        blocks = [unpack_block(zstandard.ZstdDecompressor().decompress(b.as_py())) for b in group["data"]]
        data = b"".join(b[0] for b in blocks)
        lengths, copies, known, ids, hashes, words = (np.concatenate([b[i] for b in blocks]) for i in range(1, 7))
        last = np.cumsum(copies)
        out: list[np.ndarray] = []
        for string, a, b in repeated_windows(data, lengths, copies, window):
            at = np.arange(last[string] - copies[string], last[string])
            out.append(np.stack([at, words[at] + a, words[at] + b + window - 1]))
        at, start, stop = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        return merged_ranges(at, known, ids, hashes, start, stop)

    return run


def _minimisers(window: int, minimiser: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = [k for text in batch["text"] for k, *_ in super_kmers(words_line(text.as_py()), window, minimiser)]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64))], names=["key"])

    return run


def repeated_ranges(rows: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """(doc_id, h, starts, stops): words of ``rows`` (doc_id, h, text) inside repeated windows; a row per bucket."""
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n, text_bytes = size["n"], size["bytes"] or 0
    buckets = max(8, -(-3 * text_bytes // BUCKET_BYTES))
    sample = rows.sample(min(1.0, ROUTE_SAMPLE / max(1, n)), seed=42).select("text")
    keys = sample.mapInArrow(each_batch(_minimisers(window, minimiser)), "key long").groupBy("key").agg(F.count("*").alias("n"))
    keys = keep(keys.filter("n > 2"), "minimisers")
    total = keys.agg(F.sum("n")).first()[0] or 0
    # At most 1 / FREQUENT rows.
    hot = keys.filter(F.col("n") > F.lit(max(50.0, FREQUENT * total))).select("key").collect()
    frequent = frozenset(int(r[0]) & 0xFFFFFFFFFFFFFFFF for r in hot)
    blocks = rows.mapInArrow(_packer(buckets, frequent, window, minimiser), "bucket int, data binary")
    return blocks.groupBy("bucket").applyInArrow(_counter(window), "doc_id long, h long, starts array<long>, stops array<long>")


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Kept words of each text, joined by one space; the other columns as they are."""
    kept, before, removed = [], [], []
    for text, starts, stops in zip(batch["text"], batch["starts"].to_pylist(), batch["stops"].to_pylist()):
        line = words_line(text.as_py())
        n = line.count(b" ") + 1 if line else 0
        gone = 0
        if starts:
            edges = np.zeros(n + 1, np.int64)
            np.add.at(edges, starts, 1)
            np.add.at(edges, stops, -1)
            inside = np.cumsum(edges)[:-1] > 0
            line = b" ".join([w for w, out in zip(line.split(), inside.tolist()) if not out])
            gone = int(inside.sum())
        before.append(n)
        removed.append(gone)
        kept.append(line.decode("utf-8", "surrogatepass"))
    rest = {name: batch.column(i) for i, name in enumerate(batch.schema.names) if name not in ("text", "starts", "stops")}
    new = {"kept": pa.array(kept, pa.string()), "n_words": pa.array(before, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
    yield pa.RecordBatch.from_pydict(rest | new)


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, minimiser: int = MINIMISER, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` and kept (words joined by one space), n_words, n_removed.

    The text itself is left out unless ``keep_text``; columns of ``docs`` with the names of the
    new ones give way to them. Texts travel once more, to meet the ranges of their own row;
    the ranges of a row are bounded by its words.
    """
    others = [c for c in docs.columns if c not in ("kept", "n_words", "n_removed") and (c != text or keep_text)]
    whole = F.coalesce(col(text), F.lit(""))
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), F.xxhash64(whole).alias("h"), whole.alias("text"))
    ranges = repeated_ranges(rows, window, minimiser)
    ranges = ranges.groupBy("doc_id", "h").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("stops")).alias("stops"))
    ranges = ranges.withColumnsRenamed({"doc_id": "range_id", "h": "range_h"})
    named = {c: f"c{i}" for i, c in enumerate(others)}
    left = docs.select(*[col(c).alias(a) for c, a in named.items()], col(doc_id).cast("long").alias("own_id"), F.xxhash64(whole).alias("own_h"), whole.alias("text"))
    same = F.col("own_id").eqNullSafe(F.col("range_id")) & (F.col("own_h") == F.col("range_h"))
    joined = left.join(ranges, same, "left").select(*named.values(), "text", "starts", "stops")
    fields = [f"{a} {joined.schema[a].dataType.simpleString()}" for a in named.values()]
    cut = joined.mapInArrow(each_batch(_cut), ", ".join([*fields, "kept string", "n_words long", "n_removed long"]))
    return cut.select(*[F.col(a).alias(c) for c, a in named.items()], "kept", "n_words", "n_removed")

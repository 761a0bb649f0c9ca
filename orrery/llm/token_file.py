"""Token-ID output: static range asymmetric numeral system over interleaved blocks.

``write_tokens`` encodes whole texts, appends the end id, and writes blocks of entropy
coded ids in ascending ``doc_id`` order; ``read_tokens`` reads them back. One frequency
table, counted over all ids, is shared by all blocks.

A stored table has two folders:

``table``   rows (symbol, freq); the frequencies add up to 2**``SCALE_BITS``
``blocks``  rows (part, block, start, n_docs, n_tokens, data), ``start`` being the ids before the block

``data`` is a block of its own: header, documents, checkpoints, words. A block is cut to
segments; symbol number i of a segment belongs to lane i mod ``LANES``, and all lanes of all
segments advance together. Each checkpoint holds the lane states at the start of its segment,
the place of the segment's words and a CRC-32 of its ids, so segments can be decoded apart. A
CRC-32 of everything after it stands in the header.

Documents: null texts are empty and have the end id only; a null ``doc_id`` sorts first and
comes back null; repeated ``doc_id`` rows are kept and ordered by text; an empty table gives
empty folders and no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from orrery.llm.common import bytes_array, col, keep
from orrery.llm.tokens import chunks, default_tokenizer, piece_ids, with_end

SCALE_BITS = 18
LANES = 512
#: Ids of a block at least (a block ends with a document), and ids between checkpoints.
BLOCK_IDS = 1 << 18
SEGMENT_IDS = 1 << 16
#: Token ids must lie below this; it bounds the frequency table.
VOCABULARY = 1 << 17

MAGIC = b"RANS"
_HEADER = "<4sIIIIII"  # magic, crc of the rest, documents, ids, lanes, segments, bytes of documents
_LOW = np.uint64(1 << 31)


class Table:
    """Frequencies, their running sums, and the symbol of each slot."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        order = np.argsort(symbols)
        symbols, freqs = symbols[order].astype(np.int64), freqs[order].astype(np.int64)
        size = int(symbols.max()) + 1 if len(symbols) else 0
        self.freq = np.zeros(size, np.uint64)
        self.freq[symbols] = freqs.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)]).astype(np.uint64)[:size]
        self.slot = np.repeat(symbols, freqs).astype(np.uint32)


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies in proportion to ``counts``, at least 1 each, that add up to 2**bits."""
    total = 1 << bits
    if len(counts) > total:
        raise ValueError(f"{len(counts)} symbols do not fit into {bits} bits")
    if not len(counts):
        return np.zeros(0, np.int64)
    share = counts.astype(np.float64) / counts.sum() * (total - len(counts))
    freqs = np.floor(share).astype(np.int64) + 1
    most_cut = np.argsort(-(share - np.floor(share)), kind="stable")
    freqs[most_cut[: total - int(freqs.sum())]] += 1
    return freqs


def _encode_segments(lines: np.ndarray, table: Table, last: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(lane states, words) of each segment; ``lines`` are ids by segment, step and lane, ``last`` how many a lone one holds."""
    segments, steps, lanes = lines.shape
    # One line of all lanes a step.
    lines = np.ascontiguousarray(lines.transpose(1, 0, 2)).reshape(steps, segments * lanes)
    freq, start = table.freq[lines], table.start[lines]
    owner_of = np.repeat(np.arange(segments, dtype=np.uint16), lanes)
    state = np.full(segments * lanes, _LOW, np.uint64)
    room = np.uint64(63 - SCALE_BITS - 32)
    words, owners = [], []
    for step in range(steps - 1, -1, -1):
        n = segments * lanes if last is None else min(lanes, last - step * lanes)
        f, x = freq[step, :n], state[:n]
        full = np.flatnonzero((x >> np.uint64(32)) >= (f << room))
        if len(full):
            out = x[full]
            words.append(out.astype(np.uint32))
            owners.append(owner_of[full])
            x[full] = out >> np.uint64(32)
        q = x // f
        x += q * ((np.uint64(1) << np.uint64(SCALE_BITS)) - f) + start[step, :n]
    state = state.reshape(segments, lanes)
    # Words are read in the order of steps, each segment from its own place.
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    owner = np.concatenate(owners[::-1]) if words else np.zeros(0, np.uint16)
    stream, ends = stream[np.argsort(owner, kind="stable")], np.cumsum(np.bincount(owner, minlength=segments))
    return [(state[k], stream[ends[k - 1] if k else 0 : ends[k]]) for k in range(segments)]


def encode_block(ids: np.ndarray, counts: np.ndarray, doc_ids: list, table: Table) -> bytes:
    """One block of whole documents; ``counts`` are their numbers of ids."""
    whole = len(ids) // SEGMENT_IDS
    cut = whole * SEGMENT_IDS
    parts = []
    if whole:
        parts += _encode_segments(ids[:cut].reshape(whole, -1, LANES), table)
    if len(ids) > cut:
        rest = len(ids) - cut
        line = np.zeros(-(-rest // LANES) * LANES, np.int64)
        line[:rest] = ids[cut:]
        parts += _encode_segments(line.reshape(1, -1, LANES), table, rest)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], np.int64)
    docs = zlib.compress(known.tobytes() + numbers.tobytes() + counts.astype(np.int64).tobytes())
    body, place = [docs], 0
    for k, (lanes, words) in enumerate(parts):
        segment = ids[k * SEGMENT_IDS : (k + 1) * SEGMENT_IDS].astype("<u4")
        body += [struct.pack("<QI", place, zlib.crc32(segment.tobytes())), lanes.astype("<u8").tobytes()]
        place += len(words)
    body += [words.astype("<u4").tobytes() for _, words in parts]
    rest = b"".join(body)
    head = (len(doc_ids), len(ids), LANES, len(parts), len(docs))
    crc = zlib.crc32(struct.pack("<5I", *head) + rest)
    return struct.pack(_HEADER, MAGIC, crc, *head) + rest


class Block:
    """A stored block; its segments can be decoded in any order."""

    def __init__(self, data: bytes):
        magic, crc, n_docs, self.n_ids, self.lanes, self.n_segments, doc_bytes = struct.unpack_from(_HEADER, data)
        if magic != MAGIC or zlib.crc32(data[8:]) != crc:
            raise ValueError("damaged token block")
        at = struct.calcsize(_HEADER)
        raw = zlib.decompress(data[at : at + doc_bytes])
        known = np.frombuffer(raw, np.uint8, n_docs)
        numbers = np.frombuffer(raw, np.int64, n_docs, n_docs)
        self.counts = np.frombuffer(raw, np.int64, n_docs, 9 * n_docs)
        self.doc_ids = [int(d) if k else None for k, d in zip(known, numbers)]
        at += doc_bytes
        self.marks = []
        for _ in range(self.n_segments):
            place, check = struct.unpack_from("<QI", data, at)
            self.marks.append((place, check, np.frombuffer(data, "<u8", self.lanes, at + 12)))
            at += 12 + 8 * self.lanes
        self.words = np.frombuffer(data, "<u4", -1, at)

    def _segments(self, first: int, last: int, table: Table) -> np.ndarray:
        """Ids of equally long segments ``first`` to ``last`` - 1, all their lanes at once."""
        marks, size = self.marks[first:last], min((first + 1) * SEGMENT_IDS, self.n_ids) - first * SEGMENT_IDS
        lanes, steps = self.lanes, -(-size // self.lanes)
        place = np.array([m[0] for m in marks], np.int64)
        state = np.concatenate([m[2] for m in marks]).astype(np.uint64)
        out = np.zeros((steps, len(state)), np.uint32)
        mask = np.uint64((1 << SCALE_BITS) - 1)
        for step in range(steps):
            # Only a lone segment may end inside a step.
            n = len(state) if len(marks) > 1 else min(lanes, size - step * lanes)
            x = state[:n]
            low = x & mask
            symbols = table.slot[low]
            out[step, :n] = symbols
            x >>= np.uint64(SCALE_BITS)
            x *= table.freq[symbols]
            x += low - table.start[symbols]
            hungry = np.flatnonzero(x < _LOW)
            if len(hungry):
                counts = np.bincount(hungry // lanes, minlength=len(marks))
                at = np.repeat(place - (np.cumsum(counts) - counts), counts) + np.arange(len(hungry))
                x[hungry] = (x[hungry] << np.uint64(32)) | self.words[at]
                place += counts
        out = out.reshape(steps, len(marks), lanes).transpose(1, 0, 2).reshape(len(marks), -1)[:, :size]
        for line, mark in zip(out, marks):
            if zlib.crc32(line.astype("<u4").tobytes()) != mark[1]:
                raise ValueError("damaged token segment")
        return out.reshape(-1)

    def segment(self, k: int, table: Table) -> np.ndarray:
        """Ids of segment ``k``, from its checkpoint alone."""
        return self._segments(k, k + 1, table)

    def ids(self, table: Table) -> np.ndarray:
        whole = self.n_ids // SEGMENT_IDS
        parts = [self._segments(0, whole, table)] if whole else []
        if whole < self.n_segments:
            parts.append(self._segments(whole, self.n_segments, table))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


_RAW = "part long, block long, start long, n_docs long, n_tokens long, doc_ids array<long>, counts array<long>, ids binary"


def _raw_blocks(path: str, end_id: int):
    """Tokenise ordered documents into raw blocks of ids."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held_ids, held_counts, held_docs, held = [], [], [], 0

        def emit():
            nonlocal block, start, held
            ids, counts = np.concatenate(held_ids), np.concatenate(held_counts)
            row = (part, block, start, len(held_docs), len(ids), list(held_docs), counts, ids.astype("<u4" if ids.max() > 0xFFFF else "<u2").tobytes())
            out = pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64()) for v in row[:5]]
                + [pa.array([row[5]], pa.list_(pa.int64())), pa.array([row[6]], pa.list_(pa.int64())), pa.array([row[7]], pa.binary())],
                names=["part", "block", "start", "n_docs", "n_tokens", "doc_ids", "counts", "ids"],
            )
            start, block, held = start + len(ids), block + 1, 0
            for pile in (held_ids, held_counts, held_docs):
                pile.clear()
            return out

        encoder = piece_ids(path)
        for batch in batches:
            for piece in chunks(batch, "text"):
                ids, counts = with_end(*encoder.encode(piece["text"]), end_id)
                docs, at, first = piece["doc_id"].to_pylist(), 0, 0
                ends = np.cumsum(counts)
                while first < len(docs):
                    last = min(len(docs), int(np.searchsorted(ends, at + BLOCK_IDS - held)) + 1)
                    held_ids.append(ids[at : ends[last - 1]])
                    held_counts.append(counts[first:last])
                    held_docs.extend(docs[first:last])
                    held += int(ends[last - 1]) - at
                    at, first = int(ends[last - 1]), last
                    if held >= BLOCK_IDS:
                        yield emit()
        if held_docs:
            yield emit()

    return run


def _ids_of(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.int64)


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for raw, n in zip(batch["ids"], batch["n_tokens"].to_pylist()):
            counts = np.bincount(_ids_of(raw.as_py(), n))
            if len(counts) > VOCABULARY:
                raise ValueError(f"token ids must lie below {VOCABULARY}")
            if len(counts) > len(total):
                counts, total = total, counts
            total[: len(counts)] += counts
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["symbol", "n"])


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = 2,
) -> None:
    """Encode every whole text of ``docs`` and write the token file below ``path``.

    Texts are dealt out by ranges of (doc_id, text hash) and tokenised once; raw ids wait in
    the shared scratch folder until the frequencies of all of them are known. The driver
    gets one row per symbol (``VOCABULARY`` at most); one row per task is broadcast.
    """
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    raw = keep(ordered.mapInArrow(_raw_blocks(tokenizer, end_id), _RAW), "token-ids", "snappy")

    counts = raw.select("n_tokens", "ids").mapInArrow(_count_ids, "symbol long, n long")
    counted = sorted(counts.groupBy("symbol").agg(F.sum("n").alias("n")).collect())
    symbols = np.array([r[0] for r in counted], np.int64)
    freqs = scaled(np.array([r[1] for r in counted], np.int64))
    table_rows = [(int(s), int(f)) for s, f in zip(symbols, freqs)]
    spark.createDataFrame(table_rows, "symbol long, freq long").coalesce(1).write.parquet(f"{path}/table")

    parts = raw.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    shared = spark.sparkContext.broadcast((symbols, freqs))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ids = _ids_of(one["ids"][0].as_py(), one["n_tokens"][0].as_py())
                data = encode_block(ids, np.array(one["counts"][0].as_py(), np.int64), one["doc_ids"][0].as_py(), table)
                keep_columns = [one[c] for c in ("part", "block", "start", "n_docs", "n_tokens")]
                yield pa.RecordBatch.from_arrays(
                    [*keep_columns, pa.array([data], pa.binary())], names=["part", "block", "start", "n_docs", "n_tokens", "data"],
                )

    numbered = raw.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("before")).drop("before")
    blocks = numbered.mapInArrow(encode, "part long, block long, start long, n_docs long, n_tokens long, data binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a token file: doc_id, start (ids before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    rows = spark.read.schema("symbol long, freq long").parquet(f"{path}/table").collect()
    shared = spark.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)))
    names = ["doc_id", "start", "n_tokens", "ids"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)
        for batch in batches:
            for start, data in zip(batch["start"].to_pylist(), batch["data"]):
                block = Block(data.as_py())
                ids = block.ids(table).astype("<u4")
                ends = np.cumsum(block.counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, pa.int64()), pa.array(start + ends - block.counts, pa.int64()), pa.array(block.counts, pa.int64()), bytes_array(ids.tobytes(), 4 * ends)],
                    names=names,
                )

    schema = "part long, block long, start long, n_docs long, n_tokens long, data binary"
    blocks = spark.read.schema(schema).parquet(f"{path}/blocks").select("start", "data")
    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")

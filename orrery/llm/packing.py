"""Sum-of-squares online packing of documents into token windows.

Documents arrive one by one. With N(h) windows filled to level h, a piece of s ids goes to
the level whose choice raises the sum of N(h)**2 over partially filled windows least; the
counts N are the level array. A document longer than a window is cut: its full windows
stand alone and the rest is placed. When the partition ends, the emptiest open windows are
taken apart to fill the others, and the one that remains is cut at powers of two, so that
nothing is padded.

Each partition packs its own documents; at most ``capacity`` levels are open, and only the
ids of open windows are held. The result depends on the rows and order of a partition.

Null texts are empty and hold the end id alone; every row is packed, repeated or not; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orrery.llm.common import col
from orrery.llm.tokens import chunks, default_tokenizer, piece_ids, with_end

CAPACITY = 4096
#: Sequence ids of a partition start at its number times this.
PARTITION_STEP = 1 << 36


class LevelArray:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        # counts[0] and counts[capacity] stay 0: empty and full windows are not partially filled.
        self.counts = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(capacity + 1)]

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece into a window; the window, if this fills it."""
        n, cap = self.counts, self.capacity
        levels = np.flatnonzero(n[1 : cap - size + 1]) + 1
        # Change of the sum over two: N(h + s) + 1/2 gained, N(h) - 1/2 lost.
        best, cost = 0, n[size] + 0.5 if size < cap else 0.0
        if len(levels):
            change = n[levels + size] - n[levels] + 1.0
            change[levels + size == cap] -= 0.5
            at = int(np.argmin(change))
            if change[at] <= cost:
                best = int(levels[at])
        window = self.windows[best].pop() if best else []
        if best:
            n[best] -= 1
        window.append(piece)
        if best + size == cap:
            return window
        n[best + size] += 1
        self.windows[best + size].append(window)
        return None

    def close(self) -> Iterator[list]:
        """Full windows from what is open, then the rest cut at powers of two."""
        rest = [(level, w) for level in range(self.capacity - 1, 0, -1) for w in self.windows[level]]
        first, last = 0, len(rest) - 1
        spare: list = []
        while first <= last or spare:
            if first > last:
                left = sum(p[2] for p in spare)
                size = 1 << (min(left, self.capacity).bit_length() - 1)
                window, level = [], self.capacity - size
            else:
                level, window = rest[first]
                first += 1
            while level < self.capacity:
                if not spare:
                    if first > last:
                        spare, window = window, []
                        break
                    spare = rest[last][1]
                    last -= 1
                doc, start, size, ids = spare.pop()
                take = min(size, self.capacity - level)
                window.append((doc, start, take, ids[:take]))
                if take < size:
                    spare.append((doc, start + take, size - take, ids[take:]))
                level += take
            if window:
                yield window


def _pack(path: str, end_id: int, capacity: int):
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, levels = piece_ids(path), LevelArray(capacity)
        sequence = TaskContext.get().partitionId() * PARTITION_STEP
        out: list[tuple] = []

        def put(window: list) -> None:
            nonlocal sequence
            offset = 0
            for (doc, total), start, size, ids in window:
                out.append((doc, start, size, total, sequence, offset, ids.astype("<u4").tobytes()))
                offset += size
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

        for batch in batches:
            for part in chunks(batch, "text"):
                ids, counts = with_end(*encoder.encode(part["text"]), end_id)
                ends = np.cumsum(counts)
                for doc, end, n in zip(part["doc_id"].to_pylist(), ends.tolist(), counts.tolist()):
                    whole = n - n % capacity
                    for start in range(0, whole, capacity):
                        put([((doc, n), start, capacity, ids[end - n + start : end - n + start + capacity])])
                    if whole < n:
                        # A copy: a view would keep the ids of the whole batch alive.
                        window = levels.place(((doc, n), whole, n - whole, ids[end - n + whole : end].copy()), n - whole)
                        if window:
                            put(window)
                    if len(out) >= 2000:
                        yield flush()
        for window in levels.close():
            put(window)
            if len(out) >= 2000:
                yield flush()
        if out:
            yield flush()

    return run


def pack(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 2, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``start`` counts the document's ids before the piece, ``offset`` its place in the sequence,
    ``ids`` are little-endian unsigned 32-bit integers. No shuffle: scan partitions are packed
    as they lie, and only their last windows know a boundary.
    """
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return rows.mapInArrow(_pack(tokenizer or default_tokenizer(), end_id, capacity), schema)

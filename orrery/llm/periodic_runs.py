"""Periodic runs in the words of a text: seed and extend along diagonals.

A run is a stretch of words with smallest period q and at least max(24, 3 * q) words that no
neighbouring word extends. Along the diagonal of lag q it is a stretch of equal words, q apart,
of at least max(24 - q, 2 * q) words: the guaranteed overlap. Lags are taken in bands. Within a
band, K is the least guaranteed overlap, K-grams are the index, and occurrence pairs of one
K-gram in one document whose distance lies in the band are seeds. A seed is extended to both
sides over equal words; a table of the furthest word covered on each lag drops all seeds inside
a stretch that is known.

Bands end at 3/4 K. A K-gram of a run with period q <= 3/4 K cannot occur again at distances
d <= K - q other than q (two periods d, q with d + q <= K would give a shorter period), so
successive occurrences before q are more than K/4 >= q/3 words apart, and q is reached by the
second next occurrence at the latest. Two seeds a place thus find every run, however often a
K-gram repeats: a text of one word has as many seeds as words and not their square.

K-grams of the first band (16 words) are found by hash and then compared; the longer ones of
further bands are told apart by pairs of ranks of shorter ones (prefix doubling), without any
hash, and only at places where every 16-gram inside repeats.

Work is per row, on whole texts and in bounded batches; nothing is shuffled. Null, empty and
wordless texts have no runs and collapse to an empty text; repeated rows are rows of their own;
an empty table gives no rows; a very long text is worked on whole. Columns named like an output
give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from orrery.llm.common import arrow_schema, col, each_batch
from orrery.llm.substrings import mixed
from orrery.llm.tokens import chunks

MIN_LENGTH = 24
MIN_POWER = 3
#: Rows of words that are compared at once.
COMPARED = 1 << 16
#: Words that an extension looks at first; it doubles with every step.
REACH = 32
_STEP = np.uint64(0xD6E8FEB86659FD93)

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def bands(longest: int) -> Iterator[tuple[int, int, int]]:
    """(K, least lag, greatest lag) of bands that cover the periods of runs in ``longest`` words."""
    low, most = 1, longest // MIN_POWER
    while low <= most:
        k = MIN_LENGTH - MIN_LENGTH // MIN_POWER if low == 1 else (MIN_POWER - 1) * low
        high = 3 * k // 4
        yield k, low, min(high, most)
        low = high + 1


class Ranks:
    """Ranks of word n-grams by place: equal ranks, equal n-grams; -1 where none starts that may repeat."""

    def __init__(self, words: np.ndarray, last: np.ndarray, size: int):
        """``last``: end of the document of each place."""
        self.words, self.last = words, last
        self.size, self.rank = size, self._first(size)

    def _first(self, size: int) -> np.ndarray:
        n = len(self.words)
        rank = np.full(n, -1, np.int64)
        at = np.flatnonzero(np.arange(n) + size <= self.last)
        if not len(at):
            return rank
        values, sums = mixed(self.words.astype(np.uint64) + np.uint64(1)), np.zeros(n, np.uint64)
        for i in range(size):
            sums[: n - size + 1] = sums[: n - size + 1] * _STEP + values[i : n - size + 1 + i]
        # A place belongs to its document: equal grams of other documents are no repeats.
        keys = mixed(sums[at]) ^ mixed(self.last[at].astype(np.uint64))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        at = at[order[again]]
        if not len(at):
            return rank
        keys = keys[again]
        group = np.cumsum(np.concatenate([[True], keys[1:] != keys[:-1]])) - 1
        lead = at[np.searchsorted(group, np.arange(group[-1] + 1))][group]
        if not self._equal(at, lead, size):  # two grams share a hash: tell all apart by their words
            group = np.unique(self.words[at[:, None] + np.arange(size)], axis=0, return_inverse=True)[1].ravel()
        rank[at] = group
        return rank

    def _equal(self, at: np.ndarray, to: np.ndarray, size: int) -> bool:
        place = np.arange(size)
        for i in range(0, len(at), COMPARED):
            if (self.words[at[i : i + COMPARED, None] + place] != self.words[to[i : i + COMPARED, None] + place]).any():
                return False
        return True

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, ranks) of the grams of ``size`` words that may repeat, places ascending; sizes ascend from call to call."""
        while 2 * self.size <= size:
            at, pairs = self._pairs(2 * self.size)
            rank = np.full(len(self.words), -1, np.int64)
            rank[at] = np.unique(pairs, return_inverse=True)[1]
            self.size, self.rank = 2 * self.size, rank
        return self._pairs(size)

    def _pairs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.rank >= 0)
        at = at[at + size <= self.last[at]]
        second = self.rank[at + size - self.size]
        at, second = at[second >= 0], second[second >= 0]
        return at, self.rank[at] * np.int64(len(self.words) + 1) + second


def seeds(at: np.ndarray, ranks: np.ndarray, last: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, lag) of the first and second next occurrence of each gram, lags in the band."""
    order = np.argsort(ranks, kind="stable")
    at, ranks = at[order], ranks[order]
    for step in (1, 2):
        lag = at[step:] - at[:-step]
        near = (ranks[step:] == ranks[:-step]) & (last[at[step:]] == last[at[:-step]]) & (lag >= low) & (lag <= high)
        yield at[:-step][near], lag[near]


def reach(words: np.ndarray, at: int, lag: int, stop: int, back: bool) -> int:
    """The end of the stretch of words equal ``lag`` apart, from ``at`` on (or the start of it, going back)."""
    size = REACH
    while True:
        if back:
            low = max(stop, at - size)
            odd = np.flatnonzero(words[low:at] != words[low + lag : at + lag])
            if len(odd):
                return low + int(odd[-1]) + 1
            at = low
        else:
            high = min(stop - lag, at + size)
            odd = np.flatnonzero(words[at:high] != words[at + lag : high + lag])
            if len(odd):
                return at + int(odd[0])
            at = high
        if at == (stop if back else stop - lag):
            return at
        size *= 2


def _prime_factors(n: int) -> Iterator[int]:
    p = 2
    while p * p <= n:
        if n % p == 0:
            yield p
            while n % p == 0:
                n //= p
        p += 1
    if n > 1:
        yield n


def smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a run with this period from ``start`` has no smaller one.

    A smaller period of a stretch of 3 * period words divides the period.
    """
    root = words[start : start + 2 * period]
    return all((root[:period] != root[period // f : period // f + period]).any() for f in _prime_factors(period))


def find_runs(words: np.ndarray, edges: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document words[edges[d]:edges[d + 1]], by start, then period."""
    sizes = np.diff(edges)
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if not len(sizes) or sizes.max() < MIN_LENGTH:
        return found
    doc = np.repeat(np.arange(len(sizes)), sizes)
    last = edges[1:][doc]
    ranks = None
    for k, low, high in bands(int(sizes.max())):
        ranks = ranks or Ranks(words, last, k)
        at, grams = ranks.of(k)
        if not len(at):
            break
        both = [np.concatenate(c) for c in zip(*seeds(at, grams, last, low, high))]
        order = np.lexsort((both[0], both[1]))
        covered: dict[int, int] = {}
        # Of seeds in a row, the first one stands for all.
        place, lag = both[0][order], both[1][order]
        head = np.ones(len(place), bool)
        head[1:] = (place[1:] > place[:-1] + 1) | (lag[1:] != lag[:-1]) | (last[place[1:]] != last[place[:-1]])
        for p, q in zip(place[head].tolist(), lag[head].tolist()):
            if p < covered.get(q, 0):
                continue
            d = int(doc[p])
            end = reach(words, p, q, int(edges[d + 1]), back=False)
            covered[q] = end
            start = reach(words, p, q, int(edges[d]), back=True)
            length = end + q - start
            if length >= max(MIN_LENGTH, MIN_POWER * q) and smallest(words, start, q):
                found[d].append((start - int(edges[d]), length, q))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared as fractions; ties: least start, then period."""
    best = None
    for run in runs:  # by start and period already
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts laid end to end, and the words before each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat = lists.flatten()
    edges = lists.offsets.to_numpy().astype(np.int64)
    edges = edges - edges[0]
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(real)), np.concatenate([[0], np.cumsum(real)])[edges]


def _work(batch: pa.RecordBatch, text: str, kept: list[str], shape: pa.Schema) -> pa.RecordBatch:
    flat, edges = split_words(batch[text])
    numbers = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found = find_runs(numbers, edges)
    drop = np.zeros(len(numbers) + 1, np.int64)
    for d, runs in enumerate(found):
        for start, length, period in runs:
            drop[edges[d] + start + period] += 1
            drop[edges[d] + start + length] -= 1
    stays = np.cumsum(drop)[:-1] == 0
    ends = np.concatenate([[0], np.cumsum(stays)])[edges]
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat.filter(pa.array(stays)))
    best = [best_run(runs) for runs in found]
    rows = [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found]
    columns = [batch[c] for c in kept] + [
        pa.array(np.diff(edges)), pa.array(rows, shape.field("runs").type),
        pa.array([b and {"start": b[0], "length": b[1], "period": b[2]} for b in best], shape.field("best").type),
        pc.binary_join(lists, pa.scalar(" ", flat.type)),
    ]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, shape)], schema=shape)


def periodic_runs(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with n_words, runs, best and collapsed.

    ``runs`` are (start, length, period) in words, by start and period; ``best`` is the run
    with the greatest length / period; ``collapsed`` is the text in which each run has its
    first period only, words joined by one space. ``keep_text=False`` leaves the text out.
    """
    added = {"n_words", "runs", "best", "collapsed"}
    if text in added:
        raise ValueError(f"the text column may not be called {text}")
    others = [c for c in docs.columns if c.lower() not in added]
    kept = [c for c in others if keep_text or c != text]
    schema = T.StructType([*docs.select(*[col(c) for c in kept]).schema.fields,
                           T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS),
                           T.StructField("best", RUNS.elementType), T.StructField("collapsed", T.StringType())])
    shape = arrow_schema(schema)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in chunks(batch, text):
            yield _work(part, text, kept, shape)

    return docs.select(*[col(c) for c in others]).mapInArrow(each_batch(run), schema)

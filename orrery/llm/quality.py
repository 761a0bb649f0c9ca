"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text gives a vector of statistics, transformed towards normal shape (logarithms of
counts, square-root angles of shares). Class means and covariances are sums over all labelled
training rows. A class covariance is shrunk towards the pooled one and then towards a sphere;
the inverse Cholesky factors are computed once, and a score is the logistic of the difference
of the two Mahalanobis log-densities.

Null texts count as empty and are scored; rows with a null label or id train nothing; repeated
rows count each; with one class only its prior decides, with none the score is 0.5. An empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orrery.llm.common import col, each_batch, keep
from orrery.llm.tokens import chunks
from orrery.llm.vectors import lists, matrix

#: Share of the pooled covariance in a class covariance, and of the sphere in the result.
TO_POOLED = 0.2
TO_SPHERE = 0.02

_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:?'\"()-", "\n")
#: Classes of bytes: letters, capitals, digits, punctuation, line ends, white space, other signs, non-ASCII.
KINDS = 8


def _kinds() -> np.ndarray:
    out = np.full(256, 6, np.uint8)
    for kind, signs in enumerate(_CLASSES):
        out[list(signs.encode())] = kind
    out[[32, 9, 11, 12, 13]] = 5
    out[128:] = 7
    return out


_KIND_OF = _kinds()


def byte_shares(texts: list[bytes]) -> np.ndarray:
    """Share of each kind of byte in each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    kinds = _KIND_OF[np.frombuffer(b"".join(texts), np.uint8)]
    row = np.repeat(np.arange(len(texts)), lengths)
    counts = np.bincount(row * KINDS + kinds, minlength=len(texts) * KINDS).reshape(-1, KINDS)
    return counts / np.maximum(1, lengths)[:, None]


def angle(share):
    """Square-root angle of a share: evens out the variance of proportions."""
    return np.arcsin(np.sqrt(np.clip(share, 0, 1)))


def word_statistics(text: bytes) -> tuple[float, ...]:
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * 8
    distinct, pairs = len(set(words)), len(set(zip(words, words[1:])))
    lengths = list(map(len, words))
    lines = text.splitlines()
    letters = sum(w.isalpha() or w[:-1].isalpha() for w in words)
    return (
        math.log1p(n), sum(lengths) / n, math.log1p(max(lengths)), math.log(distinct) / math.log1p(n), pairs / max(1, n - 1),
        sum(size <= 3 for size in lengths) / n, len(set(lines)) / len(lines), letters / n,
    )


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of transformed statistics for each text."""
    shares = angle(byte_shares(texts))
    words = np.array([word_statistics(t) for t in texts]).reshape(len(texts), 8)
    words[:, 4:] = angle(words[:, 4:])
    return np.concatenate([shares, words], axis=1)


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x) for every row of ``docs``."""
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in chunks(batch, "text"):
            x = statistics([t.encode("utf-8", "surrogatepass") for t in part["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([part["doc_id"], lists(x)], names=["doc_id", "x"])

    return rows.mapInArrow(each_batch(run), "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of the classes 0 and 1, on standardised statistics."""

    centre: np.ndarray
    spread: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    log_priors: list[float]

    def log_density(self, x: np.ndarray, c: int) -> np.ndarray:
        z = (x - self.means[c]) @ self.factors[c].T
        return -0.5 * (z * z).sum(axis=1) - 0.5 * self.log_dets[c] + self.log_priors[c]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        if len(self.means) < 2:
            return np.full(len(x), self.log_priors[0])
        x = (x - self.centre) / self.spread
        return 1 / (1 + np.exp(np.clip(self.log_density(x, 0) - self.log_density(x, 1), -500, 500)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, sums and sums of products of each class in a task: rows (label, slot, value)."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        labels = batch["label"].to_numpy()
        x = matrix(batch["x"], len(batch["x"][0]))
        x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
        for c in (0, 1):
            own = x[labels == c]
            if len(own):
                totals[c] = totals.get(c, 0) + own.T @ own
    for c, total in totals.items():
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), c, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["label", "slot", "value"])


def fit_discriminant(rows: DataFrame, to_pooled: float = TO_POOLED, to_sphere: float = TO_SPHERE) -> Discriminant:
    """Fit on all ``rows`` (x, label 0 or 1); the driver gets one number per class and matrix cell."""
    cells = rows.mapInArrow(_sums, "label int, slot int, value double").groupBy("label", "slot").agg(F.sum("value").alias("value")).collect()
    totals = {}
    for c in sorted({r["label"] for r in cells}):
        flat = np.array([v for _, v in sorted((r["slot"], r["value"]) for r in cells if r["label"] == c)])
        totals[c] = flat.reshape(math.isqrt(len(flat)), -1)
    if len(totals) < 2:
        return Discriminant(None, None, [None], [], [], [float(next(iter(totals), 0.5))])
    counts = [totals[c][0, 0] for c in (0, 1)]
    means = [totals[c][0, 1:] / totals[c][0, 0] for c in (0, 1)]
    scatter = [totals[c][1:, 1:] - counts[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = sum(scatter) / sum(counts)
    centre = sum(n * m for n, m in zip(counts, means)) / sum(counts)
    # Spread over both classes: a statistic may be constant in each and yet tell them apart.
    between = sum(n * np.outer(m - centre, m - centre) for n, m in zip(counts, means)) / sum(counts)
    spread = np.sqrt(np.maximum(np.diag(pooled + between), 0))
    spread[spread < 1e-6] = 1.0
    pooled = pooled / np.outer(spread, spread)
    factors, log_dets = [], []
    for c in (0, 1):
        own = scatter[c] / counts[c] / np.outer(spread, spread)
        shrunk = (1 - to_pooled) * own + to_pooled * pooled
        shrunk = (1 - to_sphere) * shrunk + to_sphere * np.eye(len(shrunk)) * np.trace(shrunk) / len(shrunk)
        low = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(low))
        log_dets.append(2 * float(np.log(np.diag(low)).sum()))
    log_priors = [math.log(n / sum(counts)) for n in counts]
    return Discriminant(centre, spread, [(m - centre) / spread for m in means], factors, log_dets, log_priors)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``; ``labels`` (doc_id and label) are the training rows."""
    known = keep(document_statistics(docs, doc_id, text), "document-statistics")
    marks = labels.filter(col(label).isin(0, 1)).select(col(doc_id).cast("long").alias("doc_id"), col(label).cast("int").alias("label"))
    model = docs.sparkSession.sparkContext.broadcast(fit_discriminant(known.join(marks, "doc_id").select("x", "label")))

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = matrix(batch["x"], len(batch["x"][0])) if batch.num_rows else np.zeros((0, 1))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.value.scores(x) if len(x) else [], pa.float64())], names=["doc_id", "score"])

    return known.mapInArrow(each_batch(score), "doc_id long, score double")

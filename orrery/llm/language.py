"""Language identification by a byte convolutional network, trained in numpy.

Bytes are embedded, filters of several widths run over windows of fixed length, each filter
keeps its largest response in the window, and a softmax layer tells the languages apart. A
text is cut into overlapping windows that cover every byte sequence of it, and its
probabilities are the mean over its windows.

Training reads a bounded sample (``PER_LANGUAGE`` distinct texts of each language, drawn by a
hash) and one stretch of each; prediction reads every byte of every text. Null texts and texts
without a letter are ``und`` with score 0, and so is everything if nothing was learned. Rows
are told apart by nothing but their text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from orrery.llm.common import col, each_batch, free_name
from orrery.llm.tokens import chunks

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 6
PER_LANGUAGE = 1500
#: Characters of a training document that are read, from a place that a hash picks.
STRETCH = 700
LANGUAGES = 1000
STEPS = 500
BATCH = 64
SEED = 42
#: Windows that are convolved at once.
AT_ONCE = 128


@dataclass
class ByteNet:
    """Weights: byte embedding, one filter bank of the largest width, softmax layer."""

    languages: list[str]
    embedding: np.ndarray  # 256 x E
    filters: np.ndarray  # (widest * E) x F; narrow filters are zero behind their width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """Byte windows to the rows that the filters see."""
        seen = self.embedding[windows]
        wide = sliding_window_view(seen, max(WIDTHS), axis=1)  # n, positions, E, width
        return np.ascontiguousarray(wide.transpose(0, 1, 3, 2)).reshape(len(windows), -1, self.filters.shape[0])

    def pooled(self, columns: np.ndarray) -> np.ndarray:
        return columns @ self.filters

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)))
        for at in range(0, len(windows), AT_ONCE):
            response = self.pooled(self.columns(windows[at : at + AT_ONCE])).max(axis=1)
            out[at : at + AT_ONCE] = softmax(np.maximum(response + self.bias, 0) @ self.out + self.out_bias)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts and the number of windows of each; every run of bytes as wide as a filter lies in one."""
    stride = WINDOW - max(WIDTHS) + 1
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, -(-(lengths - max(WIDTHS) + 1) // stride))
    pad = bytes(WINDOW)
    data = np.frombuffer(pad.join([*texts, b""]), np.uint8)
    starts = np.cumsum(lengths + WINDOW) - lengths - WINDOW
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return sliding_window_view(data, WINDOW)[np.repeat(starts, counts) + inside * stride], counts


def filter_mask() -> np.ndarray:
    """1 where a filter has a weight: narrow ones end before the widest."""
    widest = max(WIDTHS)
    return np.concatenate([np.repeat((np.arange(widest * EMBEDDING) < w * EMBEDDING)[:, None], FILTERS, 1) for w in WIDTHS], axis=1).astype(np.float32)


def gradients(net: ByteNet, batch: np.ndarray, target: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy of a batch of windows, by each weight of the net."""
    each = np.arange(len(batch))
    columns = net.columns(batch)
    response = net.pooled(columns)
    at = response.argmax(axis=1)  # batch x filters
    top = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0] + net.bias
    hidden = np.maximum(top, 0)
    error = softmax(hidden @ net.out + net.out_bias)
    error[each, target] -= 1
    error /= len(batch)
    back = (error @ net.out.T) * (top > 0)
    rows = columns[each[:, None], at]  # batch x filters x inputs
    to_rows = back[:, :, None] * net.filters.T[None]  # batch x filters x inputs
    embedding = np.zeros_like(net.embedding)
    for j in range(max(WIDTHS)):
        np.add.at(embedding, batch[each[:, None], at + j], to_rows[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
    return {
        "out": hidden.T @ error, "out_bias": error.sum(axis=0), "bias": back.sum(axis=0),
        "filters": np.einsum("bfi,bf->if", rows, back) * mask, "embedding": embedding,
    }


def train(texts: list[bytes], labels: list[str], seed: int = SEED, steps: int = STEPS) -> ByteNet | None:
    """Adam on cross-entropy, with one random window of each text of a batch; None without texts."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    y = np.searchsorted(languages, labels)
    windows, counts = cut_windows(texts)
    firsts = np.cumsum(counts) - counts
    widest, n_filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = filter_mask()
    params = {
        "embedding": rng.normal(0, 0.5, (256, EMBEDDING)), "filters": rng.normal(0, 0.3, (widest * EMBEDDING, n_filters)) * mask,
        "bias": np.zeros(n_filters), "out": rng.normal(0, 0.3, (n_filters, len(languages))), "out_bias": np.zeros(len(languages)),
    }
    params = {k: v.astype(np.float32) for k, v in params.items()}
    first_moment = {k: np.zeros_like(v) for k, v in params.items()}
    second_moment = {k: np.zeros_like(v) for k, v in params.items()}
    by_language = [np.flatnonzero(y == c) for c in range(len(languages))]
    for step in range(1, steps + 1):
        net = ByteNet(languages, **params)
        # Languages alternate, so a rare one weighs as much as a frequent one.
        picked = np.array([rng.choice(by_language[c]) for c in rng.integers(0, len(languages), BATCH)])
        batch = windows[firsts[picked] + rng.integers(0, counts[picked])]
        grads = gradients(net, batch, y[picked], mask)
        rate = 0.02 * (1 - step / (steps + 1))
        for k, grad in grads.items():
            first_moment[k] = 0.9 * first_moment[k] + 0.1 * grad
            second_moment[k] = 0.999 * second_moment[k] + 0.001 * grad * grad
            params[k] = params[k] - rate * (first_moment[k] / (1 - 0.9**step)) / (np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8)
        params = {k: v.astype(np.float32) for k, v in params.items()}
    return ByteNet(languages, **params)


def held_out(doc_id: str, parts: int, part: int):
    """Whether crc32 of the id as text leaves ``part``; rows without an id are not held out."""
    return F.coalesce(F.crc32(col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def fit_language(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> ByteNet | None:
    """Train on a hash sample of the labelled rows of ``docs``; more than ``LANGUAGES`` labels are an error."""
    usable = docs.filter(col(lang).isNotNull() & col(text).rlike("\\p{L}")).select(col(lang).alias("lang"), col(text).alias("text"))
    # Copies of a text count once, so that no text fills the sample.
    usable = usable.withColumn("h", F.xxhash64("text", F.lit(SEED)))
    sizes = usable.select("lang", "h").distinct().groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    # One row a language, hence a bounded broadcast.
    kind = usable.schema["lang"].dataType.simpleString()
    shares = docs.sparkSession.createDataFrame([(name, min(1.0, per_language / n)) for name, n in sizes], f"lang {kind}, share double")
    drawn = usable.join(F.broadcast(shares), "lang").filter(F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    room = F.greatest(F.length("text") - STRETCH, F.lit(0)) + 1
    start = (F.pmod(F.shiftright("h", 20), room) + 1).cast("int")
    # The draw is by hash, hence about per_language a language.
    stretches = drawn.select("lang", F.substring("text", start, F.lit(STRETCH)).alias("text"), "h").groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    rows = stretches.withColumn("place", place).filter(F.col("place") <= 2 * per_language).orderBy("h", "lang").collect()
    return train([r["text"].encode("utf-8", "surrogatepass") for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, net: ByteNet | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (underscored where such columns exist)."""
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    named = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[col(c).alias(a) for c, a in named.items()], F.coalesce(col(text).rlike("\\p{L}"), F.lit(False)).alias("letters"))
    at = named[text]
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def predict(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in chunks(batch, at):
            known = part["letters"].to_numpy(zero_copy_only=False)
            languages, sure = np.full(part.num_rows, "und", object), np.zeros(part.num_rows)
            if model is not None and known.any():
                texts = [t.encode("utf-8", "surrogatepass") for t in part[at].filter(part["letters"]).to_pylist()]
                windows, counts = cut_windows(texts)
                mean = np.add.reduceat(model.probabilities(windows), np.cumsum(counts) - counts) / counts[:, None]
                best = mean.argmax(axis=1)
                languages[known] = np.array(model.languages, object)[best]
                sure[known] = np.clip(mean[np.arange(len(best)), best], 0, 1)
            columns = [part[a] for a in named.values()]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(languages, pa.string()), pa.array(sure)], names=[*named.values(), "pred", "sure"])

    fields = [f"{a} {rows.schema[a].dataType.simpleString()}" for a in named.values()]
    told = rows.mapInArrow(each_batch(predict), ", ".join([*fields, "pred string", "sure double"]))
    return told.select(*[F.col(a).alias(c) for c, a in named.items()], F.col("pred").alias(pred), F.col("sure").alias(score))

"""Text quality by a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. At every byte, ``FILTERS`` learned filters of ``WIDTH`` bytes
respond; a filter is one table of weights per place, indexed by the byte there. The
highest response of each filter within a chunk of ``2 * STEP`` bytes is kept; chunks
start every ``STEP`` bytes, so they overlap and cover the whole text. A chunk's pooled
responses give it a logit through a hidden layer, and the mean of the chunks' logits,
through a sigmoid, is the text's probability. Nothing but the text enters a score.

A null or empty text is one chunk without bytes and gets that chunk's score. Equal texts
get equal scores. Without any labelled row, or with one label only, the score is the
constant share of label 1 (0.5 without rows).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import append_columns, encoded

WIDTH, FILTERS, STEP, HIDDEN = 6, 24, 128, 8
#: Labelled documents that the network is fitted on, at most (a hash picks them).
FIT_ROWS = 4_000
#: Bytes of all their texts, at most about: where texts are long, fewer rows are picked.
FIT_BYTES = 32 << 20
#: Documents with at least this probability of label 1 count as good.
LEAST_QUALITY = 0.3
#: Steps of gradient descent, so that few labelled rows are gone over more often.
STEPS, RATE, BATCH = 800, 0.01, 64
# Bytes whose responses are held at once.
SLICE = 1 << 15


@dataclass
class Network:
    """``tables``: place x (256 bytes and 'no byte') x filter."""

    tables: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    constant: float | None = None

    def parameters(self) -> list[np.ndarray]:
        return [self.tables, self.hidden, self.hidden_bias, self.out, self.bias]

    def pairs(self) -> list[np.ndarray]:
        """The tables of two places at a time, indexed by both bytes."""
        joined = self.tables[0::2, :, None, :] + self.tables[1::2, None, :, :]
        return list(joined.reshape(WIDTH // 2, 257 * 257, FILTERS).astype(np.float32))


def _start(seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return Network(
        normal(WIDTH, 257, FILTERS, scale=0.3),
        normal(FILTERS, HIDDEN, scale=0.3),
        np.zeros(HIDDEN, np.float32),
        normal(HIDDEN, scale=0.3),
        np.zeros(1, np.float32),
    )


def _padded(text: bytes) -> np.ndarray:
    """Byte numbers, 256 standing for 'no byte', in whole steps and what filters overhang."""
    steps = max(1, -(-len(text) // STEP))
    codes = np.full(steps * STEP + WIDTH - 1, 256, np.int32)
    codes[: len(text)] = np.frombuffer(text, np.uint8)
    return codes


def _step_maxima(pairs: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """The highest response of each filter within each step of a padded text."""
    size = len(codes) - WIDTH + 1
    both = codes[:-1] * 257 + codes[1:]
    found = []
    for at in range(0, size, SLICE):
        end = min(size, at + SLICE)
        response = pairs[0][both[at:end]]
        for k in range(1, WIDTH // 2):
            response += pairs[k][both[at + 2 * k : end + 2 * k]]
        found.append(response.reshape(-1, STEP, FILTERS).max(axis=1))
    return np.concatenate(found)


def _chunks(steps: np.ndarray) -> np.ndarray:
    """Overlapping chunks of two neighbouring steps each; a lone step is a chunk."""
    return np.maximum(steps[:-1], steps[1:]) if len(steps) > 1 else steps


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logits(net: Network, pooled: np.ndarray) -> np.ndarray:
    inner = np.maximum(np.maximum(pooled, 0) @ net.hidden + net.hidden_bias, 0)
    return inner @ net.out + net.bias[0]


def score_texts(net: Network, pairs: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
    if net.constant is not None:
        return np.full(len(texts), net.constant)
    logits = [
        _logits(net, _chunks(_step_maxima(pairs, _padded(t)))).mean(dtype=float) for t in texts
    ]
    return _sigmoid(np.array(logits, float))


def train(texts: list[bytes], labels: np.ndarray, steps: int = STEPS) -> Network:
    """Fit by Adam on the mean log loss of texts; the gradient reaches the bytes at maxima."""
    net = _start()
    if len(texts) == 0 or labels.min() == labels.max():
        net.constant = float(labels.mean()) if len(texts) else 0.5
        return net
    padded = [_padded(t).astype(np.int16) for t in texts]
    params = net.parameters()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    rng = np.random.default_rng(11)
    step = 0
    while step < steps:
        order = rng.permutation(len(texts))
        rate = RATE * (1.1 - step / steps)
        for at in range(0, len(order), BATCH):
            step += 1
            batch = order[at : at + BATCH]
            grads = _gradients(net, [padded[i] for i in batch], labels[batch])
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                size = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                p -= (size * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def _gradients(net: Network, texts: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
    """Gradients of the parameters over a batch of padded texts."""
    pooled, places, owners, codes, base = [], [], [], [], 0
    for i, text in enumerate(texts):
        size = len(text) - WIDTH + 1
        values, tops = [], []
        for at in range(0, size, SLICE):
            end = min(size, at + SLICE)
            response = net.tables[0][text[at:end]]
            for k in range(1, WIDTH):
                response += net.tables[k][text[at + k : end + k]]
            steps = response.reshape(-1, STEP, FILTERS)
            best = steps.argmax(axis=1)
            values.append(np.take_along_axis(steps, best[:, None, :], axis=1)[:, 0])
            tops.append(best + (np.arange(len(best)) * STEP)[:, None] + base + at)
        value, top = np.concatenate(values), np.concatenate(tops)
        if len(top) > 1:
            first = value[:-1] >= value[1:]
            value = np.where(first, value[:-1], value[1:])
            top = np.where(first, top[:-1], top[1:])
        pooled.append(value)
        places.append(top)
        owners.append(np.full(len(value), i))
        codes.append(text)
        base += len(text)
    value, place = np.concatenate(pooled), np.concatenate(places)
    owner, code = np.concatenate(owners), np.concatenate(codes)
    chunks = np.bincount(owner, minlength=len(texts))
    active = np.maximum(value, 0)
    inner_in = active @ net.hidden + net.hidden_bias
    inner = np.maximum(inner_in, 0)
    logit = inner @ net.out + net.bias[0]
    p = _sigmoid(np.bincount(owner, logit, len(texts)) / chunks)
    d_logit = (((p - labels) / chunks)[owner] / len(texts)).astype(np.float32)
    d_inner = d_logit[:, None] * net.out * (inner_in > 0)
    d_value = (d_inner @ net.hidden.T) * (value > 0)
    rows, filters = np.nonzero(d_value)
    weight, where = d_value[rows, filters], place[rows, filters]
    d_tables = np.empty_like(net.tables)
    for k in range(WIDTH):
        at = code[where + k].astype(np.int64) * FILTERS + filters
        d_tables[k] = np.bincount(at, weight, 257 * FILTERS).reshape(257, FILTERS)
    return [
        d_tables,
        active.T @ d_inner,
        d_inner.sum(axis=0),
        inner.T @ d_logit,
        np.array([d_logit.sum()], np.float32),
    ]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = FIT_ROWS,
) -> Network:
    """Fit on about ``rows`` labelled documents where ``learn`` holds, or on all if fewer.

    A document's label is the mean of its non-null labels, at 0.5 or more 1. Labelled rows
    and their bytes are counted first; a hash of id and text then picks rows, so that the
    whole texts of those picked have about ``rows`` rows and ``FIT_BYTES`` bytes at most.
    Rows that repeat an id and its text count once when they are picked. One task trains on
    them, in an order of their own, so that a task that is run again gives the same network;
    the driver only gets its parameters.
    """
    marks = (
        labels.filter(F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("__id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("__label"))
    )
    raw = F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8")
    learned, key = docs.filter(learn), ["__id", "__place"]
    named = [
        docs[doc_id].alias("__id"),
        F.pmod(F.xxhash64(docs[doc_id], docs[text]), F.lit(1 << 30)).alias("__place"),
    ]
    # Rows are counted and picked without their texts.
    sizes = learned.select(*named, F.octet_length(raw).alias("__size")).join(marks, "__id")
    known = sizes.agg(F.count(F.lit(1)).alias("rows"), F.sum("__size").alias("bytes")).first()
    share = min(1.0, rows / max(known.rows, 1), FIT_BYTES / max(known.bytes or 0, 1))
    picked = sizes.filter(F.col("__place") <= int((1 << 30) * share))
    picked = picked.select(*key, "__label").dropDuplicates(key)
    chosen = (
        learned.select(*named, raw.alias("__bytes"))
        .join(F.broadcast(picked), key)
        .dropDuplicates(key)
        .select("__place", "__bytes", "__label")
    )

    def learn_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[], [], []]
        for batch in batches:
            for held, column in zip(columns, batch.columns):
                held += column.to_pylist()
        net = _trained(sorted(zip(*columns)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)])], names=["net"])

    found = chosen.repartition(1).mapInArrow(learn_all, "net binary").first()
    return _trained([]) if found is None else pickle.loads(found.net)


def _trained(chosen: list[tuple[int, bytes, int]]) -> Network:
    """The network of sorted rows (place, text, label)."""
    return train([row[1] for row in chosen], np.array([row[2] for row in chosen], float))


def score(docs: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of label 1 to ``docs``. The network's size is fixed: broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        own = shared.value
        pairs = own.pairs()

        def run(texts):
            return [pa.array(score_texts(own, pairs, encoded(texts)), pa.float64())]

        return run

    return append_columns(docs, [text], [T.StructField(out, T.DoubleType())], make)
